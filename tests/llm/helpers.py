ODD = [None, "", " ", "\n\n", "a", "word " * 4, "same same " * 50, "é你好 😀 " * 3, "x" * 3000,
       "The quick brown fox jumps over the lazy dog. " * 40]


def table(spark, rows, folder, **columns):
    """Writes ``documents.parquet``: texts (doc_id by place) or (doc_id, text) pairs."""
    rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
    lang, source = columns.get("lang"), columns.get("source")
    full = [(i, t, lang[k] if lang else "en", source[k] if source else f"s{k % 3}", len(t or ""))
            for k, (i, t) in enumerate(rows)]
    df = spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    df.repartition(3).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")

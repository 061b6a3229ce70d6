"""A corpus pipeline in five stages, each one operator over all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. ``run`` applies them in order, each written as Parquet to the shared
folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspark.llm import dart_minhash, language_id, mixing, sentencepiece_bpe, sparse_suffix
from tillspark.llm.common import documents, written

#: A text whose likeliest language is less likely than this has no language.
LEAST_LANGUAGE_SCORE = 0.3


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters or without a likely language; fills in missing languages."""
    found = language_id.predict(docs, language_id.train(docs))
    kept = found.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document (the one of least doc_id) of each near-duplicate class."""
    return dart_minhash.one_of_each_class(docs)


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that stand elsewhere before; a document of nothing else goes."""
    out = sparse_suffix.without_spans(docs, sparse_suffix.repeated_spans(docs))
    return out.filter(F.col("text").rlike(r"\S")).withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents of small sources to the target entropy; every document stays."""
    return mixing.mix(docs).select(*docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the hash of the text they decode to."""
    made = sentencepiece_bpe.encode_and_decode(docs.select("doc_id", "lang", "source", "n_chars", "text"))
    return (made.withColumns({"text_sha256": F.sha2("text", 256), "n_tokens": F.size("ids").cast("bigint"),
                              "decoded_sha256": F.sha2("decoded", 256)})
            .select("doc_id", "lang", "source", "n_chars", "text_sha256", "ids", "n_tokens", "decoded_sha256"))


STAGES = [
    ("language_id", language_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("suffix_array_dedup", suffix_dedup_stage),
    ("temperature_mixing", mixing_stage),
    ("sentencepiece", token_stage),
]

#: No stage but the mixing could be said in SQL; tests/llm compares the rows with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs if i == 0 else written(docs, STAGES[i - 1][0]), sf_dir)
    return docs

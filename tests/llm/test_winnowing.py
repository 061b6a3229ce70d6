import random
import re

from helpers import ODD, table
from pyspark.sql import functions as F

from tillspark.llm import winnowing as Wn


def brute(hashes, window=Wn.WINDOW):
    """(hash, pos) by the definition, from the k-gram hashes."""
    out = set()
    for s in range(max(1, len(hashes) - window + 1)):
        part = hashes[s:s + window]
        if part:
            low = min(part)
            pos = max(i for i, h in enumerate(part) if h == low)
            out.add((low, s + pos))
    return sorted(out, key=lambda x: x[1])


def gram_hashes(spark, words):
    rows = [(i, words[i:i + Wn.K]) for i in range(max(1, len(words) - Wn.K + 1))] if words else []
    df = spark.createDataFrame(rows, "i int, w array<string>")
    gram = F.xxhash64(*[F.when(F.get("w", F.lit(j)).isNotNull(), F.xxhash64(F.get("w", F.lit(j)))) for j in range(Wn.K)])
    return [r.h for r in df.select("i", F.shiftright(F.shiftleft(gram, 32), 32).cast("int").alias("h")).orderBy("i").collect()]


def test_equals_the_definition(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcd") for _ in range(n)) for n in (1, 4, 5, 6, 11, 12, 13, 40, 300)] + ["tie " * 50]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", Wn.winnow(F.col("t")).alias("p")).collect()
    for row in got:
        assert [tuple(p) for p in row.p] == brute(gram_hashes(spark, row.t.split()))


def test_shared_passage_shares_a_fingerprint(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(Wn.K + Wn.WINDOW - 1)]
    pair = [" ".join([word() for _ in range(30)] + passage + [word() for _ in range(9)]) for _ in range(2)]
    a, b = (r.s for r in spark.createDataFrame([(t,) for t in pair], "t string")
            .select(Wn.hash_set(Wn.winnow(F.col("t"))).alias("s")).collect())
    assert set(a) & set(b)


def test_query_edits_and_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Wn, "ROWS_PER_BUCKET", 3)
    rng = random.Random(7)
    texts = ODD + [" ".join(rng.choice(["one", "two", "three", "äöü", "你"]) for _ in range(60)) for _ in range(20)]
    rows = [(i * i, t) for i, t in enumerate(texts)] + [(None, "row without an id " * 9)]
    table(spark, rows, tmp_path)
    got = {r.doc_id: r for r in Wn.op1_document_fingerprints(spark, str(tmp_path)).collect()}
    order = sorted(rows, key=lambda r: -1e9 if r[0] is None else r[0], reverse=True)
    assert len(got) == len(rows)
    import hashlib
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        edited = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        assert got[i].n_chars == len(t)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
        if t == nxt:
            assert got[i].near_next == 1 and got[i].near_edited == got[i].near_edited
        if edited == t:
            assert got[i].fingerprint == got[i].edited_fingerprint and got[i].near_edited == 1


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string, prints int, _bucket int")
    assert Wn.fingerprint_pairs(empty).collect() == []
    one = spark.createDataFrame([(1, "a b c d e f", 3, 4, 5)], "doc_id bigint, text string, hashes int, _bucket int, next_text int")
    row = Wn.fingerprint_pairs(one).first()
    assert row.near_next == 1.0 and re.fullmatch("a b c.*", row.text)


def test_ids_that_span_all_longs(spark, tmp_path, monkeypatch):
    import hashlib

    monkeypatch.setattr(Wn, "ROWS_PER_BUCKET", 2)
    rows = [(-2**63, "aaaa"), (-2**62 - 7, "bb"), (5, "cccccc"), (2**62, ""), (2**63 - 1, "dddd eeee")]
    table(spark, rows, tmp_path)
    got = {r.doc_id: r.edited_sha256 for r in Wn.op1_document_fingerprints(spark, str(tmp_path)).collect()}
    order = sorted(rows, reverse=True)
    for i, (doc_id, text) in enumerate(order):
        following, half = order[(i + 1) % len(order)][1], len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        assert got[doc_id] == hashlib.sha256(edited.encode()).hexdigest()

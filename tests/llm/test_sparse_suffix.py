import random

import pytest
from helpers import ODD, table

from tillspark.llm import sparse_suffix as S


def brute(rows, length=S.LENGTH):
    """Word places covered by a passage that stands at an earlier place too."""
    first, covered = {}, set()
    for d, t in sorted(rows, key=lambda r: r[0]):
        words = (t or "").split()
        for s in range(len(words) - length + 1):
            key = tuple(words[s:s + length])
            if key in first:
                covered.update((d, s + i) for i in range(length))
            else:
                first[key] = (d, s)
    return covered


def fixture(seed=1):
    rng = random.Random(seed)
    word = lambda n=500: "w%d" % rng.randint(0, n)
    some = lambda n: [word() for _ in range(n)]
    passages = [some(n) for n in (49, 50, 51, 55, 70, 120, 300)]
    rows = list(ODD) + ["la " * 130, "a b " * 60]
    for i in range(40):
        words = some(rng.randint(0, 60))
        for p in rng.sample(passages, rng.randint(0, 3)):
            words += p + some(rng.randint(0, 20))
        rows.append(rng.choice([" ", "\n", "  "]).join(words))
    copy = " ".join(some(200))
    rows += [copy, copy, copy + " tail", " ".join(some(90) * 2)]
    order = list(range(len(rows)))
    rng.shuffle(order)
    return list(zip(order, rows))


@pytest.mark.parametrize("partitions", ["1", "3", "40"])
def test_spans_equal_all_windows(spark, tmp_path, partitions):
    rows = fixture()
    table(spark, rows, tmp_path)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = S.op5_suffix_array_dedup(spark, str(tmp_path)).collect()
    for k, v in old.items():
        spark.conf.set(k, v)
    words = {d: (t or "").split() for d, t in rows}
    covered = set()
    for r in got:
        covered.update((r.doc_id, i) for i in range(r.start_word, r.end_word))
        n = r.end_word - r.start_word
        assert n >= S.LENGTH and (r.source_doc_id, r.source_start_word) < (r.doc_id, r.start_word)
        assert words[r.doc_id][r.start_word:r.end_word] == words[r.source_doc_id][r.source_start_word:r.source_start_word + n]
    assert covered == brute(rows)


def test_cut_texts_hold_no_repeat(spark, tmp_path):
    rows = fixture(2)
    docs = table(spark, rows, tmp_path)
    out = S.without_spans(docs, S.repeated_spans(docs)).collect()
    covered = brute(rows)
    words = {d: (t or "").split() for d, t in rows}
    assert len(out) == len(rows)
    for r in out:
        assert (r.text or "").split() == [w for i, w in enumerate(words[r.doc_id]) if (r.doc_id, i) not in covered]
        if not any(d == r.doc_id for d, _ in covered):
            assert r.text == dict(rows)[r.doc_id]


def test_nulls_repeated_rows_and_empty(spark):
    text = " ".join(f"w{i}" for i in range(60))
    schema = "doc_id bigint, text string, rid int, start string"
    df = spark.createDataFrame([(None, text, 1, "x"), (3, text, 1, "x"), (3, text, 1, "x"), (4, None, 1, "x")], schema)
    (span,) = S.repeated_spans(df).collect()
    assert (span.doc_id, span.start_word, span.end_word, span.source_start_word) == (3, 0, 60, 0) and span.source_doc_id < 0
    alone = spark.createDataFrame([(3, text, 1, "x"), (3, text, 1, "x")], schema)
    assert S.repeated_spans(alone).collect() == [] and S.repeated_spans(df.limit(0)).collect() == []


def test_one_doc_id_with_two_texts(spark):
    words = lambda k, n=60: " ".join(f"{k}{i}" for i in range(n))
    rows = [(3, words("a")), (5, words("a") + " " + words("b")), (5, words("c", 150)), (5, words("d") + " x"), (5, words("d") + " y")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    spans = S.repeated_spans(df).collect()
    assert sorted((r.doc_id, r.start_word, r.end_word, r.source_doc_id) for r in spans) == [(5, 0, 60, 3), (5, 0, 60, 5)]
    out = sorted(r.text.strip() for r in S.without_spans(df, S.repeated_spans(df)).collect())
    left = [t for t in out if t in ("x", "y")]
    assert len(left) == 1
    whole = words("d") + (" y" if left == ["x"] else " x")
    assert out == sorted([words("a"), words("b"), words("c", 150), whole, *left])

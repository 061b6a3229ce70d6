import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from helpers import ODD
from pyspark.sql import functions as F

from tillspark.llm import collocations as C

SCHEMA = "doc_id bigint, text string, lang string"
LOWER = {c: c + 32 for c in range(65, 91)}


def pieces(text):
    return [re.findall("[^ \t]+", p) for p in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER))]


def expected(rows, min_count, top=2_000, share=80):
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        for words in pieces(text):
            totals[lang or "und"] += len(words)
            counts.update((lang or "und", *words[i:i + n]) for n in range(1, 5) for i in range(len(words) - n + 1))
    scored = {}
    for gram, a in counts.items():
        lang, words = gram[0], gram[1:]
        if len(words) > 1 and a >= min_count:
            cuts = [(2_000_000 * a // (counts[(lang, *words[:k])] + counts[(lang, *words[k:])]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            scored[gram] = (a, counts[(lang, *words[:k])], counts[(lang, *words[k:])], score)
    hidden = {(g[0], *g[1 + i:1 + i + n]) for g, v in scored.items() for n in range(2, len(g) - 1) for i in range(len(g) - n)
              if 100 * v[0] >= share * scored.get((g[0], *g[1 + i:1 + i + n]), (10**9,))[0]}
    out = []
    for lang in totals:
        kept = sorted((-v[3], -v[0], " ".join(g[1:]).encode(), v) for g, v in scored.items() if g[0] == lang and g not in hidden)
        out += [(lang, i + 1, phrase.decode(), v[0], v[1], v[2], totals[lang], v[3]) for i, (_, _, phrase, v) in enumerate(kept[:top])]
    return sorted(out)


def sample(n, seed=3):
    rng = random.Random(seed)
    words = ["The", "cat", "sat", "on", "a", "mat", "New", "York", "é", "a.b", "x\xa0y", "\x85", "Z" * 40] + [f"rare{i}" for i in range(300)]
    weights = [30] * 10 + [5] * 3 + [0.3] * 300
    rows = []
    for i in range(n):
        text = " ".join(rng.choices(words, weights, k=rng.randint(0, 60)))
        text = re.sub(" ", lambda m: rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n"]), text)
        rows.append((i, text, rng.choice(["en", "en", "de", None, "und"])))
    return rows


def passage(n):
    return " ".join(f"w{i}" for i in range(n))


ROWS = (sample(400) + [(1000 + i, t, "en") for i, t in enumerate(ODD)] + [(None, "of the of the of the of the", "fr")] * 9
        + [(7, passage(400), "long")] * 6 + [(8, "same " * 300, "cycle"), (9, "a b " * 200, "cycle"), (10, "end here", "long")])


@pytest.mark.parametrize("min_count, bits, block_words", [(5, 20, 500_000), (2, 4, 500_000), (3, 12, 7), (300, 16, 500_000)])
def test_equals_brute_force(spark, monkeypatch, min_count, bits, block_words):
    monkeypatch.setattr(C, "BLOCK_WORDS", block_words)
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumns({"n": F.lit(1), "phrase": F.lit("x"), "size": F.lit(None).cast("int")}).repartition(3)
    got = sorted(map(tuple, C.mine(docs, min_count=min_count, bits=bits).collect()))
    assert got == expected(ROWS, min_count)


def test_top_and_share(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    assert sorted(map(tuple, C.mine(docs, min_count=4, top=5, share=30, bits=16).collect())) == expected(ROWS, 4, 5, 30)


def test_oracle_equals_brute_force(spark, tmp_path):
    spark.createDataFrame(ROWS, SCHEMA).repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    rows = con.execute(C.SQL["op12_phrase_collocations"]).fetchall()
    assert sorted(rows) == expected(ROWS, 30)
    assert sorted(map(tuple, C.op12_phrase_collocations(spark, str(tmp_path)).collect())) == sorted(rows)


def test_empty_table(spark):
    assert C.mine(spark.createDataFrame([], SCHEMA), bits=10).collect() == []


def test_paths_hold_every_edge_once(spark):
    chain = passage(300).split()
    grams = [" ".join(chain[i:i + 4]) for i in range(297)] + ["p q p q", "q p q p", "s s s s", "w5 w6 w7 other", "in w8 w9 w10"]
    edges = spark.createDataFrame([("en", g, 10 + i) for i, g in enumerate(grams)], "lang string, phrase string, n bigint")
    paths = C.compact_paths(edges).collect()
    found = [(" ".join(p.words[i:i + 4]), n) for p in paths for i, n in enumerate(p.counts)]
    assert sorted(found) == sorted((g, 10 + i) for i, g in enumerate(grams))
    assert len(paths) < 60 and max(len(p.counts) for p in paths) > 8 and all(len(p.words) == len(p.counts) + 3 for p in paths)


def test_a_very_long_text(spark):
    rows = [(1, ("one two three four five six " * 200_000) + "end", "en"), (2, "x" * 3_000_000, "en")]
    got = C.mine(spark.createDataFrame(rows, SCHEMA), bits=12).collect()
    assert sorted(map(tuple, got)) == expected(rows, 30)


def test_words_of_equal_hash_are_told_apart():
    data = np.frombuffer(b"aabb", np.uint8)
    starts, ends, langs = np.array([0, 1, 2, 3]), np.array([1, 2, 3, 4]), np.zeros(4, np.int64)
    assert C.word_numbers(data, starts, ends, np.full(4, 7, np.uint64), langs).tolist() == [0, 0, 1, 1]
    p = C.Pieces(pa.record_batch({"text": ["Ab  c.d", None, "e"], "lang": ["x", None, "y"]}))
    assert [bytes(p.data[s:e]) for s, e in zip(p.starts, p.ends)] == [b"ab", b"c", b"d", b"e"] and p.joined.tolist() == [True, False, False, False]

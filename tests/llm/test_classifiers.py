import random
import zlib

import numpy as np
from helpers import ODD, table

from tillspark.llm import language_id as L
from tillspark.llm import quality as Q

SYLLABLES = {"en": "the ing on er at st", "de": "sch ein ung der lich te", "fr": "eau le que oi une é"}


def text(rng, lang, n=60):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))


def corpus(n=300, seed=1):
    rng = random.Random(seed)
    langs = [rng.choice(list(SYLLABLES)) for _ in range(n)]
    return [(i, text(rng, g)) for i, g in enumerate(langs)], langs


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_language_of_held_out_texts(spark, tmp_path):
    rows, langs = corpus()
    odd = [(1000 + i, t) for i, t in enumerate(ODD + ["12 34 !!", None])]
    table(spark, rows + odd, tmp_path, lang=langs + [None] * len(odd))
    got = {r.doc_id: r for r in L.op7_language_id(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows) + len(odd)
    right = [got[i].lang_pred == g for (i, _), g in zip(rows, langs) if held(i)]
    assert np.mean(right) >= 0.97
    for i, t in rows + odd:
        assert got[i].held_out == held(i) and 0 <= got[i].score <= 1
        if not any(c.isalpha() for c in t or ""):
            assert got[i].lang_pred == "und" and got[i].score == 0


def test_ftrl_is_sparse_and_temperature_calibrates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 30)).astype(np.float32)
    labels = (x[:, 0] + 0.5 * rng.normal(size=400) > 0).astype(int)
    rows = [(np.arange(30, dtype=np.int32), r) for r in x]
    w, b = L.ftrl(rows, labels, 2, 30)
    assert np.abs(w[0]).max() > 5 * np.abs(w[1:]).mean()
    logits = np.array([[0.0, 2.0]] * 90 + [[2.0, 0.0]] * 10)
    assert abs(L.softmax(logits[:1] / L.temperature(logits, np.ones(100, int)))[0, 1] - 0.9) < 0.01


def test_nothing_to_learn_from(spark, tmp_path):
    table(spark, ["some text"], tmp_path, lang=[None])
    (row,) = L.op7_language_id(spark, str(tmp_path)).collect()
    assert (row.lang_pred, row.score) == ("und", 0.0)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    (row,) = Q.op9_quality_classifier(spark, str(tmp_path)).collect()
    assert (row.score, row.predicted) == (0.0, 0)
    table(spark, [], tmp_path / "none")
    assert L.op7_language_id(spark, str(tmp_path / "none")).collect() == []


def test_quality_of_held_out_texts(spark, tmp_path):
    rng = random.Random(3)
    rows, good = [], []
    for i in range(500):
        t = text(rng, "en")
        bad = rng.random() < 0.25
        rows.append((i, t.upper().replace(" ", "!! ") if bad else t))
        good.append(0 if bad else 1)
    odd = [(1000 + i, t) for i, t in enumerate(ODD)]
    table(spark, rows + odd, tmp_path)
    marked = [(i, g, 0) for (i, _), g in zip(rows, good) if i % 2] + [(None, 1, 0), (7, None, 0), (1000, None, None)]
    spark.createDataFrame(marked, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in Q.op9_quality_classifier(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows) + len(odd)
    assert np.mean([got[i].predicted == g for (i, _), g in zip(rows, good) if held(i)]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) and r.held_out == held(r.doc_id) for r in got.values())


def test_ngram_counts_equal_slices():
    texts = ["abca", "", "a", "äöäö 你"]
    counts = L.ngram_counts(texts, (1, 2, 3), 1 << 12)
    assert counts.sum(axis=1).tolist() == [sum(max(0, len(t) - n + 1) for n in (1, 2, 3)) for t in texts]
    assert (L.ngram_counts(["xabca"[1:]], (1, 2, 3), 1 << 12)[0] == counts[0]).all()

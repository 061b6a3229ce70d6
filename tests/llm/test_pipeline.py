import random

import sentencepiece
from helpers import table
from test_dart_minhash import brute as classes
from test_sparse_suffix import brute as repeats

import corpus_pipeline as P
from tillspark.llm import sentencepiece_bpe as S
from tillspark.llm.common import documents


def fixture(seed=8):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["the", "ing", "on", "er", "at"]) for _ in range(rng.randint(1, 4)))
    texts = [" ".join(word() for _ in range(rng.randint(20, 150))) for _ in range(60)]
    passage = " ".join(word() + str(i) for i in range(60))
    texts += [texts[3], texts[4].replace("the", "the", 1) + " end", passage + " " + texts[5][:200], texts[6][:150] + " " + passage]
    texts += ["123 456 !!", "", None, passage]
    return list(enumerate(texts))


def test_stages_equal_brute_force(spark, tmp_path):
    rows = fixture()
    sources = ["big" if i % 4 else "small" for i, _ in rows]
    table(spark, rows, tmp_path, source=sources)
    docs = documents(spark, str(tmp_path))
    stage = dict(P.STAGES)
    columns = docs.columns
    lang = stage["language_id"](spark, docs, str(tmp_path)).cache()
    assert lang.columns == columns
    assert {r.doc_id for r in lang.collect()} == {i for i, t in rows if any(c.isalpha() for c in t or "")}
    left = sorted((r.doc_id, r.text) for r in lang.collect())
    near = stage["minhash_near_dedup"](spark, lang, str(tmp_path)).cache()
    assert sorted(r.doc_id for r in near.collect()) == sorted({c for _, c in classes(left)}) and near.columns == columns
    left = sorted((r.doc_id, r.text) for r in near.collect())
    cut = stage["suffix_array_dedup"](spark, near, str(tmp_path)).cache()
    gone = repeats(left)
    want = {d: [w for i, w in enumerate(t.split()) if (d, i) not in gone] for d, t in left}
    assert {r.doc_id: r.text.split() for r in cut.collect()} == {d: w for d, w in want.items() if w}
    assert gone and all(r.n_chars == len(r.text) for r in cut.collect()) and cut.columns == columns
    mixed = stage["temperature_mixing"](spark, cut, str(tmp_path)).cache()
    assert {tuple(r) for r in mixed.collect()} == {tuple(r) for r in cut.collect()} and mixed.columns == columns
    out = stage["sentencepiece"](spark, mixed, str(tmp_path)).collect()
    sp = sentencepiece.SentencePieceProcessor(model_file=S.model_path())
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert all(r.ids == sp.encode(texts[r.doc_id]) and r.decoded_sha256 == r.text_sha256 for r in out)
    run = P.run(spark, str(tmp_path))
    assert sorted(map(str, run.collect())) == sorted(map(str, out))


def test_empty_documents(spark, tmp_path):
    table(spark, [], tmp_path)
    assert P.run(spark, str(tmp_path)).collect() == []

import hashlib
import random

import sentencepiece
from helpers import ODD, table

from tillspark.llm import sentencepiece_bpe as S


def lib():
    return sentencepiece.SentencePieceProcessor(model_file=S.model_path())


def model_ids(model, texts):
    ids, offsets = S.WordPool(model.encode_words).texts([S.split_words(t) for t in texts])
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])], model.decode(ids, offsets)


def test_equals_the_library_on_odd_and_random_texts():
    sp, model, rng = lib(), S.PieceModel(S.model_path()), random.Random(3)
    texts = ["", " ", "\n", "▁a", "</s>x<unk>", "<0x0A>", "\x00a", "aaaaaaaaaaaaaaaa", "a⁇b", "한글 你好"]
    texts += [" " * k + t for k in range(70) for t in ("", "the", "\n")] + ["=" * k + "\t" * k + "-" * k for k in range(40)]
    alphabet = "abcdeth  \n\t.,!éñßü你好の한😀▁'\"01-=_/<>0xAF"
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 200))) for _ in range(1500)]
    ids, decoded = model_ids(model, texts)
    assert ids == sp.encode(texts, num_threads=1)
    assert decoded == [sp.decode(i) for i in ids]


def test_query_on_documents(spark, tmp_path):
    texts = [t for t in ODD] + ["twice", "twice"]
    table(spark, texts, tmp_path)
    sp = lib()
    got = {r.doc_id: r for r in S.op3_sentencepiece(spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = sp.encode(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string, ids string")
    assert S.decode(S.encode(empty)).collect() == []
    one = spark.createDataFrame([("a b", "own", "own")], "text string, ids string, decoded string")
    row = S.decode(S.encode(one)).first()
    assert row.decoded == "a b" and row.ids == lib().encode("a b")

import random
import zlib

import numpy as np
import pytest
from helpers import ODD, table

from tillspark.llm import token_files as TF
from tillspark.llm.common import shared_path


def expected(rows):
    tok, start, out = TF.load_tokenizer(TF.tokenizer_path()), 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("rows_per_shard", [3, 4_000])
def test_files_hold_the_library_ids_in_order(spark, tmp_path, monkeypatch, rows_per_shard):
    monkeypatch.setattr(TF, "ROWS_PER_SHARD", rows_per_shard)
    rows = [(i * 7 - 20, t) for i, t in enumerate(ODD)] + [(500, "It's 42 ''s <|endoftext|> ÀÉ İ Σς x́"), (None, "no id")]
    table(spark, rows, tmp_path)
    got = sorted(map(tuple, TF.op6_token_files(spark, str(tmp_path)).collect()), key=lambda r: r[1])
    assert got == expected(rows)


def test_sequences_are_views_with_masks(spark, tmp_path):
    docs = table(spark, ["some words here " * 500] * 3, tmp_path)
    folder = shared_path(spark, "token-files")
    (shard,) = TF.write_token_files(docs, folder, length=64).collect()
    reader = TF.ShardReader(folder, shard.shard)
    assert len(reader) == -(-shard.tokens // 64)
    flat = np.concatenate([reader.sequence(i)[0] for i in range(len(reader))])
    mask = np.concatenate([reader.sequence(i)[1].to_numpy(zero_copy_only=False) for i in range(len(reader))])
    assert mask.sum() == shard.tokens and not flat[~mask].any()
    assert (flat[mask][np.cumsum([n.as_py() for n in reader.index.column("n_tokens")]) - 1] == 2).all()


def test_ids_that_span_all_longs(spark, tmp_path):
    rows = [(-2**63, "first words"), (5, None), (2**63 - 1, "last"), (None, "none"), (6, "")]
    table(spark, rows, tmp_path)
    got = sorted(map(tuple, TF.op6_token_files(spark, str(tmp_path)).collect()), key=lambda r: r[1])
    assert got == expected(rows)


def test_empty_table(spark, tmp_path):
    table(spark, [], tmp_path)
    assert TF.op6_token_files(spark, str(tmp_path)).collect() == []


def test_parts_of_a_text_have_its_ids():
    tok, rng = TF.load_tokenizer(TF.tokenizer_path()), random.Random(4)
    encode = TF.word_encoder(tok)
    alphabet = "abcSTé'sßÀİſŉǅǆʰ0²½ \n\t\x1c\x85\xa0.,!-_<|>ªᵃ́你"
    for alpha in (alphabet, alphabet[:10], [c for c in alphabet if c < "\u0250"]):
        for _ in range(1500):
            text = "".join(rng.choice(alpha) for _ in range(rng.randint(0, 40)))
            assert encode(TF.split_text(text))[0].tolist() == tok.encode(text, add_special_tokens=False).ids, repr(text)
    text = "".join(map(chr, range(1, 0x250)))
    assert encode(TF.split_text(text))[0].tolist() == tok.encode(text, add_special_tokens=False).ids


def test_each_latin_code_point_inside_a_word():
    tok = TF.load_tokenizer(TF.tokenizer_path())
    encode = TF.word_encoder(tok)
    texts = [f"ab{chr(c)}cd {chr(c)}x 1{chr(c)}" for c in [*range(1, 0x250), 0x212A, 0x212B, 0x1E9E]]
    for text in texts + ["President Əliyev said", "Əli Bakı", "ƁAWO"]:
        assert encode(TF.split_text(text))[0].tolist() == tok.encode(text, add_special_tokens=False).ids, repr(text)

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import ODD, table

from tillspark.llm import packing as P

CAPACITY = P.LENGTH


@pytest.fixture(scope="module")
def tokenizer():
    return P.load_tokenizer(P.tokenizer_path())


def checked(rows, docs, tokenizer, capacity=CAPACITY):
    """Every id of every document in exactly one piece; sequences gapless; returns fills and pieces."""
    want = sorted(((i, tokenizer.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in docs), key=repr)
    by_sequence, got = {}, []
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at == capacity or at & (at - 1) == 0
    open_docs = {}
    for r in rows:
        open_docs.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for i, ids in want:
        pieces = open_docs[(i, len(ids))]
        at = 0
        while at < len(ids):
            p = next(p for p in pieces if p.start == at and p.ids_crc32 == zlib.crc32(np.array(ids[at:at + p.length], "<u4").tobytes()))
            pieces.remove(p)
            at += p.length
        got.append(at)
    assert not any(open_docs.values())
    return by_sequence


@pytest.mark.parametrize("most_open", [P.MAX_OPEN, 3])
def test_every_id_once_and_no_padding(spark, tmp_path, tokenizer, most_open):
    rng = random.Random(5)
    docs = [(i * 3 - 7, t) for i, t in enumerate(ODD)] + [(None, "no id"), (2**63 - 1, "wide"), (-2**63, None)]
    docs += [(1000 + i, " ".join(rng.choice(["the", "Übung", "x,y", "中文", "it's", "\n\n"]) for _ in range(rng.randint(0, 1500)))) for i in range(120)]
    docs += [docs[-1]] * 5
    rows = P.pack(table(spark, docs, tmp_path).repartition(3), most_open=most_open).collect()
    checked(rows, docs, tokenizer)


def test_query_over_whole_table(spark, tmp_path, tokenizer):
    docs = [(i, f"text {i} " * (i % 90)) for i in range(200)]
    table(spark, docs, tmp_path)
    sequences = checked(P.op13_sum_of_squares_packing(spark, str(tmp_path)).collect(), docs, tokenizer)
    assert sorted(sequences) == list(range(len(sequences)))


def test_empty_table_and_a_very_long_text(spark, tmp_path, tokenizer):
    table(spark, [], tmp_path / "none")
    assert P.op13_sum_of_squares_packing(spark, str(tmp_path / "none")).collect() == []
    docs = [(1, "some words, and  more.\n" * 220_000), (2, "short"), (3, "z" * 50_000)]
    table(spark, docs, tmp_path / "long")
    checked(P.op13_sum_of_squares_packing(spark, str(tmp_path / "long")).collect(), docs, tokenizer)


def test_choice_equals_brute_force():
    rng = random.Random(1)
    levels = P.Levels(16, lambda w: None, 10**6)
    for _ in range(2_000):
        size = rng.randint(1, 15)
        counts = [0, *(len(w) for w in levels.windows[1:]), 0]

        def squares(h):
            c = counts[:]
            if h:
                c[h] -= 1
            c[h + size] += 1
            return sum(x * x for x in c[1:16])
        options = [h for h in range(0, 16 - size + 1) if h == 0 or counts[h]]
        best = min(options, key=lambda h: (squares(h), -h))
        assert levels.choose(size) == best
        levels.place((0, 0, np.zeros(size, np.int32)))


def test_parts_of_a_text_have_its_ids(tokenizer):
    pools = [P.PartPool(tokenizer, P.ranks_path()), P.PartPool(tokenizer, None, limit=50)]

    def same(text):
        return all(P.ids_of(p, pa.array([None, text, "a b"]))[1].tolist() == tokenizer.encode(text, add_special_tokens=False).ids for p in pools)
    for c in [*range(1, 0x250), *range(0x1680, 0x1690), *range(0x2000, 0x2070), 0x3000, 0xFEFF, 0x1F600]:
        c = chr(c)
        assert same(f"ab{c}cd {c} x{c}{c}y {c}{c} {c}' {c}1 '{c}s"), repr(c)
    rng = random.Random(2)
    alphabet = [*"ab 's  \n\t.,1é你\xa0²", "<|endoftext|>", "'ll", "  ", "\n\n", "'LL", "　"]
    for _ in range(3_000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25)))
        assert same(text), repr(text)

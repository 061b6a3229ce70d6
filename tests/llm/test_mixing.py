import math
import random
from collections import Counter, defaultdict

import pytest
from helpers import ODD, table
from pyspark.sql import functions as F

from tillspark.llm import mixing as M


def fixture(n=600, seed=2):
    rng = random.Random(seed)
    sources = [rng.choices(["big", "mid", "small", None], [60, 25, 10, 5])[0] for _ in range(n)]
    return [(i, "w " * rng.randint(0, 40)) for i in range(n)], sources


def tokens_by(rows, sources, counts):
    out = defaultdict(int)
    for (i, t), s in zip(rows, sources):
        out[s] += counts[i] * len((t or "").split())
    return out


def brute_exponent(shares, good):
    """The exponent where ``good`` turns, by plain bisection (good at 0, or at 1)."""
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        w = [s ** mid for s in shares]
        w = [x / sum(w) for x in w]
        if good(w) == good([1 / len(w)] * len(w)):
            low = mid
        else:
            high = mid
    return low


def test_weights_meet_the_entropy_and_nothing_is_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(M, "ROWS_PER_BLOCK", 10)
    rows, sources = fixture()
    docs = table(spark, rows, tmp_path, source=sources)
    got = M.mix(docs).collect()
    counts = Counter(r.doc_id for r in got)
    assert set(counts) == {i for i, _ in rows} and len({(r.doc_id, r.copy) for r in got}) == len(got)
    base, taken = tokens_by(rows, sources, Counter(i for i, _ in rows)), tokens_by(rows, sources, counts)
    shares = [base[s] / sum(base.values()) for s in base]
    entropy = lambda w: -sum(x * math.log(x) for x in w if x)
    a = brute_exponent(shares, lambda w: entropy(w) >= M.TARGET_ENTROPY * math.log(len(w)))
    assert abs(M.find_exponent(M.source_table(M.token_counts(docs))) - a) < 1e-6
    w = [s ** a for s in shares]
    budget = max(base[s] / (x / sum(w)) for s, x in zip(base, w))
    for s, x in zip(base, w):
        assert abs(taken[s] - budget * x / sum(w)) <= 40  # one document
    assert entropy([t / sum(taken.values()) for t in taken.values()]) >= 0.945 * math.log(len(base))


def test_repetition_limit_and_budget(spark, tmp_path):
    rows, sources = fixture(seed=5)
    docs = table(spark, rows, tmp_path, source=sources)
    counts = Counter(r.doc_id for r in M.mix(docs, "repeat", max_repeat=2.0).collect())
    assert max(counts.values()) == 2 and min(counts.values()) == 1
    small = tokens_by(rows, sources, Counter(r.doc_id for r in M.mix(docs, budget=1000.0).collect()))
    assert 1000 <= sum(small.values()) <= 1000 + 4 * 40


def test_blocks_are_cut_in_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(M, "ROWS_PER_BLOCK", 10)
    rows, sources = fixture(seed=6)
    docs = table(spark, rows, tmp_path, source=sources)
    all_rows = M.mix(docs, budget=5e4).filter("copy = 0").collect()
    some = M.mix(docs, budget=3000.0).collect()
    for s in set(sources):
        order = sorted([r for r in all_rows if r.source == s], key=lambda r: (r.block, r.place))
        taken = {r.doc_id for r in some if r.source == s}
        assert taken == {r.doc_id for r in order[:len(taken)]}


def test_odd_rows_and_empty_table(spark, tmp_path):
    docs = table(spark, ODD + ["same", "same"], tmp_path).withColumn("block", F.lit("own"))
    assert {r.doc_id for r in M.mix(docs).collect()} == set(range(len(ODD) + 2))
    assert M.mix(docs.limit(0)).collect() == []
    blank = table(spark, [(1, None), (1, None), (None, " ")], tmp_path / "blank")
    assert sorted((r.doc_id or 0, r.copy) for r in M.mix(blank).collect()) == [(0, 0), (1, 0), (1, 0)]
    with pytest.raises(TypeError):
        M.mix(docs, nonsense=1)


@pytest.mark.parametrize("budget", [None, 30_000.0])
def test_each_block_has_the_weights(spark, tmp_path, monkeypatch, budget):
    monkeypatch.setattr(M, "ROWS_PER_BLOCK", 500)
    sources = ["hot"] * 8_000 + ["mid"] * 300 + ["tiny"] * 12
    docs = table(spark, [f"w{i} " + "w " * (i % 7 + 5) for i in range(len(sources))], tmp_path, source=sources)
    got = M.token_counts(M.mix(docs, budget=budget)).select("doc_id", "source", "copy", "block", "place", "n_tokens").collect()
    blocks, total = defaultdict(Counter), Counter()
    for r in got:
        blocks[r.block][r.source] += r.n_tokens
        total[r.source] += r.n_tokens
    assert len(blocks) > 5 and sorted(blocks) == list(range(len(blocks)))
    every = sum(total.values())
    for b in blocks.values():
        assert abs(sum(b.values()) - every / len(blocks)) < 0.25 * every / len(blocks)
        assert all(abs(b[s] / sum(b.values()) - total[s] / every) < 0.08 for s in total)
    order = [(r.doc_id, r.copy) for r in sorted(got, key=lambda r: (r.block, r.place))]
    last = {}
    for doc, copy in order:
        assert copy == last.get(doc, -1) + 1 or (budget and doc not in last)
        last[doc] = copy

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillspark.operators import selection as S


@pytest.mark.parametrize("n, k, spread", [(3, 5, 2), (5, 5, 1), (7, 5, 3), (997, 4, 20), (4_000, 5, 10**6), (2_000, 7, 0)])
def test_cuts_equal_ntile_on_ties(spark, n, k, spread):
    rng = random.Random(n + k)
    ids = sorted({rng.randint(-2**62, 2**62) for _ in range(n)}) if n > 100 else list(range(n))
    rng.shuffle(ids)
    df = spark.createDataFrame([(i, rng.randint(0, spread), rng.randint(-2**60, 2**60)) for i in ids], "id long, a long, b long").repartition(3)
    measures = {"ta": F.col("a"), "td": -F.col("a"), "tb": F.col("b")}
    want = df.withColumns({m: F.ntile(k).over(Window.orderBy(c, "id")) for m, c in measures.items()})
    got = S.ntiles_by_cuts(df, "id", measures, k)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Window" not in plan and "rangepartitioning" not in plan and "Join" not in plan


def test_cuts_of_no_rows(spark):
    df = spark.createDataFrame([], "id long, a long")
    assert S.ntiles_by_cuts(df, "id", {"t": F.col("a")}, 5).collect() == []


def test_values_at_ranks(spark):
    rng = random.Random(9)
    values = {g: sorted(rng.choice([-2**63, 2**63 - 1, 0, 7, rng.randint(-50, 50)]) for _ in range(400)) for g in "ab"}
    pairs = spark.createDataFrame([(g, v) for g, vs in values.items() for v in vs], "g string, v long")
    ranks = {g: [0, 1, 57, 200, 399] for g in "ab"}
    for buckets in (2, 1_024):
        got = S.values_at(pairs, ranks, S.group_sizes(pairs), buckets)
        assert got == {(g, r): (values[g][r], values[g].index(values[g][r])) for g in "ab" for r in ranks[g]}


def test_quantiles_of_a_million_values_with_a_hot_month(spark):
    df = spark.range(1_000_000).select(F.when(F.col("id") % 3 > 0, 1).otherwise(2 + F.col("id") % 11).cast("int").alias("m"),
                                       F.pmod(F.xxhash64("id"), F.lit(10**9)).alias("v"))
    got = {r.m: (r.q0, r.q1, r.q2) for r in S.quantiles_by_counts(df, "m", F.col("v"), [0.25, 0.5, 0.99], 100.0).collect()}
    want = {r.m: tuple(x / 100 for x in r.q) for r in df.groupBy("m").agg(F.percentile("v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.99))).alias("q")).collect()}
    assert set(got) == set(want)
    assert all(a == pytest.approx(b, rel=1e-12) for m in got for a, b in zip(got[m], want[m]))


def test_quantiles_of_few_rows_and_nulls(spark):
    df = spark.createDataFrame([(1, 5), (2, 7), (2, 8), (2, None), (None, 3), (3, None)], "m int, v int")
    got = S.quantiles_by_counts(df, "m", F.col("v"), [0.0, 0.5, 1.0])
    assert [tuple(r) for r in got.collect()] == [(1, 5.0, 5.0, 5.0), (2, 7.0, 7.5, 8.0)]


def test_many_ranks_are_refused(spark):
    with pytest.raises(ValueError):
        S.values_at(spark.createDataFrame([("a", 1)], "g string, v long"), {"a": list(range(S.MAX_RANKS + 1))}, {"a": (1, 1, 1)})

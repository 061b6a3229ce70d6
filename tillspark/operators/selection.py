"""Ranks found by counting: quantiles and NTILE cuts without sorting the rows.

To find the value at a rank, the interval that holds it is cut into equal buckets and the rows
are counted per bucket; the bucket with the rank is the next interval, until it is one value.
A pass over the rows moves only counts (map-side sums of at most ``BUCKETS`` buckets an
interval), and all ranks of all groups narrow in the same passes. Values are whole numbers
(money as cents), so a range of 2**40 takes three passes with 16,384 buckets. What the driver holds
is one interval per asked rank: groups must be few (months, measures), never keys of the data.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillspark.session import written

BUCKETS = 16_384
MAX_RANKS = 10_000


def group_sizes(pairs: DataFrame) -> dict:
    """{g: (rows, least, greatest)} of the pairs (g, v)."""
    rows = pairs.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
    return {r.g: (r.n, r.lo, r.hi) for r in rows}


def values_at(pairs: DataFrame, ranks: dict, sizes: dict, buckets: int = BUCKETS) -> dict:
    """{(g, rank): (value, rows of the group below that value)} for ranks counted from 0.

    ``pairs`` has columns g and v (whole numbers, not NULL) and is read once a pass.
    """
    if sum(map(len, ranks.values())) > MAX_RANKS:
        raise ValueError(f"more than {MAX_RANKS} ranks: use quantiles.exact_quantiles for many groups")
    spark, out = pairs.sparkSession, {}
    kind = pairs.schema["g"].dataType
    # (g, lo, hi) -> rows of g below lo, and the ranks still sought in it
    open_ = {(g, *sizes[g][1:]): (0, sorted(set(r))) for g, r in ranks.items() if r}
    while open_:
        for (g, lo, hi), (below, sought) in list(open_.items()):
            if lo == hi:
                out.update({(g, r): (lo, below) for r in sought})
                del open_[(g, lo, hi)]
        if not open_:
            break
        steps = {k: -(-(k[2] - k[1] + 1) // buckets) for k in open_}
        schema = T.StructType([T.StructField("g", kind), *(T.StructField(c, T.DecimalType(20, 0)) for c in ("lo", "hi", "step"))])
        bounds = F.broadcast(spark.createDataFrame([(k[0], *map(Decimal, (k[1], k[2], steps[k]))) for k in open_], schema))
        v = F.col("v").cast("decimal(20,0)")
        inside = pairs.join(bounds, "g").filter((v >= F.col("lo")) & (v <= F.col("hi")))
        place = F.expr("CAST((CAST(v AS DECIMAL(20,0)) - lo) div step AS INT)")
        counts = defaultdict(list)
        for r in inside.groupBy("g", "lo", "hi", place.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect():
            counts[(r.g, int(r.lo), int(r.hi))].append((r.b, r.n))
        following = {}
        for key, (below, sought) in open_.items():
            g, lo, hi = key
            step, found = steps[key], sorted(counts[key])
            ends = []
            for _, n in found:
                ends.append((ends[-1] if ends else below) + n)
            for rank in sought:
                i = bisect.bisect_right(ends, rank)
                first = lo + found[i][0] * step
                narrow = (g, first, min(hi, first + step - 1))
                following.setdefault(narrow, (ends[i] - found[i][1], []))[1].append(rank)
        open_ = following
    return out


def quantiles_by_counts(df: DataFrame, group: str, value: Column, probs: Sequence[float], scale: float = 1.0) -> DataFrame:
    """One row per group: ``q0, q1, ...``, linearly interpolated like ``percentile``.

    ``value`` is a whole number (NULL does not count) and is divided by ``scale`` in the result.
    The result has a row a group, and so few rows that they are made on the driver.
    """
    pairs = written(df.select(F.col(group).alias("g"), value.cast("bigint").alias("v")).filter("g IS NOT NULL AND v IS NOT NULL"), "pairs")
    sizes = group_sizes(pairs)
    spots = {(g, i): (n - 1) * p for g, (n, _, _) in sizes.items() for i, p in enumerate(probs)}
    ranks = defaultdict(list)
    for (g, _), h in spots.items():
        ranks[g] += [int(h), min(int(h) + (h > int(h)), sizes[g][0] - 1)]
    at = values_at(pairs, ranks, sizes)

    def quantile(g, i):
        h = spots[(g, i)]
        low, high = (at[(g, r)][0] / scale for r in (int(h), min(int(h) + (h > int(h)), sizes[g][0] - 1)))
        return low + (h - int(h)) * (high - low)
    schema = T.StructType([T.StructField(group, df.schema[group].dataType), *(T.StructField(f"q{i}", T.DoubleType()) for i in range(len(probs)))])
    return df.sparkSession.createDataFrame([(g, *(quantile(g, i) for i in range(len(probs)))) for g in sorted(sizes)], schema)


def tile_starts(n: int, k: int) -> list[int]:
    """Rank of the first row of each tile but the first, of ``n`` rows in ``k`` tiles."""
    return [s for s in (j * (n // k) + min(j, n % k) for j in range(1, k)) if s < n]


def ntiles_by_cuts(df: DataFrame, key: str, measures: dict[str, Column], k: int) -> DataFrame:
    """``df`` with NTILE(k) columns (name -> whole-number measure, ascending; ties by ``key``).

    ``key`` is a unique whole number; no measure is NULL. Cut rows (the first of each tile) are
    found by counting: first their values, then, among equal values, their keys. Every score is
    then an expression over literals, in one pass and without a shuffle. ``df`` is read a few
    times: pass a written table.
    """
    long = df.select(F.col(key).cast("bigint").alias("_k"), F.explode(F.array(*[
        F.struct(F.lit(m).alias("g"), c.cast("bigint").alias("v")) for m, c in measures.items()])).alias("_s")).select("_k", "_s.*")
    sizes = group_sizes(long)
    ranks = {m: tile_starts(n, k) for m, (n, _, _) in sizes.items()}
    at = values_at(long.select("g", "v"), ranks, sizes)
    ties = defaultdict(list)  # among rows of a cut's value, the key at the rank that is left
    for m in ranks:
        for r in ranks[m]:
            value, below = at[(m, r)]
            ties[f"{m}:{value}"].append(r - below)
    keys = {}
    if ties:
        equal = F.concat_ws(":", F.col("g"), F.col("v").cast("string"))
        few = F.broadcast(df.sparkSession.createDataFrame([(g,) for g in ties], "g string"))
        tied = written(long.select(equal.alias("g"), F.col("_k").alias("v")).join(few, "g", "left_semi"), "ties")
        keys = values_at(tied, ties, group_sizes(tied))
    scores = {}
    for m, c in measures.items():
        score = F.lit(1)
        for r in ranks.get(m, []):
            value, below = at[(m, r)]
            first = keys[(f"{m}:{value}", r - below)][0]
            v = c.cast("bigint")
            score = score + ((v > value) | ((v == value) & (F.col(key) >= first))).cast("int")
        scores[m] = score.cast("int")
    return df.withColumns(scores)

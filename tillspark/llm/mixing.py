"""Mixing sources to target weights by temperature, in DataFrame functions only.

1. Tokens (words) are counted for each source; ``p`` is a source's share of them.
2. Weights are ``p ** a`` normalised. The exponent ``a`` in [0, 1] is found by nested
   bisection: entropy falls and the largest repetition falls as ``a`` grows, so ``a`` is the
   largest exponent whose entropy reaches ``target_entropy`` times that of equal weights
   (``mode="entropy"``), or the smallest whose repetition stays within ``max_repeat``
   (``mode="repeat"``). Each pass evaluates 64 exponents in one aggregate over the source
   table, so the table may have any number of sources and only 64 numbers reach the driver.
3. The token budget goes to the sources by weight. By default it is the least budget that
   passes over every source at least once, so nothing is dropped: sources of small share
   are repeated. A given ``budget`` may cut sources short.
4. Each pass over a source takes its documents in the order of a hash, drawn anew for the pass;
   the last pass ends where the source's tokens are spent. Only sums of slots (parts of equal
   width of the hash's range) are accumulated, then the rows of one slot a source, over a narrow
   table without texts; what remains is one row a source that says where its last pass ends.
5. One number of blocks for all sources follows from the budget: about ``ROWS_PER_BLOCK``
   taken rows each (more where that were over ``MAX_BLOCKS`` blocks). All passes of a source,
   one after the other, are stretched over the whole mixed order, so each block holds about
   the same part of what is taken of every source, which are the target weights; a source of
   which fewer documents are taken than there are blocks is in some blocks only. Documents
   are placed in one pass over the full table, without a shuffle of texts.

Defined cases: a null source is a source of its own; null or blank texts have no tokens and
are taken once in each whole pass; without any tokens every document is taken once; repeated
rows are documents of their own and go to the same places, so the last pass takes all or
none of them; an input column named like an added one is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import documents, written

TARGET_ENTROPY = 0.95
MAX_REPEAT = 4.0
GRID = 64
PASSES = 4
ROWS_PER_BLOCK = 500
MAX_BLOCKS = 100_000
UNIT = 2.0 ** 52
ADDED = ["copy", "block", "place"]


def token_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_tokens``: the words (runs of non-blank characters) of its text."""
    return docs.withColumn("n_tokens", F.coalesce(F.regexp_count("text", F.lit(r"\S+")), F.lit(0)).cast("bigint"))


def source_table(counted: DataFrame) -> DataFrame:
    """One row a source: tokens, docs and share of all tokens."""
    sums = written(counted.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")), "sources")
    total = sums.agg(F.sum("tokens")).first()[0] or 0
    return sums.withColumn("share", F.col("tokens") / F.lit(max(1, total)))


def find_exponent(sources: DataFrame, mode: str = "entropy", target_entropy: float = TARGET_ENTROPY,
                  max_repeat: float = MAX_REPEAT) -> float:
    """The exponent of the target, by sections of ``GRID`` steps (six bisections) a pass."""
    some = sources.filter("share > 0")
    n = some.count()
    if n < 2:
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(PASSES):
        step = (high - low) / GRID
        grid = some.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(GRID))))
        # logs are taken relative to the largest share, so that no power vanishes
        w = F.pow(F.col("share"), F.lit(low) + F.col("k") * step)
        at = (grid.withColumn("w", w).groupBy("k").agg(
            F.sum("w").alias("s"), F.sum(F.col("w") * F.log("w")).alias("wl"),
            F.max(F.col("w") / F.col("share")).alias("most"), F.min(F.col("w") / F.col("share")).alias("least"))
            .select("k", (F.log("s") - F.col("wl") / F.col("s")).alias("entropy"), (F.col("most") / F.col("least")).alias("repeat"))
            .collect())
        if mode == "entropy":
            fits = [r.k for r in at if r.entropy >= target_entropy * math.log(n) - 1e-12]
            k = max(fits, default=0)
            low, high = low + k * step, low + min(k + 1, GRID) * step
        else:
            fits = [r.k for r in at if r.repeat <= max_repeat * (1 + 1e-12)]
            k = min(fits, default=GRID)
            low, high = low + max(k - 1, 0) * step, low + k * step
    return low if mode == "entropy" else high


def source_weights(sources: DataFrame, exponent: float, budget: float | None = None) -> DataFrame:
    """source, tokens, docs, share, weight, and ``passes`` over the source (may be a fraction)."""
    sources = sources.withColumn("w", F.when(F.col("share") > 0, F.pow("share", F.lit(exponent))).otherwise(0.0))
    row = sources.agg(F.sum("w").alias("s"), F.max(F.col("tokens") / F.when(F.col("w") > 0, F.col("w"))).alias("most")).first()
    if not row.s:
        return sources.withColumns({"weight": F.lit(0.0), "passes": F.lit(1.0)}).drop("w")
    budget = budget if budget is not None else row.most * row.s
    weight = F.col("w") / F.lit(row.s)
    passes = F.when(F.col("tokens") > 0, weight * F.lit(float(budget)) / F.col("tokens")).otherwise(1.0)
    # a pass short of or beyond a whole number by rounding alone is that number
    whole = F.round(passes)
    return sources.withColumns({"weight": weight, "passes": F.when(F.abs(passes - whole) < 1e-9, whole).otherwise(passes)}).drop("w")


def dealt(rows: DataFrame, copy) -> DataFrame:
    """Adds ``_deal`` in [0, UNIT), the order of the row ``_row`` in the given pass."""
    return rows.withColumn("_deal", F.shiftrightunsigned(F.xxhash64(copy, "_row"), 12))


def last_pass_ends(counted: DataFrame, weights: DataFrame) -> DataFrame:
    """One row a source: _source, _passes, _whole passes, and where the last pass ends: the
    greatest ``_deal`` taken (_last) and a bound of those not taken (_until); null without one."""
    slots = F.greatest(F.lit(1), F.least(F.lit(MAX_BLOCKS), F.ceil(F.col("docs") / ROWS_PER_BLOCK))).cast("int")
    plan = weights.select(F.col("source").alias("_source"), F.col("passes").alias("_passes"),
                          F.floor("passes").cast("int").alias("_whole"), slots.alias("_slots"),
                          (F.col("tokens") * (F.col("passes") - F.floor("passes"))).alias("_spend"))
    rows = dealt(counted.join(plan, F.col("source").eqNullSafe(F.col("_source"))).filter("_spend > 0"), F.col("_whole"))
    rows = rows.withColumn("_slot", F.floor(F.col("_deal") / UNIT * F.col("_slots")).cast("int"))
    sums = rows.groupBy("_source", "_slot").agg(F.sum("n_tokens").alias("t"), F.first("_spend").alias("_spend"))
    before = F.sum("t").over(W.partitionBy("_source").orderBy("_slot")) - F.col("t")
    end = (sums.withColumn("_before", before).filter(F.col("_before") < F.col("_spend"))
           .groupBy("_source").agg(F.max(F.struct("_slot", "_before")).alias("e"), F.first("_spend").alias("_left"))
           .select(F.col("_source").alias("_s"), F.col("e._slot").alias("_end"), (F.col("_left") - F.col("e._before")).alias("_left")))
    inside = rows.join(end, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_slot") == F.col("_end")))
    places = inside.groupBy("_s", "_deal").agg(F.sum("n_tokens").alias("t"), F.first("_left").alias("_left"),
                                               F.first((F.col("_end") + 1) / F.col("_slots") * UNIT).alias("_bound"))
    upto = F.sum("t").over(W.partitionBy("_s").orderBy("_deal")) - F.col("t")
    taken = F.col("_upto") < F.col("_left")
    last = (places.withColumn("_upto", upto).groupBy("_s").agg(
        F.max(F.when(taken, F.col("_deal"))).alias("_last"),
        F.coalesce(F.min(F.when(~taken, F.col("_deal"))).cast("double"), F.first("_bound")).alias("_until")))
    return (plan.join(last, F.col("_source").eqNullSafe(F.col("_s")), "left")
            .select("_source", "_passes", "_whole", "_last", "_until"))


def block_count(weights: DataFrame) -> int:
    """The number of blocks, common to all sources, for the rows that the budget takes."""
    rows = weights.agg(F.sum(F.col("docs") * F.col("passes"))).first()[0] or 0
    return max(1, min(MAX_BLOCKS, math.ceil(rows / ROWS_PER_BLOCK)))


def mix(docs: DataFrame, mode: str = "entropy", budget: float | None = None, seed: int = 1, **target) -> DataFrame:
    """One row for each time a document is taken: ``docs`` with copy (from 0), block and place.

    Ordering by block and place gives the mixed order: each block holds documents of all
    sources by their weights, in a hash order, and a source's copies follow each other.
    """
    docs = docs.drop(*ADDED)
    keyed = docs.withColumn("_row", F.xxhash64(F.lit(seed), "doc_id", "text"))
    counted = written(token_counts(keyed).select("source", "_row", "n_tokens"), "tokens")
    sources = source_table(counted)
    weights = written(source_weights(sources, find_exponent(sources, mode, **target), budget), "weights")
    blocks = block_count(weights)
    ends = written(last_pass_ends(counted, weights), "ends")  # one row a source
    rows = keyed.join(ends, F.col("source").eqNullSafe(F.col("_source")))
    rows = dealt(rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("_whole")))), F.col("copy"))
    whole = F.col("copy") < F.col("_whole")
    rows = rows.filter(whole | (F.col("_deal") <= F.col("_last")))
    # the taken part of the last pass is stretched over its share of the order
    part = F.when(whole, F.col("_deal") / UNIT).otherwise(F.col("_deal") / F.col("_until") * (F.col("_passes") - F.col("_whole")))
    rows = rows.withColumn("_at", (F.col("copy") + part) / F.col("_passes"))
    within = lambda n: F.least(F.floor(F.col("_at") * n), F.lit(int(n) - 1))
    return rows.withColumns({"block": within(blocks).cast("int"), "place": within(UNIT)}).select(*docs.columns, *ADDED)


def op10_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "source", "copy", "block", "place")


QUERIES = {"op10_temperature_mixing": op10_temperature_mixing}

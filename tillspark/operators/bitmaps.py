"""Exact distinct counts from stored bitmaps that merge over any period.

``count(DISTINCT a), count(DISTINCT b)`` multiplies every line by the number of counted columns
and leaves nothing that a later report could reuse. Here each counted key (dense, so its values
fill few buckets) is reduced to its distinct (day, key) pairs and then to bitmaps of 32,768 bits,
one row per (day, kind, bucket). A month is the OR of its days, all time the OR of the months,
and a count is the number of set bits: no line is read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_bits(lines: DataFrame, groups: Sequence[str], kinds: dict[str, Column], deal: Sequence[str] | None = None,
                  parts: int = 0) -> DataFrame:
    """(groups, kind, bucket, bits) of the keys in ``kinds`` (name -> non-negative whole number;
    NULL does not count).

    The distinct pairs, not bitmaps, are exchanged: a bitmap is made where all pairs of its bucket
    are. A bitmap begun in every task would move tasks x groups x buckets of them, which grows
    with the square of the lines. With ``deal`` (some of the groups) pairs are dealt by these and
    one of ``parts`` of the buckets, so few tasks have rows of one value of ``deal``.
    """
    key = F.explode(F.array(*[F.struct(F.lit(i).alias("kind"), key.cast("bigint").alias("key")) for i, key in enumerate(kinds.values())]))
    pairs = (lines.select(*groups, key.alias("_k")).select(*groups, "_k.kind", "_k.key").filter(F.col("key").isNotNull()).distinct()
             .select(*groups, "kind", F.bitmap_bucket_number("key").alias("bucket"), F.bitmap_bit_position("key").alias("_bit")))
    names = F.array(*[F.lit(k) for k in kinds])
    part = F.pmod(F.xxhash64("kind", "bucket"), F.lit(parts)) if deal else F.xxhash64("kind", "bucket")
    pairs = pairs.withColumn("_part", part).repartition(*(deal or groups), "_part")
    return (pairs.groupBy(*groups, "_part", "kind", "bucket")
            .agg(F.bitmap_construct_agg("_bit").alias("bits"))
            .select(*groups, F.element_at(names, F.col("kind") + 1).alias("kind"), "bucket", "bits"))


def merged_bits(bits: DataFrame, groups: Sequence[str | Column]) -> DataFrame:
    """The same bitmaps over a coarser grouping (months of days, all time of months)."""
    return bits.groupBy(*groups, "kind", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counts_of_bits(bits: DataFrame, groups: Sequence[str | Column], kinds: Sequence[str]) -> DataFrame:
    """One row per group with the distinct count of each kind."""
    merged = merged_bits(bits, groups).withColumn("_n", F.bitmap_count("bits"))
    names = [g if isinstance(g, str) else merged.columns[i] for i, g in enumerate(groups)]
    return merged.groupBy(*names).agg(*[
        F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("_n"))), F.lit(0)).cast("bigint").alias(k) for k in kinds])

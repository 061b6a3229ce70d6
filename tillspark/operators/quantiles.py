"""Exact quantiles per group without a group in one task.

``percentile`` keeps a value -> count map per group and merges it in one task, so a
group with many distinct values (a month holding a third of the lines) becomes one big
task. Here:

1. distinct (group, value) pairs with their counts (partial aggregation: a hot value
   ships one row per map task);
2. the pairs are range-partitioned on (group, value); each range keeps a running count
   (a window over the range id, so a range moves whole and ranges are balanced), and a
   table of per-range totals (one row per range) is broadcast to turn running counts
   into global ranks;
3. each group's first rank and size give the ranks a quantile needs (linear
   interpolation between ranks floor(h) and ceil(h), h = (n - 1) p), and the pairs
   covering those ranks are picked by a join on the group plus a range filter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillspark.session import written


def exact_quantiles(df: DataFrame, groups: Sequence[str], value: str, probs: Sequence[float],
                    num_partitions: int | None = None) -> DataFrame:
    """One row per group: ``q0, q1, ...`` for ``probs`` (linear interpolation, as
    ``percentile`` / ``quantile_cont``). NULL values are ignored."""
    groups = list(groups)
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [*groups, value]
    pairs = (df.filter(F.col(value).isNotNull()).groupBy(*order).agg(F.count(F.lit(1)).alias("_c")))
    # written once: every branch below must see the same (sampled) ranges
    ranged = written(pairs.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id()), "ranged")
    run = F.sum("_c").over(Window.partitionBy("_pid").orderBy(*order)
                           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    totals = ranged.groupBy("_pid").agg(F.sum("_c").alias("_t"))
    offsets = totals.select("_pid", F.coalesce(F.sum("_t").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    cum = (ranged.withColumn("_run", run).join(F.broadcast(offsets), "_pid")
           .withColumn("_end", F.col("_off") + F.col("_run"))
           .withColumn("_start", F.col("_end") - F.col("_c")))
    gstats = cum.groupBy(*groups).agg(F.min("_start").alias("_gs"), F.sum("_c").alias("_n"))
    targets = gstats.select(*groups, "_gs", "_n", F.explode(F.array(
        *[F.struct(F.lit(i).alias("qi"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)])).alias("_q"))
    h = (F.col("_n") - 1) * F.col("_q.p")
    targets = targets.select(*groups, F.col("_q.qi").alias("qi"), h.alias("_h"),
                             (F.col("_gs") + F.floor(h)).alias("_rlo"), (F.col("_gs") + F.ceil(h)).alias("_rhi"))
    hit = cum.select(*groups, value, "_start", "_end").join(targets, groups)
    inside = lambda r: (F.col("_start") <= F.col(r)) & (F.col(r) < F.col("_end"))
    picked = hit.filter(inside("_rlo") | inside("_rhi")).groupBy(*groups, "qi", "_h", "_rlo").agg(
        F.max(F.when(inside("_rlo"), F.col(value))).alias("_vlo"),
        F.max(F.when(inside("_rhi"), F.col(value))).alias("_vhi"))
    frac = F.col("_h") - F.floor(F.col("_h"))
    q = F.col("_vlo") + frac * (F.col("_vhi") - F.col("_vlo"))
    wide = picked.groupBy(*groups).pivot("qi", list(range(len(probs)))).agg(F.first(q))
    return wide.select(*groups, *[F.col(str(i)).alias(f"q{i}") for i in range(len(probs))])

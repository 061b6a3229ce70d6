"""Global row numbers and NTILE without a single-partition window.

``ntile(k).over(Window.orderBy(...))`` plans an ``Exchange SinglePartition``: every row
goes through one task. Here the rows are range-partitioned on the order instead, each
partition numbers its rows locally, and a table of per-partition counts (one row per
partition, so its size is bounded by the partition count, not the data) is broadcast to
turn local positions into global ones. The NTILE bucket then follows in closed form from
the global position and the total count.

The ranged rows are written once with their position (partition and row number), because
counts and numbering must see the same partitions: range bounds are sampled anew whenever
such a plan runs again, so two plans need not agree. Whatever is evicted or recomputed
later reads the written rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillspark.session import written

_PID, _MID, _LRN, _OFF, _TOT = "_rk_pid", "_rk_mid", "_rk_lrn", "_rk_off", "_rk_total"


def _cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def global_row_number(df: DataFrame, order: Sequence[str | Column], out: str = "row_number",
                      num_partitions: int | None = None, with_total: str | None = None) -> DataFrame:
    """1-based position of each row in ``order``; ``order`` must be total (end with a key).

    Optionally adds the total row count as column ``with_total``.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order_cols = _cols(order)
    ranged = (df.repartitionByRange(n, *order_cols)
              .sortWithinPartitions(*order_cols)
              .withColumn(_PID, F.spark_partition_id())
              .withColumn(_MID, F.monotonically_increasing_id()))
    # monotonically_increasing_id = (partition index << 33) + position in partition.
    ranged = ranged.withColumn(_LRN, F.col(_MID) - F.shiftleft(F.col(_PID).cast("bigint"), 33) + 1)
    ranged = written(ranged.drop(_MID), "ranged")

    counts = ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy(_PID)  # over at most n rows: one per partition
    offsets = counts.select(
        _PID,
        F.coalesce(F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(_OFF),
        F.sum("_cnt").over(Window.partitionBy()).alias(_TOT))
    numbered = ranged.join(F.broadcast(offsets), _PID).withColumn(out, F.col(_OFF) + F.col(_LRN))
    if with_total:
        numbered = numbered.withColumn(with_total, F.col(_TOT))
    return numbered.drop(_PID, _LRN, _OFF, _TOT)


def ntile_expr(rn: Column, total: Column, k: int) -> Column:
    """NTILE(k) of the row at 1-based position ``rn`` among ``total`` rows.

    The first ``total % k`` tiles hold one row more than the others.
    """
    q = F.floor(total / k).cast("bigint")
    r = total % k
    big = r * (q + 1)
    tile = F.when(q == 0, rn) \
        .when(rn <= big, F.floor((rn - 1) / (q + 1)) + 1) \
        .otherwise(r + F.floor((rn - 1 - big) / q) + 1)
    return tile.cast("int")


def scalable_ntile(df: DataFrame, k: int, order: Sequence[str | Column], out: str = "ntile",
                   num_partitions: int | None = None) -> DataFrame:
    """``ntile(k) over (order by order)`` computed in parallel (same result)."""
    numbered = global_row_number(df, order, out="_nt_rn", num_partitions=num_partitions,
                                 with_total="_nt_total")
    return numbered.withColumn(out, ntile_expr(F.col("_nt_rn"), F.col("_nt_total"), k)) \
        .drop("_nt_rn", "_nt_total")


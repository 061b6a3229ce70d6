"""Sharding by extendible hashing: only oversized buckets split on another hash bit.

A document's key is hashed to 64 bits. A shard is a prefix of hash bits; the directory holds
every shard's prefix. A bucket whose documents exceed the byte limit splits on the next bit,
all others stay as they are, so shard depths differ and no document of a small bucket moves.

Sizes are counted once for all prefixes of up to ``d`` bits, where ``d`` is chosen so that the
finest buckets are about 1/64 of the limit; a shard is the shortest prefix that fits.
Buckets still too large at ``d`` bits are counted again ``STEP`` bits deeper, and they alone.
Documents that share all 64 bits (copies of one key) have further bits from a salt: their
number in the written key table, hashed. A document larger than the limit is a shard alone.

Defined cases: null keys hash as a key of their own and are split by the salt; null text has
no bytes; an empty table has no shards; repeated rows are sharded each.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, written

LIMIT = 16 << 20
FINER = 6
STEP = 8
BITS = 64
MOST_BITS = 2 * BITS


def bits_of(value: Column) -> Column:
    """The 64 bits of a long as a string of 0 and 1."""
    return F.lpad(F.bin(value), BITS, "0")


def size_of(docs: DataFrame, column: str = "text") -> Column:
    return F.coalesce(F.octet_length(column), F.lit(0)).cast("bigint")


def keyed(docs: DataFrame, key: str = "doc_id", number: Column | None = None) -> DataFrame:
    """key, bytes, n and bits of every row, written once: key hash bits, then the salt bits of
    the row's number ``n``, fixed by the writing."""
    number = F.monotonically_increasing_id() if number is None else number
    rows = written(docs.select(F.col(key).alias("key"), size_of(docs).alias("bytes"), number.alias("n")), "keys")
    return rows.withColumn("bits", F.concat(bits_of(F.xxhash64("key")), bits_of(F.xxhash64(F.lit("salt"), "n"))))


def directory(keys: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row a shard: shard (its bits), depth, shard_bytes, shard_docs."""
    total = keys.agg(F.sum("bytes")).first()[0]
    if total is None:
        return keys.select(F.lit("").alias("shard"), F.lit(0).alias("depth"), F.lit(0).cast("bigint").alias("shard_bytes"),
                           F.lit(0).cast("bigint").alias("shard_docs")).limit(0)
    low, high = 0, min(MOST_BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + FINER)
    rest, found = keys, None
    while True:
        fine = rest.groupBy(F.substring("bits", 1, high).alias("fine")).agg(
            F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("docs"))
        fine = written(fine, "buckets")
        # every prefix of a fine bucket, from the depth already known to be too small
        prefixes = (fine.withColumn("depth", F.explode(F.sequence(F.lit(low), F.lit(high))))
                    .withColumn("shard", F.substring("fine", F.lit(1), F.col("depth"))))
        sizes = prefixes.groupBy("shard", "depth").agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"))
        fits = (F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1) | (F.col("depth") == MOST_BITS)
        shortest = (prefixes.select("fine", "shard", "depth").join(sizes.filter(fits), ["shard", "depth"])
                    .groupBy("fine").agg(F.min(F.struct("depth", "shard", "shard_bytes", "shard_docs")).alias("s")))
        part = written(shortest.select("s.*").distinct().select("shard", "depth", "shard_bytes", "shard_docs"), "directory")
        found = part if found is None else found.union(part)
        over = written(fine.join(shortest.select("fine"), "fine", "left_anti").select("fine"), "oversized")
        if over.isEmpty():
            return found
        rest = rest.join(over, F.substring("bits", 1, high) == F.col("fine"), "left_semi")
        low, high = high + 1, min(MOST_BITS, high + STEP)


def assign(keys: DataFrame, shards: DataFrame) -> DataFrame:
    """key, bytes, n, bits and its shard's columns, by one lookup a shard depth in use.

    A key's shard is the one prefix of its bits that the directory holds. The depths in use
    (129 at most) are the only thing gathered.
    """
    depths = sorted(r.depth for r in shards.select("depth").distinct().collect())
    tried = F.explode(F.array(*[F.lit(d) for d in depths])) if depths else F.explode(F.array().cast("array<int>"))
    rows = keys.withColumn("depth", tried).withColumn("shard", F.substring("bits", F.lit(1), F.col("depth")))
    return rows.join(shards, ["shard", "depth"])


def write_shards(docs: DataFrame, folder: str, limit: int = LIMIT) -> DataFrame:
    """Writes ``docs`` as Parquet under one folder a shard; returns the directory.

    The documents are first written once with a number each, by which they find their shard.
    """
    docs = written(docs.drop("shard", "_n").withColumn("_n", F.monotonically_increasing_id()), "numbered")
    keys = keyed(docs, number=F.col("_n"))
    shards = written(directory(keys, limit), "directory")
    to = assign(keys, shards).select(F.col("n").alias("_n"), F.concat(F.lit("s"), "shard").alias("shard"))
    docs.join(to, "_n").drop("_n").repartition("shard").write.partitionBy("shard").parquet(folder)
    return shards


def op4_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = keyed(documents(spark, sf_dir))
    shards = written(directory(keys), "directory")
    return assign(keys, shards).select(F.col("key").alias("doc_id"), "bytes", "shard", "depth", "shard_bytes", "shard_docs")


QUERIES = {"op4_extendible_sharding": op4_extendible_sharding}

"""Nearest neighbours by cosine over shifted space-filling curves.

Each of ``CURVES`` orderings projects the unit vectors on ``AXES`` random orthonormal
directions, shifts them by a random offset and sorts them by their place on a Hilbert curve
through a grid of ``BITS`` bits an axis. Every vector is indexed in every ordering, by range
partitions; places are counted from the written sorted table. A query looks at the vectors
within ``w`` places to either side in each ordering; the windows are cut into blocks of
``BLOCK`` places, each block is reranked against its queries by the exact cosine, and the
best of all blocks and orderings are merged.

``w`` is measured, not guessed: for ``SAMPLE`` of the queries the exact neighbours are found
by a full scan, and ``w`` is the distance that covers the share ``COVER`` of them. On clustered
vectors it is small; on vectors without structure, as random directions, neighbours are near
on no curve, and the windows grow to a good part of the table.

Equal vectors are indexed once, with the smallest ids that an answer can need, so a vector
that holds a third of all rows costs no more than another.

Defined cases: vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part, nor do rows without vec_id; of rows that repeat a vec_id
the least vector counts; with fewer candidates than asked all are returned; an empty table
gives an empty result; ties go to the smaller vec_id; further columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import written

CURVES = 16
AXES = 8
BITS = 7
BLOCK = 2_048
QUERIES_AT_ONCE = 1_024
SAMPLE = 64
COVER = 0.95
LEAST_WINDOW = 64
SEED = 20



def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of grid cells (points x axes) on the Hilbert curve."""
    x = cells.astype(np.int64).copy()
    axes = x.shape[1]
    for level in range(bits - 1, 0, -1):  # undo the rotations, from the coarsest level down
        bit, lower = 1 << level, (1 << level) - 1
        for a in range(axes):
            set_ = (x[:, a] & bit) != 0
            swap = (x[:, 0] ^ x[:, a]) & lower
            x[:, 0] ^= np.where(set_, lower, swap)
            x[:, a] ^= np.where(set_, 0, swap)
    for a in range(1, axes):  # Gray code
        x[:, a] ^= x[:, a - 1]
    flips = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        flips ^= np.where((x[:, -1] & (1 << level)) != 0, (1 << level) - 1, 0)
    x ^= flips[:, None]
    key = np.zeros(len(x), np.int64)
    for level in range(bits - 1, -1, -1):
        for a in range(axes):
            key = key << 1 | (x[:, a] >> level) & 1
    return key


def curve_keys(vectors: np.ndarray, curve: int) -> np.ndarray:
    """Keys of the vectors on one curve."""
    dims = vectors.shape[1]
    axes = min(AXES, dims)
    rng = np.random.default_rng((SEED, curve))
    directions, _ = np.linalg.qr(rng.normal(size=(dims, axes)))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    place = (unit @ directions * np.sqrt(dims) + rng.uniform(-0.5, 0.5, axes)) / 8 + 0.5
    return hilbert_keys(np.clip(np.floor(place * (1 << BITS)), 0, (1 << BITS) - 1), BITS)


def matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, each pair in the same order of operations."""
    dot = lambda x, y: np.einsum("ij,ij->i", x, y)
    return dot(a, b) / (np.sqrt(dot(a, a)) * np.sqrt(dot(b, b)))


def best_of(query_ids, queries, ids, vectors, most: int):
    """The ``most`` best (query id, id, score) of each query; ties to the smaller id."""
    rough = (queries / np.linalg.norm(queries, axis=1, keepdims=True)) @ (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).T
    out = []
    for i, row in enumerate(rough):
        row = np.where(ids == query_ids[i], -9.0, row)
        floor = np.partition(row, -most)[-most] - 1e-9 if len(row) > most else -9.0
        at = np.flatnonzero((row >= floor) & (row > -8))
        exact = cosine(np.broadcast_to(queries[i], (len(at), queries.shape[1])), vectors[at])
        keep = np.lexsort((ids[at], -exact))[:most]
        out.append((np.full(len(keep), query_ids[i]), ids[at][keep], exact[keep]))
    return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and vector of the rows that take part."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)).filter(finite & F.exists(v, lambda x: x != 0))
    rows = written(rows, "vectors")
    size = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    if size is not None:
        rows = rows.filter(F.size("vector") == size.n)
    if not rows.groupBy("vec_id").count().filter("count > 1").isEmpty():
        rows = written(rows.groupBy("vec_id").agg(F.min("vector").alias("vector")), "vectors")
    return rows


def distinct_vectors(rows: DataFrame, most: int) -> DataFrame:
    """gid (the least id), vector and the ``most`` least ids of each different vector."""
    turn = W.partitionBy("h", "vector").orderBy("vec_id")
    few = rows.withColumn("h", F.xxhash64("vector")).withColumn("n", F.row_number().over(turn)).filter(F.col("n") <= most)
    return written(few.groupBy("h", "vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
                   .select(F.get("ids", F.lit(0)).alias("gid"), "vector", "ids"), "groups")


def placed(groups: DataFrame) -> DataFrame:
    """curve, place, gid and vector of every group in every ordering; places count from 0."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                vectors = matrix(batch.column("vector"))
                for c in range(CURVES):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(batch.num_rows, c, np.int32)), pa.array(curve_keys(vectors, c)),
                         batch.column("gid"), batch.column("vector")], ["curve", "key", "gid", "vector"])

    keys = groups.select("gid", "vector").mapInArrow(run, "curve int, key bigint, gid bigint, vector array<double>")
    ordered = keys.repartitionByRange("curve", "key", "gid").sortWithinPartitions("curve", "key", "gid")
    # task number and row number in the task, fixed by writing them
    ordered = written(ordered.withColumn("n", F.monotonically_increasing_id()), "curves")
    part, row = F.shiftright("n", 33), F.col("n").bitwiseAND(F.lit((1 << 33) - 1))
    counts = ordered.groupBy(part.alias("part"), "curve").agg(F.count(F.lit(1)).alias("c"), F.min(row).alias("first"))
    # one row a partition and curve
    before = F.sum("c").over(W.partitionBy("curve").orderBy("part")) - F.col("c") - F.col("first")
    starts = counts.select("part", "curve", before.alias("start"))
    return (ordered.withColumns({"part": part, "row": row}).join(starts, ["part", "curve"])
            .select("curve", (F.col("row") + F.col("start")).alias("place"), "gid", "vector"))


def measured_window(groups: DataFrame, queries: DataFrame, places: DataFrame, k: int) -> int:
    """Places to either side that cover the share ``COVER`` of the sample's exact neighbours."""
    sample = queries.join(groups, "gid").orderBy(F.xxhash64("gid"), "gid").limit(SAMPLE).select("gid", "vector").collect()
    gids = np.array([r.gid for r in sample], np.int64)
    vectors = np.array([r.vector for r in sample])

    def scan(batches):
        for batch in batches:
            if batch.num_rows:
                q, c, s = best_of(gids, vectors, batch.column("gid").to_numpy(), matrix(batch.column("vector")), k)
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(c), pa.array(s)], ["q", "c", "score"])

    found = groups.select("gid", "vector").mapInArrow(scan, "q bigint, c bigint, score double")
    turn = W.partitionBy("q").orderBy(F.desc("score"), "c")
    near = written(found.withColumn("n", F.row_number().over(turn)).filter(F.col("n") <= k).select("q", "c"), "exact")
    at = places.select("curve", "place", "gid")
    apart = (near.join(at.toDF("curve", "pq", "q"), "q").join(at.toDF("curve", "pc", "c"), ["curve", "c"])
             .groupBy("q", "c").agg(F.min(F.abs(F.col("pq") - F.col("pc"))).alias("d")).collect())  # SAMPLE * k rows
    distances = sorted(r.d for r in apart)
    if not distances:
        return LEAST_WINDOW
    return max(LEAST_WINDOW, int(distances[min(len(distances) - 1, int(COVER * len(distances)))]) + 1)


def rerank(places: DataFrame, queries: DataFrame, window: int, most: int) -> DataFrame:
    """(q, c, score): the best of every block of every window, for each query group."""
    asked = places.join(queries, "gid").withColumn("block", F.explode(F.sequence(
        F.floor(F.greatest(F.col("place") - window, F.lit(0)) / BLOCK), F.floor((F.col("place") + window) / BLOCK))))
    asked = asked.toDF(*asked.columns)  # new attributes: both sides come from one table
    blocks = places.withColumn("block", F.floor(F.col("place") / BLOCK))

    def run(key, left, right):
        empty = pa.table({"q": pa.array([], pa.int64()), "c": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not left.num_rows or not right.num_rows:
            return empty
        left, right = left.combine_chunks(), right.combine_chunks()
        ids, vectors = left.column("gid").to_numpy(), matrix(left.column("vector").combine_chunks())
        gids, asks = right.column("gid").to_numpy(), matrix(right.column("vector").combine_chunks())
        parts = [best_of(gids[a:a + QUERIES_AT_ONCE], asks[a:a + QUERIES_AT_ONCE], ids, vectors, most)
                 for a in range(0, len(gids), QUERIES_AT_ONCE)]
        return pa.table({n: np.concatenate([p[i] for p in parts]) for i, n in enumerate(("q", "c", "score"))})

    return (blocks.groupBy("curve", "block").cogroup(asked.groupBy("curve", "block"))
            .applyInArrow(run, "q bigint, c bigint, score double"))


def nearest(embeddings: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of each row whose vec_id is divisible by ``every``."""
    rows = usable(embeddings)
    groups = distinct_vectors(rows, k + 1)
    asks = rows.filter(F.col("vec_id") % every == 0)
    members = written(asks.withColumn("h", F.xxhash64("vector")).join(
        groups.withColumn("h", F.xxhash64("vector")).select("h", "vector", "gid"), ["h", "vector"])
        .select(F.col("vec_id").alias("query_id"), "gid"), "queries")
    queries = members.select("gid").distinct()
    if queries.isEmpty():
        return members.select("query_id", F.lit(0).alias("rank"), F.col("gid").alias("vec_id"), F.lit(0.0).alias("score"))
    places = written(placed(groups), "places")
    window = measured_window(groups, queries, places, k)
    found = rerank(places, queries, window, k).distinct()
    turn = W.partitionBy("q").orderBy(F.desc("score"), "c")
    found = found.withColumn("n", F.row_number().over(turn)).filter(F.col("n") <= k).select("q", "c", "score")
    # a query's own copies, at the cosine of the vector with itself
    own = groups.join(queries, "gid").filter(F.size("ids") > 1)
    dot = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    own = own.select(F.col("gid").alias("q"), F.col("gid").alias("c"), (dot / (F.sqrt(dot) * F.sqrt(dot))).alias("score"))
    answers = (found.unionByName(own).join(groups.select(F.col("gid").alias("c"), "ids"), "c")
               .join(members.withColumnRenamed("gid", "q"), "q")
               .select("query_id", F.explode("ids").alias("vec_id"), "score").filter("query_id <> vec_id"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (answers.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {"op8_nearest_neighbours": op8_nearest_neighbours}

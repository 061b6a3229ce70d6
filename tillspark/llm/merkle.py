"""Merkle manifest of a dataset: a tree of digests per source, and a tree over the sources.

Method: sibling-shift self-joins. A level is a table (g, idx, h): the idx-th node of group g.
Every node computes the indices of its run (``idx XOR 1`` for a binary tree, otherwise its slot
shifted by each offset within the run) and is equijoined on (g, index) with the level itself, so
keys are spread evenly however large one group is. The joined rows give each node the digests
that stand left and right of it; rows in slot zero then emit the parents, which are the next
level. Going down again, a node's proof is its own neighbours followed by its parent's proof: one
join a level on (g, parent), in which a parent meets at most ``fanout`` children.

Leaves are digests of all columns of a row, each ``-`` if null, else its UTF-8 byte count, a
colon and its value. Leaves are numbered within their group by range partitions: the rows are
written with their place in (partition, group), and what earlier partitions hold of a group is
added from a table of at most one row a partition.

Defined cases: a null group value is a group of its own and comes first; null doc_ids come
first, rows of one doc_id go by their leaf; equal rows are leaves of their own (which of them
takes which place does not show in the result, as they are equal); null, empty and long texts
are values like others (a digest reads the text once); the lone leaf of a group is its subroot,
and the lone subroot the root; a table without rows gives none; columns that are not named as
leaf columns do not matter, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from .common import documents, written

FANOUT = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*values: Column) -> Column:
    """sha256, in lowercase hex, of strings put together."""
    return F.sha2(F.concat(*values), 256)


def leaf_digest(columns: dict[str, Column]) -> Column:
    def part(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return digest(*map(part, columns.values()))


def group_key(group: Column) -> Column:
    """A key that is never null and orders null first, then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def with_index(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``idx``, the place (from 0) in its group ``g`` by the columns ``order``."""
    ties = rows.withColumn("_tie", F.monotonically_increasing_id())  # so that equal rows can be split by range
    ranged = (ties.repartitionByRange(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "g", *order, "_tie")
              .sortWithinPartitions("g", *order, "_tie").drop("_tie").withColumn("pid", F.spark_partition_id()))

    def place(batches):
        last, seen = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            g = batch.column("g")
            new = np.ones(batch.num_rows, bool)
            new[1:] = pc.not_equal(g[1:], g[:-1]).to_numpy(zero_copy_only=False)
            if g[0].as_py() == last:
                new[0] = False
            at = np.arange(batch.num_rows)
            start = np.maximum.accumulate(np.where(new, at, -seen))  # where the run began, before this batch too
            places = at - start
            last, seen = g[-1].as_py(), int(places[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64())], names=[*batch.schema.names, "place"])

    placed = written(ranged.mapInArrow(place, T.StructType([*ranged.schema.fields, T.StructField("place", T.LongType())])), "placed")
    counts = placed.groupBy("g", "pid").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("g").orderBy("pid").rowsBetween(W.unboundedPreceding, -1))
    # Only the first group of a partition can have begun in an earlier one: one row a partition at most.
    carry = counts.select("g", "pid", before.alias("before")).filter("before > 0")
    return (placed.join(F.broadcast(carry), ["g", "pid"], "left")
            .withColumn("idx", F.col("place") + F.coalesce("before", F.lit(0))).drop("pid", "place", "before"))


def run_indices(idx: Column, fanout: int) -> Column:
    """The indices of a node and its siblings, whether they exist or not."""
    if fanout == 2:
        return F.array(idx, idx.bitwiseXOR(F.lit(1)))
    slot = idx % fanout
    return F.transform(F.sequence(F.lit(0), F.lit(fanout - 1)), lambda shift: idx - slot + (slot + shift) % fanout)


def sibling_level(nodes: DataFrame, fanout: int) -> DataFrame:
    """(g, idx, h, carried) with ``parent`` and the digests ``left`` and ``right`` of each node.

    ``parent`` is -1 for the last node that remains of a group.
    """
    wants = nodes.select("g", "idx", F.explode(run_indices(F.col("idx"), fanout)).alias("at"))
    found = wants.join(nodes.select("g", F.col("idx").alias("at"), "h", "carried"), ["g", "at"])
    up = F.floor(F.col("idx") / fanout)
    pairs = found.select("g", up.alias("up"), "idx", "at", "h", F.when(F.col("at") == F.col("idx"), F.col("carried")).alias("carried"))
    runs = (pairs.repartition("g", "up").groupBy("g", "up", "idx")
            .agg(F.sort_array(F.collect_list(F.struct("at", "h"))).alias("run"), F.max("carried").alias("carried")))

    def joined(keep) -> Column:
        hexes = F.transform(F.filter("run", keep), lambda x: F.lower(F.hex(x["h"])))
        return F.unhex(F.array_join(hexes, ""))
    idx = F.col("idx")
    sides = runs.select("g", "up", "idx", "carried", F.filter("run", lambda x: x["at"] == idx)[0]["h"].alias("h"),
                        joined(lambda x: x["at"] < idx).alias("left"), joined(lambda x: x["at"] > idx).alias("right"))
    alone = (idx == 0) & (F.octet_length("right") == 0)
    return sides.withColumn("parent", F.when(alone, F.lit(-1)).otherwise(F.col("up")).cast("bigint")).drop("up")


def hexed(binary: Column) -> Column:
    return F.lower(F.hex(binary))


@dataclass
class MerkleTree:
    """The levels of a forest, leaves first, and the (g, h) of its roots."""

    fanout: int
    levels: list[DataFrame] = field(default_factory=list)

    def roots(self) -> DataFrame:
        out = [lv.filter("parent = -1").select("g", "h") for lv in self.levels]
        return out[0] if len(out) == 1 else _union(out)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def build(leaves: DataFrame, fanout: int = FANOUT) -> MerkleTree:
    """The trees over ``leaves`` (g, idx, h binary, carried), one a group."""
    tree, nodes = MerkleTree(fanout), leaves
    while True:
        level = written(sibling_level(nodes, fanout), "merkle-level")
        tree.levels.append(level)
        heads = level.filter((F.col("idx") % fanout == 0) & (F.col("parent") >= 0))  # rows in slot zero
        if heads.isEmpty():
            return tree
        nodes = heads.select("g", F.col("parent").alias("idx"), F.unhex(digest(hexed(F.col("h")), hexed(F.col("right")))).alias("h"),
                             F.lit(None).cast(level.schema["carried"].dataType).alias("carried"))


def proofs(tree: MerkleTree, top: DataFrame) -> DataFrame:
    """(g, h, carried, path, and the further columns of ``top``) of every leaf.

    ``top`` has g and ``path`` of each group's root; ``path`` lists the (left, right) digests on
    the way up, from the leaf on.
    """
    above = None
    more = [c for c in top.columns if c not in ("g", "path")]
    for level in reversed(tree.levels):
        up = top.withColumn("parent", F.lit(-1).cast("bigint"))
        if above is not None:
            up = up.unionByName(above.select("g", F.col("idx").alias("parent"), "path", *more))
        own = F.when(F.col("parent") >= 0, F.array(F.struct("left", "right"))).otherwise(F.array().cast("array<struct<left:binary,right:binary>>"))
        above = level.join(up, ["g", "parent"]).withColumn("path", F.concat(own, "path")).drop("left", "right", "parent")
    return above.drop("idx")


def fold(leaf: Column, path: Column) -> Column:
    """The root (hex) that a leaf (hex) and its path lead to."""
    return F.aggregate(path, leaf, lambda h, s: digest(hexed(s["left"]), h, hexed(s["right"])))


def proof_digest(path: Column) -> Column:
    return digest(F.array_join(F.transform(path, lambda s: F.concat(hexed(s["left"]), hexed(s["right"]))), ""))


def manifest(docs: DataFrame, columns=COLUMNS, group: str = "source", order: str = "doc_id", carried: Column | None = None,
             fanout: int = FANOUT) -> DataFrame:
    """One row a document: ``carried``, leaf, subroot, root and ``path`` (leaf to root)."""
    carried = F.struct(F.col(order)) if carried is None else carried
    rows = written(docs.select(group_key(F.col(group)).alias("g"), F.col(order).alias("_order"), carried.alias("carried"),
                               F.unhex(leaf_digest({c: F.col(c) for c in columns})).alias("h")), "leaves")
    tree = build(with_index(rows, ["_order", "h"]).drop("_order"), fanout)
    subroots = tree.roots().select(F.lit("").alias("g"), F.struct(F.col("g").alias("name")).alias("carried"), "h")
    upper = build(with_index(written(subroots, "subroots"), ["carried"]), fanout)
    no_path = F.array().cast("array<struct<left:binary,right:binary>>")
    top = upper.roots().select("g", F.col("h").alias("root"), no_path.alias("path"))
    over = proofs(upper, top).select(F.col("carried.name").alias("g"), "path", F.col("h").alias("subroot"), "root")
    return proofs(tree, written(over, "over")).select("carried", hexed(F.col("h")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"),
                                                      hexed(F.col("root")).alias("root"), "path")


def verified(manifest_rows: DataFrame, leaf: Column) -> DataFrame:
    """Adds ``folded_root``, which the given leaf leads to, and whether that is the root."""
    return (manifest_rows.withColumn("folded_root", fold(leaf, F.col("path")))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    columns = {c: F.col(c) for c in COLUMNS}
    spoilt = leaf_digest(columns | {"text": F.translate("text", UPPER, LOWER)})
    hit = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    carried = F.struct("doc_id", F.when(hit, F.unhex(spoilt)).alias("tampered"))
    rows = manifest(docs, carried=carried)
    checked = verified(rows, F.coalesce(hexed(F.col("carried.tampered")), F.col("leaf")))
    return checked.select("carried.doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", "verified")


def _sql() -> str:
    def h(parts):
        return f"sha256({parts})"

    def leaf(text):
        cols = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
        return h(" || ".join(f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in cols))
    lower = f"translate(text, '{UPPER}', '{LOWER}')"
    return f"""
WITH RECURSIVE crc_table(b, step, c) AS (
  SELECT b, 0, b::UBIGINT FROM range(256) t(b)
  UNION ALL
  SELECT b, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM crc_table WHERE step < 8
), crc_of(doc_id, rest, c) AS (
  SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR), 4294967295::UBIGINT FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT doc_id, rest[2:], xor(crc_of.c >> 8, t.c) FROM crc_of
  JOIN crc_table t ON t.step = 8 AND t.b = xor(crc_of.c, ascii(rest)::UBIGINT) & 255 WHERE rest <> ''
), crc AS (SELECT doc_id, xor(c, 4294967295::UBIGINT) AS crc FROM crc_of WHERE rest = ''
), leaves AS (
  SELECT row_number() OVER () AS row_id, doc_id, source, {leaf('text')} AS leaf,
         CASE WHEN crc % 5 = 0 THEN {leaf(lower)} END AS tampered
  FROM documents LEFT JOIN crc USING (doc_id)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, row_id) - 1 AS idx FROM leaves
), nodes(lvl, source, idx, h) AS (
  SELECT 0, source, idx, leaf FROM placed
  UNION ALL
  SELECT any_value(lvl) + 1, source, idx // 16, sha256(string_agg(h, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER (PARTITION BY source) AS n FROM nodes) WHERE n > 1 GROUP BY source, idx // 16
), subroots AS (
  SELECT source, h AS subroot, lvl AS depth, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx
  FROM (SELECT *, count(*) OVER (PARTITION BY source, lvl) AS n FROM nodes) WHERE n = 1
), tops(lvl, idx, h) AS (
  SELECT 0, idx, subroot FROM subroots
  UNION ALL
  SELECT any_value(lvl) + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER () AS n FROM tops) WHERE n > 1 GROUP BY idx // 16
), top AS (SELECT h AS root, lvl AS height FROM tops ORDER BY lvl DESC LIMIT 1
), sides AS (
  SELECT a.lvl, a.source, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM nodes a JOIN nodes b ON a.lvl = b.lvl AND a.source IS NOT DISTINCT FROM b.source AND a.idx // 16 = b.idx // 16 GROUP BY ALL
), top_sides AS (
  SELECT a.lvl, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM tops a JOIN tops b ON a.lvl = b.lvl AND a.idx // 16 = b.idx // 16 GROUP BY ALL
), walk(row_id, step, source, pos, cur, proof, depth, height, top_at) AS (
  SELECT row_id, 0, p.source, p.idx, coalesce(tampered, leaf), '', depth, height, s.idx
  FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source CROSS JOIN top
  UNION ALL
  SELECT row_id, step + 1, w.source, CASE WHEN step < depth THEN pos // 16 ELSE pos END,
         sha256(coalesce(s.l, t.l) || cur || coalesce(s.r, t.r)), proof || coalesce(s.l, t.l) || coalesce(s.r, t.r), depth, height,
         CASE WHEN step < depth THEN top_at ELSE top_at // 16 END
  FROM walk w
  LEFT JOIN sides s ON step < depth AND s.lvl = step AND s.source IS NOT DISTINCT FROM w.source AND s.idx = pos
  LEFT JOIN top_sides t ON step >= depth AND t.lvl = step - depth AND t.idx = top_at
  WHERE step < depth + height
)
SELECT p.doc_id, p.leaf, s.subroot, root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root AS verified
FROM walk w JOIN placed p USING (row_id) JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source CROSS JOIN top
WHERE step = w.depth + w.height"""


QUERIES = {"op11_merkle_manifest": op11_merkle_manifest}
SQL = {"op11_merkle_manifest": _sql()}

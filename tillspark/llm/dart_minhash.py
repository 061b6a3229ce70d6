"""MinHash near-duplicate classes over weighted word shingles, by DartMinHash.

Every shingle of five consecutive words, weighted by its count, owns one unit region for
each count. Darts fall into a region as a Poisson process in time whose arrivals are drawn
from hashes of the region alone; each dart has a coordinate and a name from the same
hashes. A document looks at the darts of its regions up to a time that shrinks with its
weight, so that about ``COORDINATES * (ln COORDINATES + 4)`` darts are thrown whatever its
length, and keeps the earliest dart of each coordinate (a document with an empty coordinate
looks twice as far). Two documents agree on a coordinate with a probability of their
weighted Jaccard similarity.

Signatures are joined on ``BANDS`` bands of ``ROWS`` coordinates; a pair of similarity 0.8
shares no band with a probability of 3e-6. Texts of the same words are one node. In a
bucket of up to ``SMALL`` nodes every pair is a candidate. Nodes that larger buckets tie
together are a family, found over one row a node and bucket. All nodes of a family are compared
with one centre, the node with the most bucket neighbours; those that are left outside the
family's main class get a centre among themselves, ``CENTRES`` times in all. What is outside then
is compared with all nodes of the family in other classes, in blocks of ``BLOCK`` by ``BLOCK``
nodes that report a spanning forest: fewer links than nodes. So each two nodes of a bucket are in
the end compared or known to be in one class, and no pairs of a large bucket are listed.
Every candidate pair is decided by the exact weighted Jaccard similarity of its shingles;
classes are the connected components of the pairs of ``SIMILARITY`` or more.

Defined cases: null or blank texts have no words and form one class, as copies; a text of
fewer than five words is one shingle; rows without doc_id get a class of their text; a row is
named by doc_id and the hash of its text, so rows of one doc_id and different texts are
documents of their own; a class is named by its first row (by doc_id, then text hash):
``class_id`` is that row's doc_id, the least of the class (a negative hash of the text where
all are null), and ``class_text_hash`` its text hash; repeated rows are each returned;
further columns of the input do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, documents, hand_back, texts_of, written
from .graph import components, families
from .wordhash import Words, mix
from .wordpool import ragged

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4
COORDINATES = BANDS * ROWS
SMALL = 8
CENTRES = 2
BLOCK = 256
BROADCAST_IDS = 2_000_000


def weighted_elements(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """One hash for each shingle and count of it in its text, and the offsets of the texts."""
    shingles, offsets = words.shingles(SHINGLE)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((shingles, owner))
    shingles = shingles[order]
    index = np.arange(len(shingles))
    new = np.ones(len(shingles), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    nth = index - np.maximum.accumulate(np.where(new, index, 0))
    return mix(shingles + nth.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), offsets


def dart_signatures(elements: np.ndarray, offsets: np.ndarray, k: int = COORDINATES) -> np.ndarray:
    """Names of the earliest dart of each coordinate, one row a text (zeros without elements)."""
    n = len(offsets) - 1
    out = np.zeros((n, k), np.uint64)
    weights = np.diff(offsets)
    todo, darts = np.flatnonzero(weights > 0), k * (np.log(k) + 4)
    while len(todo):
        sizes = weights[todo]
        ends = np.cumsum(sizes)
        el = elements[np.arange(ends[-1]) + np.repeat(offsets[todo] - (ends - sizes), sizes)]
        row = np.repeat(np.arange(len(todo)), sizes)
        until = (darts / sizes)[row]
        time, nth = np.zeros(len(el)), 0
        cells, times, names = [], [], []
        while len(el):
            nth += 1
            draw = mix(el + np.uint64(nth * 0xA0761D6478BD642F & (1 << 64) - 1))
            time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 1) * 2.0 ** -53)
            live = time <= until
            el, row, until, time, draw = el[live], row[live], until[live], time[live], draw[live]
            name = mix(draw ^ np.uint64(0xE7037ED1A0B428DB))
            cells.append(row * k + (name % np.uint64(k)).astype(np.int64))
            times.append(time)
            names.append(name)
        cell, when, name = (np.concatenate(x) for x in (cells, times, names))
        order = np.lexsort((when, cell))
        cell, name = cell[order], name[order]
        first = np.flatnonzero(np.diff(cell, prepend=-1))
        found = np.zeros((len(todo), k), np.uint64)
        seen = np.zeros((len(todo), k), bool)
        found.reshape(-1)[cell[first]] = name[first]
        seen.reshape(-1)[cell[first]] = True
        full = seen.all(axis=1)
        out[todo[full]] = found[full]
        todo, darts = todo[~full], darts * 2
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key a band, different between bands."""
    parts = signatures.reshape(len(signatures), BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * np.uint64(0x9FB21C651E98DF25)
    for r in range(ROWS):
        key = mix(key + parts[:, :, r])
    return key.view(np.int64)


def _nodes(words: Words) -> list[bytes]:
    """A 128-bit name of each text's word sequence."""
    return [hashlib.blake2b(words.hashes[a:b].tobytes(), digest_size=16).digest()
            for a, b in zip(words.offsets[:-1], words.offsets[1:])]


def row_key(docs: DataFrame) -> DataFrame:
    """doc_id, text and the row's key: ``rid`` (the doc_id, or a negative hash of the text where
    it is null) and ``text_hash``."""
    return docs.select("doc_id", "text", row_id().alias("rid"), text_hash().alias("text_hash"))


def row_id() -> Column:
    return F.coalesce("doc_id", -1 - F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(F.lit((1 << 62) - 1)))


def text_hash() -> Column:
    return F.xxhash64("text")


def signed(docs: DataFrame) -> DataFrame:
    """rid, text_hash, doc_id, node and band keys (none for a text without words) of each row."""
    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                words = Words(texts_of(part, "text"))
                elements, offsets = weighted_elements(words)
                keys = band_keys(dart_signatures(elements, offsets))
                counts = np.where(words.counts() > 0, BANDS, 0)
                bands = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()),
                                                 pa.array(keys[counts > 0].reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("rid", "text_hash", "doc_id")), pa.array(_nodes(words), pa.binary()), bands],
                    ["rid", "text_hash", "doc_id", "node", "bands"])
            hand_back()

    return row_key(docs).mapInArrow(run, "rid bigint, text_hash bigint, doc_id bigint, node binary, bands array<bigint>")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """node and its sorted element hashes (32 bits each), packed in one binary."""
    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                words = Words(texts_of(part, "text"))
                elements, offsets = weighted_elements(words)
                short = (elements >> np.uint64(32)).astype(np.uint32)
                sets = [np.sort(short[a:b]).tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(_nodes(words), pa.binary()), pa.array(sets, pa.binary())],
                                                 ["node", "elements"])
            hand_back()

    return docs.mapInArrow(run, "node binary, elements binary")


def similarities(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, similarity): exact weighted Jaccard similarity of the nodes' shingles."""
    def run(batches):
        for batch in batches:
            out = []
            for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist()):
                x, y = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                out.append(shared / max(1, len(both) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out, pa.float64())],
                                             ["a", "b", "similarity"])

    joined = (pairs.join(sets.toDF("a", "left"), "a").join(sets.toDF("b", "right"), "b"))
    return joined.select("a", "b", "left", "right").mapInArrow(run, "a binary, b binary, similarity double")


def shared_counts(asked: list[np.ndarray], held: list[np.ndarray]):
    """For each asked set, the sizes of its intersections with the held sets."""
    owner = np.repeat(np.arange(len(held)), [len(x) for x in held])
    flat = np.concatenate(held) if held else np.zeros(0, np.uint32)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    for x in asked:
        left = np.searchsorted(flat, x, "left")
        hits = ragged(left, np.searchsorted(flat, x, "right") - left)
        yield np.bincount(owner[hits], minlength=len(held))


def spanning(names: list, labels: list, edges) -> list[tuple]:
    """Of the edges (i, j) between rows of ``names``, those that tie classes not yet tied."""
    parent = {x: x for x in labels}

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x
    out = []
    for i, j in edges:
        x, y = root(labels[i]), root(labels[j])
        if x != y:
            parent[x] = y
            out.append((names[i], names[j]))
    return out


def main_classes(family: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes of each family with their class, and each family's size, main class and its size."""
    rows = written(family.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "families")
    sizes = rows.groupBy("family", "label").count().groupBy("family").agg(
        F.max(F.struct("count", "label"))["label"].alias("main"), F.sum("count").alias("size"), F.max("count").alias("in_main"))
    return rows, sizes.filter(F.col("size") > F.col("in_main"))


def star_pairs(nodes: DataFrame, popular: DataFrame) -> DataFrame:
    """(a, b): each node of (family, node) with the most popular one of its family."""
    centres = nodes.join(popular, "node").groupBy("family").agg(F.max(F.struct("popularity", "node"))["node"].alias("centre"))
    return (nodes.join(centres, "family").filter("node <> centre")
            .select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")))


def links_of_the_rest(rows: DataFrame, sizes: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): similar nodes of one family, one of them outside the family's main class."""
    parts = lambda n: F.ceil(n / BLOCK).cast("int")
    sizes = sizes.select(
        "family", "main", parts(F.col("size")).alias("blocks"), parts(F.col("size") - F.col("in_main")).alias("chunks"))
    rows = rows.join(sizes, "family").join(sets, "node")
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    columns = ["family", "block", "chunk", "node", "label", "elements"]
    held = rows.withColumn("block", dealt("blocks")).withColumn("chunk", numbers("chunks")).select(*columns)
    asked = (rows.filter("label <> main").withColumn("chunk", dealt("chunks")).withColumn("block", numbers("blocks"))
             .select(*columns))
    asked = asked.toDF(*columns)  # new attributes: both sides come from one table

    def run(key, left, right):
        a, b = [], []
        if left.num_rows and right.num_rows:
            names, classes, sets = (left.column(c).to_pylist() for c in ("node", "label", "elements"))
            held = [np.frombuffer(x, np.uint32) for x in sets]
            sizes = np.array([len(x) for x in held])
            asks = [np.frombuffer(x, np.uint32) for x in right.column("elements").to_pylist()]

            def edges():
                for i, (x, shared) in enumerate(zip(asks, shared_counts(asks, held))):
                    for j in np.flatnonzero(shared / np.maximum(sizes + len(x) - shared, 1) >= SIMILARITY).tolist():
                        yield len(names) + i, j
            found = spanning(names + right.column("node").to_pylist(), classes + right.column("label").to_pylist(), edges())
            a, b = [x for x, _ in found], [y for _, y in found]
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return (held.groupBy("family", "block", "chunk").cogroup(asked.groupBy("family", "block", "chunk"))
            .applyInArrow(run, "a binary, b binary"))


def near_duplicate_classes(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, class_id, class_text_hash and class_size of every row of ``docs``
    (doc_id, text)."""
    out = classes_of_rows(docs)
    name = ["class_id", "class_text_hash"]
    return (out.join(out.groupBy(*name).agg(F.count(F.lit(1)).alias("class_size")), name)
            .select("doc_id", "text_hash", *name, "class_size"))


def one_of_each_class(docs: DataFrame) -> DataFrame:
    """``docs`` with the first row (by doc_id, then text hash) of each class; of repeated rows one
    stays."""
    out = classes_of_rows(docs)
    gone = out.filter("rid <> class_id or text_hash <> class_text_hash").select("rid", "text_hash").distinct()
    kept = (docs.withColumns({"_rid": row_id(), "_text_hash": text_hash()})
            .join(gone.toDF("_rid", "_text_hash"), ["_rid", "_text_hash"], "left_anti").drop("_rid", "_text_hash"))
    if not out.groupBy("rid", "text_hash").count().filter("count > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", "text"])
    return kept


def classes_of_rows(docs: DataFrame) -> DataFrame:
    """rid, text_hash, doc_id, class_id and class_text_hash of every row, written."""
    rows = written(signed(docs), "signatures")
    first = written(rows.groupBy("node").agg(F.min(F.struct("rid", "text_hash")).alias("first")), "nodes")
    keyed = rows.select("node", F.explode("bands").alias("key")).distinct()
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = written(keyed.join(sizes, "key"), "members")
    ordered = lambda df: df.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()

    few = members.filter(F.col("size") <= SMALL).select("key", "node")
    pairs = few.toDF("key", "x").join(few.toDF("key", "y"), "key").filter("x < y")
    many = members.filter(F.col("size") > SMALL)
    popular = members.groupBy("node").agg(F.sum("size").alias("popularity"))
    some = not many.isEmpty()
    family = written(families(many.select("key", "node")).withColumnRenamed("label", "family"), "family") if some else None
    pairs = ordered(pairs.select("x", "y"))
    pairs = written(pairs.union(star_pairs(family, popular)).distinct() if some else pairs, "pairs")

    # shingles are made again for the nodes that can need them: those that share a bucket
    # (one hash of the row's key: a chance equal row is made again for nothing)
    key = F.xxhash64("rid", "text_hash").alias("wanted")
    wanted = members.select("node").distinct().join(first, "node").select("first.*").select(key)
    wanted = written(wanted, "wanted")
    if wanted.count() <= BROADCAST_IDS:  # 16 MB of ids at most; beyond it both sides are shuffled
        wanted = F.broadcast(wanted)
    sets = shingle_sets(row_key(docs).select("text", key).join(wanted, "wanted", "left_semi").select("text"))
    sets = written(sets.groupBy("node").agg(F.any_value("elements").alias("elements")), "shingles")
    decided = written(similarities(pairs, sets), "similarities")
    links = decided.filter(F.col("similarity") >= SIMILARITY).select("a", "b")
    labels = components(links)
    for turn in range(CENTRES if some else 0):
        classes, sizes = main_classes(family, labels)
        if sizes.isEmpty():
            break
        if turn < CENTRES - 1:
            rest = classes.join(sizes.select("family", "main"), "family").filter("label <> main").select("family", "node")
            near = similarities(star_pairs(rest, popular), sets).filter(F.col("similarity") >= SIMILARITY).select("a", "b")
        else:
            near = links_of_the_rest(classes, sizes, sets)
        links = written(links.union(near), "links")
        labels = components(links)

    groups = first.join(labels, "node", "left").select("node", "first", F.coalesce("label", "node").alias("label"))
    ids = groups.groupBy("label").agg(F.min("first").alias("class"))
    nodes = groups.join(ids, "label").select(
        "node", F.col("class.rid").alias("class_id"), F.col("class.text_hash").alias("class_text_hash"))
    named = rows.select("rid", "text_hash", "doc_id", "node").join(nodes, "node").drop("node")
    return written(named, "classes")


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(documents(spark, sf_dir))


QUERIES = {"op2_minhash_near_dedup": op2_minhash_near_dedup}

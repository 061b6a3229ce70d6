"""Repeated passages by hashed word windows at sparse places (no suffix order is built).

A passage counts as repeated where ``LENGTH`` consecutive words stand in the same order at
two places, in one text or in two. Suffixes are kept only at minimiser positions: of each
run of ``WINDOW`` k-grams of ``GRAM`` words that fits into a possible passage start, the
place of the smallest hash (the rightmost on ties). Equal passages pick equal places, at
most ``WINDOW - 1`` words after their start, so two equal passages hold two kept suffixes
that agree on at least ``PREFIX = LENGTH - WINDOW + 1`` words to the right.

1. The kept suffixes are sorted by the hash of their first ``PREFIX`` words (range partitions,
   so that equal suffixes of a very common passage may lie in several), and those equal to a
   neighbour stay. The first and last suffix of a partition stay in any case.
2. Each that stays is extended to the left by the words up to the passage starts that chose
   it and to the right to the full ``LENGTH``; the extensions are sorted by their hash, doc_id,
   text hash and place. One whose predecessor is equal repeats that one; the first of a partition is
   compared with the last of those before.
3. Neighbouring repeated starts with one source merge into maximal spans.

So every place but the first (by doc_id, text hash, then place) of each repeated passage is found, as
if all windows of ``LENGTH`` words had been compared, and no pairs of a group are listed.

Defined cases: words are runs of non-blank characters; null, empty or shorter texts have no
spans; rows of equal doc_id and text count as one document, whose equal passages at the same
place are one, and rows of one doc_id and different texts as documents of their own, told
apart by the hash of the text; a null doc_id stands for a negative hash of its text and comes first; further
columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import chunks, documents, hand_back, texts_of, written
from .dart_minhash import row_id, row_key, text_hash
from .wordhash import Words, range_hashes
from .wordpool import ragged

LENGTH = 50
GRAM = 8
WINDOW = 32
PREFIX = LENGTH - WINDOW + 1
PLACE_BITS = 26
KEY = ["rid", "text_hash"]


def anchors(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Possible passage starts (flat word places) and the kept suffix each one chooses."""
    counts = words.counts()
    spans = np.maximum(counts - (LENGTH - 1), 0)
    starts = ragged(words.offsets[:-1], spans)
    if not len(starts):
        return starts, starts
    n = len(words.hashes)
    places = np.arange(n - GRAM + 1)
    low = (1 << PLACE_BITS) - 1
    grams = range_hashes(words.hashes, places, places + GRAM)
    packed = (grams & np.uint64(~low & (1 << 64) - 1)) | (np.uint64(low) - (places.astype(np.uint64) & np.uint64(low)))
    width = 1
    while width < WINDOW:
        step = min(width, WINDOW - width)
        packed = np.minimum(packed[:-step], packed[step:])
        width += step
    chosen = np.uint64(low) - (packed[starts] & np.uint64(low))
    return starts, starts + ((chosen.astype(np.int64) - starts) & low)


def _batch(names: list[str], *arrays) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names)


def kept_suffixes(rows: DataFrame) -> DataFrame:
    """(digest, rid, text_hash, place): the suffixes at minimiser places of every text."""
    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                words = Words(texts_of(part, "text"))
                at = np.unique(anchors(words)[1])
                text = np.searchsorted(words.offsets, at, "right") - 1
                yield _batch(["digest", *KEY, "place"], range_hashes(words.hashes, at, at + PREFIX).view(np.int64),
                             *(part.column(c).to_numpy()[text] for c in KEY), (at - words.offsets[text]).astype(np.int32))
            hand_back()

    return rows.select(*KEY, "text").mapInArrow(run, "digest bigint, rid bigint, text_hash bigint, place int")


def equal_to_a_neighbour(suffixes: DataFrame) -> DataFrame:
    """(rid, text_hash, places): the suffixes whose neighbour in sorted order has the same digest."""
    def run(batches):
        held = None  # the last row is decided when the next one is known
        for batch in batches:
            table = [batch.column(c).to_numpy() for c in ("digest", *KEY, "place")]
            if not len(table[0]):
                continue
            first = held is None
            if not first:
                table = [np.concatenate([h, t]) for h, t in zip(held[0], table)]
            same = table[0][1:] == table[0][:-1]
            keep = np.concatenate([[first or held[1]], same])
            keep[:-1] |= same
            held = [t[-1:] for t in table], bool(keep[-1])
            pick = np.flatnonzero(keep[:-1])
            yield _batch([*KEY, "place"], *(t[pick] for t in table[1:]))
        if held is not None:
            yield _batch([*KEY, "place"], *held[0][1:])

    order = ["digest", *KEY, "place"]
    ordered = suffixes.repartitionByRange(*order).sortWithinPartitions(*order)
    return (ordered.mapInArrow(run, "rid bigint, text_hash bigint, place int")
            .groupBy(*KEY).agg(F.collect_set("place").alias("places")))


def extensions(rows: DataFrame) -> DataFrame:
    """(digest, rid, text_hash, start): each start of ``LENGTH`` words that chose one of the row's places."""
    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                words = Words(texts_of(part, "text"))
                starts, chosen = anchors(words)
                lists = part.column("places")
                counts = np.array([len(p) for p in lists.to_pylist()], np.int64)
                wanted = lists.flatten().to_numpy() + np.repeat(words.offsets[:-1], counts)
                starts = starts[np.isin(chosen, wanted)]
                text = np.searchsorted(words.offsets, starts, "right") - 1
                yield _batch(["digest", *KEY, "start"], range_hashes(words.hashes, starts, starts + LENGTH).view(np.int64),
                             *(part.column(c).to_numpy()[text] for c in KEY), (starts - words.offsets[text]).astype(np.int32))
            hand_back()

    return rows.mapInArrow(run, "digest bigint, rid bigint, text_hash bigint, start int")


def with_predecessor(passages: DataFrame) -> DataFrame:
    """(rid, text_hash, start, and the same of the source) of each passage equal to its predecessor."""
    place = [*KEY, "start"]
    source = [f"source_{c}" for c in place]
    names = ["kind", "digest", *place, *source]
    schema = ("kind int, digest bigint, rid bigint, text_hash bigint, start int, "
              "source_rid bigint, source_text_hash bigint, source_start int")

    def run(batches):
        held = None
        for batch in batches:
            table = [batch.column(c).to_numpy() for c in ("digest", *place)]
            if not len(table[0]):
                continue
            if held is None:  # the first of the partition
                d, *at = (t[:1] for t in table)
                yield _batch(names, np.ones(1, np.int32), d, *at, *at)
            else:
                table = [np.concatenate([h, t]) for h, t in zip(held, table)]
            d, *at = table
            other = np.logical_or.reduce([x[1:] != x[:-1] for x in at])  # not the same place of a repeated row
            hit = np.flatnonzero((d[1:] == d[:-1]) & other) + 1
            yield _batch(names, np.zeros(len(hit), np.int32), d[hit], *(x[hit] for x in at), *(x[hit - 1] for x in at))
            held = [t[-1:] for t in table]
        if held is not None:
            d, *at = held
            yield _batch(names, np.full(1, 2, np.int32), d, *at, *at)

    ordered = passages.repartitionByRange("digest", *place).sortWithinPartitions("digest", *place)
    found = written(ordered.mapInArrow(run, schema), "passages")
    # one first and one last row a partition
    firsts = found.filter("kind = 1").select("digest", *place)
    lasts = found.filter("kind = 2").select("digest", F.struct(*place).alias("last"))
    across = (firsts.join(lasts, "digest").filter(F.col("last") < F.struct(*place))
              .groupBy(*place).agg(F.max("last").alias("last"))
              .select(*place, *(F.col(f"last.{c}").alias(f"source_{c}") for c in place)))
    return found.filter("kind = 0").select(*place, *source).union(across)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, start_word, end_word, source_doc_id, source_text_hash, source_start_word)
    of repeated passages.

    The words [start_word, end_word) stand at the source as well. Both ids are the rows'
    doc_ids, or the negative text hash that stands for a null one; with the hashes of the texts
    they name the two rows.
    """
    rows = row_key(docs).select(*KEY, "text")
    places = written(equal_to_a_neighbour(kept_suffixes(rows)), "suffixes")
    passages = written(extensions(rows.join(places, KEY)), "extensions")
    found = with_predecessor(passages)
    order = W.partitionBy(*KEY).orderBy("start")
    shift = F.col("source_start") - F.col("start")
    fresh = ((F.lag("start").over(order) + 1 != F.col("start")) | (F.lag("source_rid").over(order) != F.col("source_rid"))
             | (F.lag("source_text_hash").over(order) != F.col("source_text_hash")) | (F.lag(shift).over(order) != shift))
    spans = (found.withColumn("_new", F.coalesce(fresh, F.lit(True)).cast("int"))
             .withColumn("_span", F.sum("_new").over(order.rowsBetween(W.unboundedPreceding, 0))))
    return spans.groupBy(*KEY, "_span").agg(
        F.min("start").alias("start_word"), (F.max("start") + LENGTH).alias("end_word"),
        F.first("source_rid").alias("source_doc_id"), F.first("source_text_hash").alias("source_text_hash"),
        F.min("source_start").alias("source_start_word")) \
        .drop("_span").withColumnRenamed("rid", "doc_id")


def without_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with the words of the spans cut out of ``text``; blanks around them join to one."""
    cut = spans.groupBy(F.col("doc_id").alias("_rid"), F.col("text_hash").alias("_text_hash")).agg(
        F.sort_array(F.collect_list(F.struct("start_word", "end_word"))).alias("_spans"))
    rows = (docs.withColumns({"_rid": row_id(), "_text_hash": text_hash()}).join(cut, ["_rid", "_text_hash"], "left")
            .select(*docs.columns, "_spans"))
    columns = docs.columns

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                texts, spans = part.column("text").to_pylist(), part.column("_spans").to_pylist()
                some = [i for i, s in enumerate(spans) if s]
                if some:
                    words = Words([texts[i] for i in some])
                    for k, i in enumerate(some):
                        a, b = words.offsets[k], words.offsets[k + 1]
                        texts[i] = cut_words(texts[i], words.starts[a:b], words.ends[a:b],
                                             [(s["start_word"], s["end_word"]) for s in spans[i]])
                out = [pa.array(texts, pa.string()) if c == "text" else part.column(c) for c in columns]
                yield pa.RecordBatch.from_arrays(out, columns)
            hand_back()

    return rows.mapInArrow(run, docs.schema)


def cut_words(text: str, starts, ends, spans) -> str:
    """``text`` without the words of the spans (sorted; they may overlap) and one side's blanks."""
    out, at, done = [], 0, 0
    for a, b in spans:
        a, b = max(a, done), min(b, len(starts))
        if b <= a:
            continue
        out.append(text[at:starts[a]])
        at = int(starts[b]) if b < len(starts) else len(text)
        done = b
    out.append(text[at:])
    return "".join(out)


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(documents(spark, sf_dir))


QUERIES = {"op5_suffix_array_dedup": op5_suffix_array_dedup}

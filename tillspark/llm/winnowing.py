"""Document fingerprints by winnowing, in DataFrame functions only.

The text is cut into words: runs of non-blank characters, at most ``WORD`` code points
each (a longer run is several words), and one word for each character of the scripts that
put no blanks between words. Every ``K`` consecutive words are hashed; in every window of
``WINDOW`` consecutive hashes the smallest is kept (the rightmost on ties) together with
its word position. Two texts that share a passage of at least ``K + WINDOW - 1`` words
therefore share a fingerprint of it, and nothing but window minima is kept.

Hash (32 bits) and word position (31 bits, reversed so that the smaller value lies further
right) share one long, so that the minimum over a window is plain ``least``, in
log2(``WINDOW``) pairwise steps over the whole array.

Defined cases: a null text counts as empty; a text without words has no fingerprints; a
text of fewer than ``K`` words has one, the hash of all its words; a text with fewer than
``WINDOW`` k-grams is one window. The likeness of two fingerprints without hashes is 1, of
one without and one with hashes 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import documents, let, range_of

K = 5
WINDOW = 8
WORD = 24
UNSPACED = r"\u0E00-\u0EFF\u1780-\u17FF\u3040-\u30FF\u3400-\u9FFF\x{20000}-\x{3FFFF}"  # Thai, Lao, Khmer, kana, Han
ROWS_PER_BUCKET = 2_000
MAX_BUCKETS = 200_000
LAST = (1 << 31) - 1
PRINTS = "array<struct<hash:int,pos:int>>"


def words(text: Column) -> Column:
    runs = F.regexp_extract_all(text, F.lit(rf"\S{{1,{WORD}}}"), F.lit(0))
    mixed = F.regexp_extract_all(text, F.lit(rf"[^\s{UNSPACED}]{{1,{WORD}}}|[{UNSPACED}]"), F.lit(0))
    return F.when(text.rlike(f"[{UNSPACED}]"), mixed).otherwise(runs)


def winnow(text: Column, k: int = K, window: int = WINDOW) -> Column:
    """Array of (hash, pos) of the selected k-grams, by position; null counts as empty."""

    def grams(h: Column) -> Column:
        last = F.greatest(F.size(h) - k, F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.shiftleft(
            F.xxhash64(*[F.get(h, i + j) for j in range(k)]), 32).bitwiseOR((LAST - i).cast("bigint")))

    def least_over(arr: Column, width: int) -> Column:
        if width == window:
            return arr
        step = min(width, window - width)
        return let(F.zip_with(arr, F.slice(arr, step + 1, F.size(arr)), lambda x, y: F.least(x, y)),
                   lambda a: least_over(a, width + step))

    def minima(g: Column) -> Column:
        windows = F.greatest(F.lit(1), F.size(g) - (window - 1))
        return F.transform(
            F.array_distinct(F.slice(least_over(g, 1), F.lit(1), windows)),
            lambda v: F.struct(F.shiftright(v, 32).cast("int").alias("hash"),
                               (LAST - v.bitwiseAND(F.lit(LAST).cast("bigint"))).cast("int").alias("pos")))

    hashes = F.transform(words(F.coalesce(text, F.lit(""))), lambda w: F.xxhash64(w))
    return let(hashes, lambda h: F.when(F.size(h) == 0, F.array().cast(PRINTS)).otherwise(let(grams(h), minima)))


def digest(prints: Column) -> Column:
    """128-bit digest of a fingerprint list, as 32 hex digits."""
    half = [F.lpad(F.lower(F.hex(F.xxhash64(F.lit(seed), prints))), 16, "0") for seed in (1, 2)]
    return F.concat(*half)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two arrays of distinct hashes (both empty: 1)."""
    shared = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - shared
    return F.when(total == 0, F.lit(1.0)).otherwise(shared / total)


def hash_set(prints: Column) -> Column:
    return F.array_distinct(F.transform(prints, lambda p: p["hash"]))


def with_next(docs: DataFrame, key: str, column: str, derive, *derived: str) -> DataFrame:
    """Adds ``next_<column>``: its value in the next row by descending ``key`` (null keys
    last), in the first row for the last one. ``derive`` adds columns made of that column;
    those named in ``derived`` are taken from the next row too, not computed again.

    Rows are dealt to buckets of equal key width, sized to hold about ``ROWS_PER_BUCKET``
    rows; only the head of each bucket crosses to its neighbour. Rows with equal keys are
    ordered by the hash of the column.
    """
    lo, hi, n = docs.agg(F.min(key), F.max(key), F.count(F.lit(1))).first()
    buckets = max(1, min(MAX_BUCKETS, math.ceil((n or 0) / ROWS_PER_BUCKET)))
    width = max(1, -(-((hi or 0) - (lo or 0) + 1) // buckets))
    docs = docs.select("*", range_of(key, lo, width).alias("_bucket"))
    tie = F.xxhash64(column)
    packed = F.struct(column, *derived)

    inside = W.partitionBy("_bucket").orderBy(F.col(key).desc_nulls_last(), tie)
    rows = derive(docs).withColumn("_next", F.lead(packed).over(inside))
    # one row a bucket: the head of the next lower bucket, or of the highest after the last;
    # the keys of the heads, at most MAX_BUCKETS pairs of longs, go to every task
    top = docs.groupBy("_bucket").agg(F.max(key).alias("_top")).withColumnRenamed("_bucket", "_of")
    heads = (docs.join(F.broadcast(top), (F.col("_bucket") == F.col("_of")) & F.col(key).eqNullSafe(F.col("_top")))
             .groupBy("_bucket").agg(F.min_by(column, tie).alias(column)))
    down = W.orderBy(F.col("_bucket").desc())
    ends = derive(heads).select("_bucket", F.coalesce(
        F.lead(packed).over(down),
        F.first(packed).over(down.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).alias("_after"))
    out = rows.join(ends, "_bucket", "left").withColumn("_next", F.coalesce("_next", "_after"))
    return out.select("*", *[F.col("_next")[c].alias(f"next_{c}") for c in [column, *derived]]).drop("_bucket", "_next", "_after")


def edited_text(text: Column, following: Column) -> Column:
    """The last half (floor) of the code points replaced by the first as many of ``following``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and its selected k-grams, as an array of (hash, pos)."""
    return docs.select("doc_id", winnow(F.col("text")).alias("prints"))


def with_prints(df: DataFrame, text: str, hashes: str, fingerprint: str) -> DataFrame:
    """Adds the set of selected hashes of a text column and the digest of hashes and positions."""
    return (df.withColumn("_prints", winnow(F.col(text)))
            .withColumns({hashes: hash_set(F.col("_prints")), fingerprint: digest(F.col("_prints"))}).drop("_prints"))


def fingerprint_pairs(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likenesses.

    Output: doc_id, text, edited_text, hashes, fingerprint, edited_hashes,
    edited_fingerprint, near_edited, near_next. Repeated doc_ids keep one row each; further
    columns of the input do not matter.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(docs, "doc_id", "text", lambda df: with_prints(df, "text", "hashes", "fingerprint"), "hashes")
    rows = rows.withColumn("edited_text", edited_text(F.col("text"), F.col("next_text"))).drop("next_text")
    rows = with_prints(rows, "edited_text", "edited_hashes", "edited_fingerprint")
    return rows.withColumns({"near_edited": likeness(F.col("hashes"), F.col("edited_hashes")),
                             "near_next": likeness(F.col("hashes"), F.col("next_hashes"))}).drop("next_hashes")


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_pairs(documents(spark, sf_dir)).select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited_text", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next")


QUERIES = {"op1_document_fingerprints": op1_document_fingerprints}

"""Phrase collocations from a weighted de Bruijn graph of words.

Method. Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, and pieces
into words. Nodes of the graph are phrases of ``LONGEST - 1`` words, edges phrases of ``LONGEST``
words between overlapping nodes, weighted by their occurrences. Each word position gives one
record: the longest phrase that starts there, which is an edge, or, near the end of a piece, a
shorter phrase (the piece-end correction). Unary paths (nodes with one edge in and one out) are
compacted into one row each. Counts of shorter phrases follow without another pass over the
texts: a node's flow is what its edges carry away plus its piece-end correction, and likewise
for two words and for one.

Pruning, exact. A phrase below ``min_count`` can neither be a candidate nor part of one, so a
record may end before the first word that would make it rare. Two sketches (``2 ** BITS``
saturating counters over hashes of phrases, summed over all tasks; a bit each in the end, so 4 MB
whatever the input) say which are surely rare: first words and pairs, then phrases of three and
four words among what is left. Collisions only keep more records; no count depends on them, as
records are told apart by their words. On inputs that saturate the sketches nothing is pruned.

Scores. A candidate is a phrase of two words or more with ``a >= min_count`` occurrences; cut
after its first k words into parts that occur l and r times it has the score
``scale * a // (l + r)``, in decimals of 38 digits. The lowest cut counts, the first of equals.
A candidate is dropped if a longer one that holds it has at least ``share`` of its occurrences.

Defined cases: null text is empty, null language ``und``; empty tables give no row; repeated rows
count each; ties go by occurrences, then by the phrase's UTF-8 bytes; a very long text is read
whole, its words in blocks; columns other than text and lang do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import chunks, documents, written
from .wordhash import BASE, mix, range_hashes
from .wordpool import ragged

LONGEST, MIN_COUNT, SCALE, SHARE, TOP = 4, 30, 2_000_000, 80, 2_000
BITS, BLOCK = 25, 1 << 16
CHUNK_BYTES, HASH_BYTES, BLOCK_WORDS = 4_000_000, 1_000_000, 500_000
ANCHORS, ROUNDS, SALTS = 32, 6, 64
WORD, BLANK, STOP = 0, 1, 2
SALT = np.uint64(0xA5A5A5A5A5A5A5A5)
KINDS = np.zeros(256, np.uint8)
KINDS[[0x20, 0x09]] = BLANK
KINDS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = STOP
RECORD = "lang string, size int, phrase string, n bigint"


class Pieces:
    """The words of an Arrow batch (text, lang), flat, as byte ranges of ``data``.

    ``joined[i]`` says that words i and i + 1 stand in one piece; ``keys`` are hashes of word and
    language, ``langs`` the place of a word's language in ``names``.
    """

    def __init__(self, batch):
        texts = pc.fill_null(batch.column("text"), "").cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        self.data = (np.frombuffer(raw, np.uint8) if raw else np.empty(0, np.uint8))[offsets[0]:offsets[-1]].copy()
        self.data[(self.data >= 65) & (self.data <= 90)] += 32
        offsets = offsets - offsets[0]
        n = len(self.data)
        first = np.zeros(n + 1, bool)
        first[offsets] = True
        kind = KINDS[self.data]
        word = kind == WORD
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = word[:-1] & ~first[1:n], word[1:] & ~first[1:n]
        self.starts, self.ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
        piece = np.cumsum((kind == STOP) | first[:n], dtype=np.int32)[self.starts]
        self.joined = np.append(piece[1:] == piece[:-1], False) if len(piece) else np.zeros(0, bool)
        langs = pc.fill_null(batch.column("lang"), "und").dictionary_encode()
        self.names = langs.dictionary
        text = np.searchsorted(offsets, self.starts, "right") - 1
        self.langs = langs.indices.to_numpy(zero_copy_only=False)[text].astype(np.int64)
        salts = [int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little") for name in self.names.to_pylist()]
        self.keys = mix(self.hashes() ^ np.array(salts, np.uint64)[self.langs]) if len(self.starts) else np.empty(0, np.uint64)

    def hashes(self) -> np.ndarray:
        out, a = [], 0
        while a < len(self.starts):
            b = max(a + 1, int(np.searchsorted(self.ends, self.starts[a] + HASH_BYTES, "right")))
            at = self.starts[a]
            values = self.data[at:self.ends[b - 1]].astype(np.uint64) + np.uint64(1)
            out.append(range_hashes(values, self.starts[a:b] - at, self.ends[a:b] - at))
            a = b
        return np.concatenate(out) if out else np.empty(0, np.uint64)

    def blocks(self):
        """Stretches of words: (begin, end, end with the words that its last phrases need)."""
        for a in range(0, len(self.starts), BLOCK_WORDS):
            b = min(a + BLOCK_WORDS, len(self.starts))
            yield a, b, min(b + LONGEST - 1, len(self.starts))


def ahead(x: np.ndarray, n: int) -> np.ndarray:
    """Each position's value n positions on (zero beyond the end)."""
    return np.append(x[n:], np.zeros(min(n, len(x)), x.dtype))


class Grams:
    """For each position of a stretch of words: hashes of the phrases of 1 to 4 words that start
    there, and which of them may be frequent (``keep``; as far as ``flags`` say)."""

    def __init__(self, p: Pieces, a: int, end: int, flags: list[np.ndarray], bits: int):
        one, joined = p.keys[a:end], p.joined[a:end].copy()
        joined[-1:] = False
        two = mix(one * BASE + ahead(one, 1))
        self.keys = [one, two, mix(two * BASE + ahead(one, 2)), mix((two ^ SALT) * BASE + ahead(two, 2))]
        self.bits, self.keep = bits, [np.ones(len(one), bool)]
        if flags:
            self.keep = [self.maybe(flags[0], one)]
        for n in range(1, LONGEST):
            fits = self.keep[-1] & ahead(self.keep[-1], 1) & (joined if n == 1 else True)
            if n // 2 < len(flags):  # one sketch for phrases of 1 and 2 words, one for 3 and 4
                fits[fits] = self.maybe(flags[n // 2], self.keys[n][fits])
            self.keep.append(fits)

    def maybe(self, flags: np.ndarray, keys: np.ndarray) -> np.ndarray:
        at = bucket(keys, self.bits)
        return (flags[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def bucket(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64)


def frequent_bits(texts: DataFrame, sizes: list[int], min_count: int, bits: int = BITS, known=()) -> bytes:
    """A bit a bucket: 1 where the phrases of ``sizes`` words in it may reach ``min_count``.

    ``known`` are broadcast bits of shorter phrases; what they rule out is not counted.
    """
    most = min(min_count, 255)
    block = min(BLOCK, 1 << bits)

    def count(batches):
        counts, flags = np.zeros(1 << bits, np.uint8), [np.frombuffer(k.value, np.uint8) for k in known]
        for batch in batches:
            for part in chunks(batch, "text", CHUNK_BYTES):
                p = Pieces(part)
                for a, b, end in p.blocks():
                    g = Grams(p, a, end, flags, bits)
                    found = [g.keys[n - 1][:b - a][g.keep[n - 1][:b - a]] for n in sizes]
                    places, n = np.unique(bucket(np.concatenate(found), bits), return_counts=True)
                    counts[places] = np.minimum(counts[places] + n, most)
        blocks, payloads = [], []
        for b in range((1 << bits) // block):
            some = counts[b * block:(b + 1) * block]
            filled = np.flatnonzero(some)
            if len(filled):
                blocks.append(b)
                payloads.append(filled.astype("<u2").tobytes() + some[filled].tobytes() if 3 * len(filled) < block else some.tobytes())
            if len(blocks) == 64:
                yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array(payloads, pa.binary())], names=["block", "counts"])
                blocks, payloads = [], []
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array(payloads, pa.binary())], names=["block", "counts"])

    def add(batches):
        last, sums = None, None
        for batch in batches:
            for b, payload in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
                if b != last:
                    if last is not None:
                        yield row(last, sums)
                    last, sums = b, np.zeros(block, np.int64)
                if len(payload) == block:
                    sums += np.frombuffer(payload, np.uint8)
                else:
                    n = len(payload) // 3
                    sums[np.frombuffer(payload, "<u2", n)] += np.frombuffer(payload, np.uint8, n, 2 * n)
        if last is not None:
            yield row(last, sums)

    def row(b, sums):
        return pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([np.packbits(sums >= most).tobytes()], pa.binary())], names=["block", "bits"])

    sketch = texts.mapInArrow(count, "block int, counts binary").repartition("block").sortWithinPartitions("block")
    out = bytearray((1 << bits) // 8)
    for b, flags in sketch.mapInArrow(add, "block int, bits binary").collect():  # 2 ** bits bits in all
        out[b * block // 8:b * block // 8 + len(flags)] = flags
    return bytes(out)


def records_of(p: Pieces, a: int, b: int, end: int, flags: list[np.ndarray], bits: int):
    """Distinct records of the positions [a, b): Arrow batches of RECORD."""
    starts, ends, langs = (x[a:end] for x in (p.starts, p.ends, p.langs))
    g = Grams(p, a, end, flags, bits)
    keep, pair, keys = g.keep[0], g.keep[1], g.keys[0]
    size = sum(k.astype(np.int8) for k in g.keep)
    # Words by number, equal only where their bytes and languages are.
    ids = np.full(len(starts), -1, np.int64)
    ids[keep] = word_numbers(p.data, starts[keep], ends[keep], keys[keep], langs[keep])
    one = int(ids.max(initial=0)) + 1
    two = np.full(len(starts), -1, np.int64)
    _, two[pair] = np.unique(ids[pair] * one + ahead(ids, 1)[pair], return_inverse=True)
    mine = np.arange(len(starts)) < b - a
    for n in range(1, LONGEST + 1):
        at = np.flatnonzero((size == n) & mine)
        if not len(at):
            continue
        # Numbers of n words: from the pair that begins and the pair (or word) that ends them.
        number = ids[at] if n == 1 else two[at] if n == 2 else two[at] * one + ids[at + 2] if n == 3 else two[at] * (int(two.max()) + 1) + two[at + 2]
        _, rows, counts = np.unique(number, return_index=True, return_counts=True)
        yield record_batch(p, starts, ends, langs, at[rows], n, counts)
    some, counts = np.unique(langs[mine], return_counts=True)
    yield pa.RecordBatch.from_arrays([p.names.take(pa.array(some)), pa.array(np.zeros(len(some), np.int32)), pa.array([""] * len(some), pa.string()),
                                      pa.array(counts, pa.int64())], names=["lang", "size", "phrase", "n"])


def word_numbers(data, starts, ends, keys, langs) -> np.ndarray:
    """A number a word: the hash's, once all words of a hash have been found to be the same."""
    _, rows, numbers = np.unique(keys, return_index=True, return_inverse=True)
    like, lengths = rows[numbers], ends - starts
    same = (lengths == lengths[like]).all() and (langs == langs[like]).all()
    if same and (data[ragged(starts, lengths)] == data[ragged(starts[like], lengths)]).all():
        return numbers
    seen: dict = {}
    return np.fromiter((seen.setdefault((g, data[s:e].tobytes()), len(seen)) for s, e, g in zip(starts, ends, langs.tolist())), np.int64, len(starts))


def record_batch(p: Pieces, starts, ends, langs, at, n, counts):
    words = (at[:, None] + np.arange(n)).ravel()
    lengths = ends[words] - starts[words]
    room = lengths + (np.arange(len(words)) % n < n - 1)  # a blank after each word but the last
    out_ends = np.cumsum(room)
    out = np.full(int(out_ends[-1]), 0x20, np.uint8)
    out[ragged(out_ends - room, lengths)] = p.data[ragged(starts[words], lengths)]
    offsets = np.concatenate([[0], out_ends[n - 1::n]]).astype(np.int32)
    phrases = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(out))
    return pa.RecordBatch.from_arrays([p.names.take(pa.array(langs[at])), pa.array(np.full(len(at), n, np.int32)), phrases, pa.array(counts, pa.int64())],
                                      names=["lang", "size", "phrase", "n"])


def records(docs: DataFrame, min_count: int = MIN_COUNT, bits: int = BITS) -> DataFrame:
    """(lang, size, phrase, n): edges (size 4) and piece-end corrections; size 0 counts all words."""
    texts, context = docs.select("text", "lang"), docs.sparkSession.sparkContext
    flags = [context.broadcast(frequent_bits(texts, [1, 2], min_count, bits))]
    flags.append(context.broadcast(frequent_bits(texts, [3, 4], min_count, bits, flags[:1])))

    def run(batches):
        bitmaps = [np.frombuffer(f.value, np.uint8) for f in flags]
        for batch in batches:
            for part in chunks(batch, "text", CHUNK_BYTES):
                p = Pieces(part)
                for a, b, end in p.blocks():
                    yield from records_of(p, a, b, end, bitmaps, bits)

    return written(texts.mapInArrow(run, RECORD).groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n")), "records")


def head(phrase, n: int) -> Column:
    return F.substring_index(phrase, " ", n)


def tail(phrase, n: int) -> Column:
    return F.substring_index(phrase, " ", -n)


def compact_paths(edges: DataFrame) -> DataFrame:
    """Unary paths of (lang, phrase, n): ``words``, and ``counts`` of the edges along them.

    Nodes chosen by hash (one in ``ANCHORS``) end a path too, which keeps rows short; what
    pointer doubling has not reached after ``ROUNDS`` (cycles without such a node) stays as paths
    of one edge. Every edge is in exactly one path.
    """
    graph = written(edges.select("lang", "phrase", "n", head("phrase", LONGEST - 1).alias("from"), tail("phrase", LONGEST - 1).alias("to")), "graph")
    into = graph.groupBy("lang", F.col("to").alias("node")).agg(F.count(F.lit(1)).alias("ins"), F.min("phrase").alias("edge"))
    out = graph.groupBy("lang", F.col("from").alias("node")).agg(F.count(F.lit(1)).alias("outs"))
    unary = (into.join(out, ["lang", "node"]).filter((F.col("ins") == 1) & (F.col("outs") == 1))
             .filter(F.pmod(F.xxhash64("lang", "node"), F.lit(ANCHORS)) != 0))
    # Every edge points to the one before it while its first node is unary.
    state = written(graph.join(unary.select("lang", F.col("node").alias("from"), F.col("edge").alias("at")), ["lang", "from"], "left")
                    .select("lang", "phrase", "n", F.coalesce("at", "phrase").alias("at"), F.col("at").isNotNull().cast("int").alias("place"),
                            F.col("at").isNull().alias("done")), "pointers")
    for _ in range(ROUNDS):
        if state.filter("NOT done").isEmpty():
            break
        target = state.select("lang", F.col("phrase").alias("at"), F.col("at").alias("at2"), F.col("place").alias("place2"), F.col("done").alias("done2"))
        moved = (state.filter("NOT done").join(target, ["lang", "at"])
                 .select("lang", "phrase", "n", F.col("at2").alias("at"), (F.col("place") + F.col("place2")).alias("place"), F.col("done2").alias("done")))
        state = written(state.filter("done").unionByName(moved), "pointers")
    start = F.when(F.col("done"), F.col("at")).otherwise(F.col("phrase"))
    path = F.sort_array(F.collect_list(F.struct(F.when(F.col("done"), F.col("place")).otherwise(0).alias("place"), "phrase", "n")))
    rows = state.groupBy("lang", start.alias("start")).agg(path.alias("path"))
    rest = F.transform(F.slice("path", 2, 1 << 30), lambda e: tail(e["phrase"], 1))
    return rows.select("lang", F.concat(F.split("start", " "), rest).alias("words"), F.col("path.n").alias("counts"))


def phrase_counts(found: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, size, phrase, n) of all phrases of one word or more that reach ``min_count``."""
    edges = found.filter(F.col("size") == LONGEST)
    paths = written(compact_paths(edges.filter(F.col("n") >= min_count)), "paths")
    along = paths.select("lang", "words", F.posexplode("counts").alias("i", "n"))
    frequent = along.select("lang", F.array_join(F.slice("words", F.col("i") + 1, LONGEST), " ").alias("phrase"), "n")
    rare = edges.filter(F.col("n") < min_count).select("lang", "phrase", "n")  # a node's flow, but no candidates
    out, flow = [frequent.withColumn("size", F.lit(LONGEST))], frequent.unionByName(rare)
    for size in range(LONGEST - 1, 0, -1):
        ends = found.filter(F.col("size") == size).select("lang", "phrase", "n")
        flow = written(flow.select("lang", head("phrase", size).alias("phrase"), "n").unionByName(ends)
                       .groupBy("lang", "phrase").agg(F.sum("n").alias("n")), "flow")
        out.append(flow.filter(F.col("n") >= min_count).withColumn("size", F.lit(size)))
    counts = out[0]
    for more in out[1:]:
        counts = counts.unionByName(more)
    return written(counts.select("lang", "size", "phrase", "n"), "counts")


def scored(counts: DataFrame, scale: int = SCALE) -> DataFrame:
    """Candidates with a, and l, r, score of their lowest cut."""
    first = F.expr("substring_index(phrase, ' ', k)")
    cuts = (counts.filter("size >= 2").select("lang", "size", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
            .withColumn("first", first).withColumn("rest", F.substring(F.col("phrase"), F.length("first") + 2, F.length("phrase"))))
    parts = counts.select("lang", "phrase", "n")
    both = (cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
            .join(parts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"]))
    score = F.expr(f"(CAST(a AS DECIMAL(20,0)) * CAST({scale} AS DECIMAL(18,0))) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    return (both.withColumn("score", score.cast("bigint")).groupBy("lang", "size", "phrase", "a")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "size", "phrase", "a", "cut.l", "cut.r", "cut.score"))


def not_dominated(candidates: DataFrame, share: int = SHARE) -> DataFrame:
    """Without those whose words lie in a longer candidate of ``share`` percent of their count."""
    words = F.split("phrase", " ")
    size = F.col("size")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(
        F.sequence(F.lit(1), size - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))))
    longer = candidates.filter("size >= 3").select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    return (candidates.join(longer, ["lang", "phrase"], "left")
            .filter(F.col("most").isNull() | (100 * F.col("most") < share * F.col("a"))).drop("most"))


def top_phrases(candidates: DataFrame, totals: DataFrame, top: int = TOP) -> DataFrame:
    """Each language's first ``top``: first those of each salt, then of all."""
    order = [F.desc("score"), F.desc("a"), "phrase"]
    salted = candidates.withColumn("salt", F.pmod(F.hash("phrase"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("bigint")).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def mine(docs: DataFrame, min_count: int = MIN_COUNT, scale: int = SCALE, share: int = SHARE, top: int = TOP, bits: int = BITS) -> DataFrame:
    """The collocations of ``docs`` (text, lang), best first in each language."""
    found = records(docs, min_count, bits)
    candidates = written(scored(phrase_counts(found, min_count), scale), "candidates")
    return top_phrases(not_dominated(candidates, share), found.filter("size = 0").select("lang", "n"), top)


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(documents(spark, sf_dir))


def _sql(min_count: int = MIN_COUNT) -> str:
    after = [f"lead(w, {k}) OVER (PARTITION BY piece ORDER BY i) AS w{k}" for k in range(1, LONGEST)]
    grams = "\n  UNION ALL ".join(
        f"SELECT lang, {k} AS size, {' || chr(32) || '.join(['w', *(f'w{j}' for j in range(1, k))])} AS phrase FROM spots" for k in range(1, LONGEST + 1))
    cuts = "\n  UNION ALL ".join(
        f"SELECT lang, phrase, {k} AS k, array_to_string(string_split(phrase, ' ')[:{k}], ' ') AS f, array_to_string(string_split(phrase, ' ')[{k + 1}:], ' ') AS g "
        f"FROM counts WHERE size > {k}" for k in range(1, LONGEST))
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), worded AS (SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM pieces
), words AS (SELECT lang, piece, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM worded
), spots AS (SELECT lang, w, {', '.join(after)} FROM words
), grams AS ({grams}
), counts AS MATERIALIZED (SELECT lang, size, phrase, lang || chr(10) || phrase AS key, count(*)::BIGINT AS n FROM grams WHERE phrase IS NOT NULL GROUP BY ALL HAVING count(*) >= {min_count}
), totals AS (SELECT lang, count(*)::BIGINT AS n FROM words GROUP BY lang
), cuts AS MATERIALIZED ({cuts}
), scores AS (
  SELECT c.lang, c.phrase, p.size, p.n AS a, k, x.n AS l, y.n AS r, (({SCALE}::HUGEINT * p.n) // (x.n::HUGEINT + y.n))::BIGINT AS score
  FROM cuts c JOIN counts p USING (lang, phrase) JOIN counts x ON x.key = c.lang || chr(10) || f JOIN counts y ON y.key = c.lang || chr(10) || g
), best AS MATERIALIZED (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM best x WHERE x.lang = b.lang AND x.size > b.size AND 100 * x.a >= {SHARE} * b.a
      AND contains(' ' || x.phrase || ' ', ' ' || b.phrase || ' '))
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {TOP}"""


QUERIES = {"op12_phrase_collocations": op12_phrase_collocations}
SQL = {"op12_phrase_collocations": _sql()}

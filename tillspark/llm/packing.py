"""Packing of token ids into sequences of a fixed length by the sum-of-squares rule.

Method: online packing over fill levels. ``counts[h]`` is the number of open windows that hold h
tokens. A document of s tokens goes to the level h (an open window of that fill, or a new one for
h = 0) for which the sum of the squared counts of partly filled windows is least afterwards; ties
go to the fullest level. Levels that many windows share are thus avoided, so that for each fill
some window is there to complete it. The choice is one vector operation over the level array.

Documents longer than a window fill windows of their own; what is left of them is placed as
above. Windows still open at the end of a shard (or beyond ``MAX_OPEN``, which bounds memory) are
settled: pieces of the emptiest window are cut to fill the gaps of the fullest, until one is
left, and that one is cut into sequences of power-of-two lengths, which need no padding. So no
sequence has padding, and apart from documents over the window length only the pieces that
settled windows end with are cut.

A shard is one task's share of the scan: texts are neither shuffled nor sorted, and each task
holds the ids of its open windows alone. Ids come from the tokenizers library: a text is cut at
white space as the model's own rule cuts it, each distinct part is encoded once (parts of Latin
letters by tiktoken with the same vocabulary: equal ids), and ids are gathered by position. Parts and ids kept for reuse are bounded by count and by characters.

Defined cases: null or empty text is the end id alone; repeated rows are documents of their own;
rows of null doc_id likewise; an empty table gives no row; very long texts are encoded in slices
of parts (one unbroken run of characters is one part); further columns do not matter.
"""

from __future__ import annotations

import base64
import re
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import chunks, documents, resident, written
from .token_files import load_tokenizer, word_encoder
from .wordpool import ragged

LENGTH = 1_024
END_ID = 0
MAX_OPEN = 4_096
SLICE = 1_000_000
CHUNK_BYTES = 4_000_000
POOL_PARTS, POOL_CHARACTERS = 1_000_000, 16_000_000
ROWS_OUT = 20_000
# The model cuts a text at white space: a run of other characters takes one blank before it along,
# and a run of white space leaves its last character to what follows. (White space of Unicode.)
WIDE_BLANKS = "\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BLANK = f"\t-\r {WIDE_BLANKS}"
ASCII_BLANKS = np.isin(np.arange(256), [*range(9, 14), 32])
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""  # fixed: the model's own rule
OTHER = re.compile(f"[^\x21-\x84\x86-\x9f\xa1-\u024f ]|^[{BLANK}]+$")
PARTS = re.compile(f" ?[^{BLANK}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")
OUT = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, shard bigint, "
       "local bigint, offset bigint")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def ranks_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def part_encoder(tokenizer, ranks: str | None):
    """Flat ids and their number for each of a list of parts.

    Parts of Latin letters are encoded by tiktoken with the same vocabulary, given as ranks (the
    same ids at a fifth of the time); all others, and all parts without ranks, by the library.
    """
    import tiktoken

    by_library, added = word_encoder(tokenizer), {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    if ranks:
        with open(ranks, "rb") as f:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        quick = tiktoken.Encoding("parts", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        (line_feed,) = quick.encode_ordinary("\n")

    def encode(parts: list[str]):
        latin = np.fromiter((bool(ranks) and p not in added and not OTHER.search(p) for p in parts), bool, len(parts))
        flat, lengths = [], np.zeros(len(parts), np.int64)
        if latin.any():  # one call, with line feeds between: no part holds one
            ids = np.array(quick.encode_ordinary("\n".join(islice_by(parts, latin))), np.int32)
            ends = np.append(np.flatnonzero(ids == line_feed), len(ids))
            lengths[latin] = np.diff(ends, prepend=-1) - 1
            flat.append((np.flatnonzero(latin), ids[ids != line_feed]))
        if not latin.all():
            ids, lengths[~latin] = by_library(list(islice_by(parts, ~latin)))
            flat.append((np.flatnonzero(~latin), ids))
        if len(flat) == 1:
            return flat[0][1], lengths
        out = np.empty(int(lengths.sum()), np.int32)
        starts = np.cumsum(lengths) - lengths
        for places, ids in flat:
            out[ragged(starts[places], lengths[places])] = ids
        return out, lengths
    return encode


def islice_by(parts: list[str], keep: np.ndarray):
    return (parts[i] for i in np.flatnonzero(keep))


class PartPool(dict):
    """part -> place in a pool of id sequences; each distinct part is encoded once.

    Starts anew beyond ``limit`` parts or ``most`` characters, so its memory is bounded.
    """

    def __init__(self, tokenizer, ranks: str | None = None, limit: int = POOL_PARTS, most: int = POOL_CHARACTERS):
        self.limit, self.most, self.encode = limit, most, part_encoder(tokenizer, ranks)
        special = sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile(f"({'|'.join(map(re.escape, special)) or '(?!)'})")
        self.odd = "|".join([f"[{WIDE_BLANKS}]", *map(re.escape, special)])
        self.empty()

    def empty(self) -> None:
        self.clear()
        self.fresh: list[str] = []
        self.characters = 0
        self.ids, self.starts, self.lengths = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def __missing__(self, part: str) -> int:
        self[part] = place = len(self)
        self.fresh.append(part)
        self.characters += len(part)
        return place

    def places(self, parts) -> np.ndarray:
        """Where the ids of each part stand; parts not met before are encoded."""
        places = np.fromiter(map(self.__getitem__, parts), np.int64, len(parts))
        if self.fresh:
            flat, lengths = self.encode(self.fresh)
            self.starts = np.append(self.starts, len(self.ids) + np.cumsum(lengths) - lengths)
            self.ids, self.lengths = np.append(self.ids, flat), np.append(self.lengths, lengths)
            self.fresh = []
        return places

    def gathered(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and their number for each of the parts."""
        if len(self) > self.limit or self.characters > self.most:
            self.empty()
        coded = parts.dictionary_encode()
        places = self.places(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        lengths = self.lengths[places]
        return self.ids[ragged(self.starts[places], lengths)], lengths

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of texts and the offset of each text (one more)."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        odd = np.flatnonzero(pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False))
        if not len(odd):
            return self.plain(texts)
        out, at = [], 0
        for i in [*odd.tolist(), len(texts)]:
            if at < i:
                flat, offsets = self.plain(texts[at:i])
                out.append((flat, np.diff(offsets)))
            if i < len(texts):
                parts, flat = iter(self.split(texts[i].as_py())), []
                while some := list(islice(parts, SLICE)):
                    flat.append(self.gathered(pa.array(some, pa.string()))[0])
                out.append((np.concatenate(flat), [sum(map(len, flat))]))
            at = i + 1
        return np.concatenate([f for f, _ in out]), np.concatenate([[0], np.cumsum(np.concatenate([n for _, n in out]))])

    def split(self, text: str):
        """Parts of a text whose ids, one after the other, are its ids; special tokens stand alone."""
        for i, s in enumerate(self.special.split(text)):
            if i % 2:
                yield s
            else:
                yield from (m.group() for m in PARTS.finditer(s))

    def plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts without special tokens whose white space is ASCII, cut as bytes."""
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = (np.frombuffer(raw, np.uint8) if raw else np.empty(0, np.uint8))[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        blank = ASCII_BLANKS[data]
        after_blank, before_word = np.zeros(len(data), bool), np.zeros(len(data), bool)
        after_blank[1:], before_word[:-1] = blank[:-1], ~blank[1:] & ~first[1:len(data)]
        after_other = after_blank & (np.append(np.uint8(0), data[:-1]) != 0x20)[:len(data)]  # a line feed or the like
        bounds = np.flatnonzero(first[:len(data)] | np.where(blank, ~after_blank | before_word, after_other))
        ends, buffer = np.append(bounds[1:], len(data)).astype(np.int32), pa.py_buffer(data)
        flat, lengths = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for a in range(0, len(bounds), SLICE):
            cut = np.append(bounds[a:a + 1], ends[a:a + SLICE]).astype(np.int32)
            ids, n = self.gathered(pa.StringArray.from_buffers(len(cut) - 1, pa.py_buffer(cut), buffer))
            flat.append(ids)
            lengths.append(n)
        sums = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
        return np.concatenate(flat), sums[np.searchsorted(bounds, offsets)]


def part_pool(path: str, ranks: str | None) -> PartPool:
    return resident(("part pool", path, ranks), lambda: PartPool(load_tokenizer(path), ranks))


def ids_of(pool: PartPool, texts: pa.Array) -> list[np.ndarray]:
    """The ids of each text, without an end id."""
    flat, offsets = pool.texts(texts)
    return [flat[a:b] for a, b in zip(offsets, offsets[1:])]


class Levels:
    """The open windows of a shard by fill level; ``done`` receives each closed window's pieces.

    A piece is (document, start, ids); a document is any value.
    """

    def __init__(self, length: int, done, most_open: int = MAX_OPEN):
        self.length, self.done, self.most_open = length, done, most_open
        self.windows = [[] for _ in range(length)]  # level -> open windows, each a list of pieces
        self.open = 0
        # What the squares grow by when a window comes to a level, and fall by when one leaves it.
        self.comes = np.ones(length + 1, np.int64)
        self.leaves = np.full(length, np.iinfo(np.int64).min // 4)
        self.comes[length] = self.leaves[0] = 0

    def count(self, level: int) -> None:
        n = len(self.windows[level])
        self.comes[level] = 2 * n + 1
        self.leaves[level] = 2 * n - 1 if n else np.iinfo(np.int64).min // 4

    def choose(self, size: int) -> int:
        """The level whose change of the sum of squares is least, the fullest of equals."""
        change = self.comes[size:] - self.leaves[:self.length - size + 1]
        return self.length - size - int(np.argmin(change[::-1]))

    def add(self, document, ids: np.ndarray) -> None:
        full = len(ids) // self.length * self.length
        for start in range(0, full, self.length):
            self.done([(document, start, ids[start:start + self.length])])
        if full < len(ids):
            self.place((document, full, ids[full:].copy()))

    def place(self, piece) -> None:
        size = len(piece[2])
        level = self.choose(size)
        window = self.windows[level].pop() if level else []
        if level:
            self.count(level)
            self.open -= 1
        window.append(piece)
        if level + size == self.length:
            self.done(window)
            return
        self.windows[level + size].append(window)
        self.count(level + size)
        self.open += 1
        if self.open > self.most_open:
            self.settle(self.most_open // 2)

    def settle(self, keep: int) -> None:
        """Cuts pieces of the emptiest windows to fill the fullest, until ``keep`` are open."""
        waiting = [(level, w) for level, ws in enumerate(self.windows) for w in ws]
        low, high = 0, len(waiting) - 1
        while high - low + 1 > keep and low < high:
            level, target = waiting[high]
            gap, donor = self.length - level, waiting[low][1]
            while gap and donor:
                document, start, ids = donor.pop()
                target.append((document, start, ids[:gap]))
                if len(ids) > gap:
                    donor.append((document, start + gap, ids[gap:]))
                gap -= len(target[-1][2])
            if not donor:
                low += 1
            else:
                waiting[low] = (sum(len(p[2]) for p in donor), donor)
            if gap:
                waiting[high] = (self.length - gap, target)
            else:
                self.done(target)
                high -= 1
        self.windows = [[] for _ in range(self.length)]
        for level, window in waiting[low:high + 1]:
            self.windows[level].append(window)
        self.open = high - low + 1
        for level in range(1, self.length):
            self.count(level)

    def close(self) -> None:
        """Settles all windows; the last is cut into sequences of power-of-two lengths."""
        self.settle(1)
        for level, windows in enumerate(self.windows):
            for window in windows:
                for bit in reversed(range(level.bit_length())):
                    if room := level & 1 << bit:
                        sequence = []
                        while room:
                            document, start, ids = window.pop()
                            sequence.append((document, start, ids[:room]))
                            if len(ids) > room:
                                window.append((document, start + room, ids[room:]))
                            room -= len(sequence[-1][2])
                        self.done(sequence)
        self.windows, self.open = [[] for _ in range(self.length)], 0


class Rows:
    """Closed windows as rows; ``take`` hands over what has gathered."""

    def __init__(self, shard: int):
        self.shard, self.local, self.rows = shard, 0, []

    def __call__(self, window) -> None:
        offset = 0
        for (doc_id, tokens), start, ids in window:
            self.rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4")), tokens, self.shard, self.local, offset))
            offset += len(ids)
        self.local += 1

    def take(self) -> pa.RecordBatch:
        columns = zip(*self.rows) if self.rows else [[]] * 8
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=[f.split()[0] for f in OUT.split(", ")])


def pack(docs: DataFrame, path: str | None = None, ranks: str | None = None, length: int = LENGTH, end_id: int = END_ID, most_open: int = MAX_OPEN) -> DataFrame:
    """One row a piece of ``docs`` (doc_id, text): its sequence, and where it stands in it."""
    if path is None:
        path, ranks = tokenizer_path(), ranks_path()

    def run(batches):
        pool, out = part_pool(path, ranks), Rows(TaskContext.get().partitionId())
        levels = Levels(length, out, most_open)
        for batch in batches:
            for part in chunks(batch, "text", CHUNK_BYTES):
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), ids_of(pool, part.column("text"))):
                    ids = np.append(ids, np.int32(end_id))
                    levels.add((doc_id, len(ids)), ids)
                if len(out.rows) >= ROWS_OUT:
                    yield out.take()
        levels.close()
        yield out.take()

    pieces = written(docs.select("doc_id", "text").mapInArrow(run, OUT), "pieces")
    # One row a task, so at most the number of scan tasks.
    shards = pieces.groupBy("shard").agg((F.max("local") + 1).alias("sequences"))
    before = F.sum("sequences").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    firsts = shards.select("shard", F.coalesce(before, F.lit(0)).alias("first"))
    return pieces.join(F.broadcast(firsts), "shard").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("first") + F.col("local")).alias("sequence_id"), "offset")


def op13_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


QUERIES = {"op13_sum_of_squares_packing": op13_sum_of_squares_packing}

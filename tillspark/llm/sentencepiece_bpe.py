"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

Encoding turns blanks into the piece marker, puts one in front, and cuts the text before
each run of markers: no piece holds a marker after another character (checked when the
model is read), so no merge crosses such a cut. Distinct words are encoded once. All of
them lie in one flat symbol array; each round looks up the rank of every neighbouring pair,
takes the smallest rank of each word (a segmented minimum), merges all its occurrences
at once, leftmost first where they overlap, and compacts the array; words without a pair
left drop out. Where several pieces share one score (in this model, runs of blanks), their
merges hang on each other, and such a word is finished one merge at a time. A single character without a piece falls back to its UTF-8 bytes.

Decoding gathers the bytes of each id's piece and drops the leading blank.

Defined cases: null or empty text has no ids and decodes to ''; null ids decode to '';
U+2581 in a text is a blank to this model, as in the library; an input column named as
the output is replaced; other columns pass through.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, documents, resident, slices, texts_of, with_column
from .wordpool import WordPool, ragged

MARK = "▁"
WORDS = re.compile(f"{MARK}+[^{MARK}\n]*|\n+|[^{MARK}\n]+")
NONE = np.iinfo(np.int32).max
DECODED_AT_ONCE = 300_000


def model_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class PieceModel:
    """Tables of a BPE model with byte fallback, read through the sentencepiece library."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
        pieces = {names[i]: i for i in range(n) if not special[i]}
        if any(MARK in p.lstrip(MARK) or ("\n" in p and p.strip("\n")) for p in pieces):
            raise ValueError("a piece of this model crosses a word cut")
        self.byte_ids = np.zeros(256, np.int32)
        bytes_of = []
        for i in range(n):
            if sp.is_byte(i):
                value = int(names[i][3:5], 16)
                self.byte_ids[value] = i
                bytes_of.append(bytes([value]))
            elif sp.is_control(i):
                bytes_of.append(b"")
            elif sp.is_unknown(i):
                bytes_of.append(" ⁇ ".encode())
            else:
                bytes_of.append(names[i].replace(MARK, " ").encode())
        self.bytes = np.frombuffer(b"".join(bytes_of), np.uint8)
        self.byte_lengths = np.fromiter(map(len, bytes_of), np.int64, n)
        self.byte_starts = np.cumsum(self.byte_lengths) - self.byte_lengths
        self.leads_blank = np.fromiter((p.startswith(MARK) and not s for p, s in zip(names, special)), bool, n)
        # symbols: all pieces, and characters that occur in pieces without being one
        symbols = dict(pieces)
        for p in pieces:
            for c in p:
                symbols.setdefault(c, n + len(symbols))
        chars = sorted((ord(s), i) for s, i in symbols.items() if len(s) == 1)
        self.char_codes = np.array([c for c, _ in chars], np.int64)
        self.char_symbols = np.array([i for _, i in chars], np.int64)
        order = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in pieces.values()}, reverse=True))}
        self.tied = np.bincount([order[sp.get_score(i)] for i in pieces.values()]) > 1
        pairs, inside = {}, set()
        for p, i in pieces.items():
            for cut in range(1, len(p)):
                inside.add(ord(p[cut - 1]) << 21 | ord(p[cut]))
                left, right = symbols.get(p[:cut]), symbols.get(p[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = (order[sp.get_score(i)], i)
        keys = sorted(pairs)
        self.pair_keys = np.array(keys, np.int64)
        self.pair_ranks = np.array([pairs[k][0] for k in keys], np.int32)
        self.pair_merged = np.array([pairs[k][1] for k in keys], np.int64)
        self.inside = np.array(sorted(inside), np.int64)
        self.size = n

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of pairs (``NONE`` where they do not merge)."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        hit = self.pair_keys[at] == keys
        return np.where(hit, self.pair_ranks[at], NONE), self.pair_merged[at]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the words and the number of ids of each."""
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        owner = np.repeat(np.arange(len(words)), lengths)
        n = len(codes)
        at = np.minimum(np.searchsorted(self.char_codes, codes), len(self.char_codes) - 1)
        known = self.char_codes[at] == codes
        sym = np.where(known, self.char_symbols[at], -1 - codes)
        # segments: words, cut again where no piece holds the two characters side by side
        neighbours = codes[:-1] << 21 | codes[1:]
        near = self.inside[np.minimum(np.searchsorted(self.inside, neighbours), len(self.inside) - 1)] == neighbours
        first = np.concatenate([[True], (owner[1:] != owner[:-1]) | ~near]) if n else np.zeros(0, bool)
        place = np.arange(n)  # of a symbol's first character: keeps the order in the end
        done_sym, done_place = [], []
        while len(sym):
            rank = np.full(len(sym), NONE, np.int32)
            merged = np.zeros(len(sym), np.int64)
            inner = np.flatnonzero(~first[1:])
            rank[inner], merged[inner] = self._rank(sym[inner], sym[inner + 1])
            starts = np.flatnonzero(first)
            sizes = np.diff(np.append(starts, len(sym)))
            least = np.minimum.reduceat(rank, starts)
            tied = (least != NONE) & self.tied[np.where(least == NONE, 0, least)]
            if tied.any():  # pieces of equal score: their merges hang on each other, one at a time
                for w in np.flatnonzero(tied):
                    part = slice(starts[w], starts[w] + sizes[w])
                    kept = self._one_by_one(sym[part].tolist())
                    done_sym.append(np.array([x for _, x in kept], np.int64))
                    done_place.append(place[part][[i for i, _ in kept]])
                stay = np.repeat(~tied, sizes)
                sym, place, first, rank, merged = (x[stay] for x in (sym, place, first, rank, merged))
                least, sizes = least[~tied], sizes[~tied]
                if not len(sym):
                    break
            live = np.repeat(least != NONE, sizes)
            if not live.all():
                done_sym.append(sym[~live])
                done_place.append(place[~live])
            pick = live & (rank == np.repeat(least, sizes))
            # of picks in a row, every second overlaps the one before
            index = np.arange(len(sym))
            head = pick & ~np.concatenate([[False], pick[:-1]])
            run = np.maximum.accumulate(np.where(head, index, 0))
            pick &= (index - run) % 2 == 0
            sym = np.where(pick, merged, sym)
            keep = live & ~np.concatenate([[False], pick[:-1]])
            sym, place, first = sym[keep], place[keep], first[keep]
        if not n:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        sym, place = np.concatenate(done_sym), np.concatenate(done_place)
        order = np.argsort(place, kind="stable")
        return self._to_ids(sym[order], codes[place[order]], owner[place[order]], len(words))

    def _one_by_one(self, sym: list[int]) -> list[tuple[int, int]]:
        """The merges of one segment in order of (rank, place): (place, symbol) that stay."""
        n = len(sym)
        right, left, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []

        def offer(i):
            if i >= 0 and right[i] < n:
                r, m = self._rank(np.array([sym[i]]), np.array([sym[right[i]]]))
                if r[0] != NONE:
                    heapq.heappush(heap, (int(r[0]), i, right[i], sym[i], sym[right[i]], int(m[0])))

        for i in range(n):
            offer(i)
        while heap:
            _, i, j, a, b, m = heapq.heappop(heap)
            if sym[i] != a or right[i] != j or sym[j] != b:
                continue
            sym[i], sym[j], right[i] = m, None, right[j]
            if right[i] < n:
                left[right[i]] = i
            offer(i)
            offer(left[i])
        return [(i, x) for i, x in enumerate(sym) if x is not None]

    def _to_ids(self, sym, codes, owner, n_words):
        """Ids of final symbols; a character without a piece becomes its UTF-8 bytes."""
        bare = (sym < 0) | (sym >= self.size)
        if bare.any():
            utf8 = [chr(c).encode("utf-8", "surrogatepass") for c in codes[bare]]
            times = np.ones(len(sym), np.int64)
            times[bare] = [len(b) for b in utf8]
            out = np.repeat(sym, times)
            out[np.repeat(bare, times)] = self.byte_ids[np.frombuffer(b"".join(utf8), np.uint8)]
            sym, owner = out, np.repeat(owner, times)
        return sym.astype(np.int32), np.bincount(owner, minlength=n_words)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        lengths = self.byte_lengths[ids]
        raw = self.bytes[ragged(self.byte_starts[ids], lengths)].tobytes()
        ends = np.concatenate([[0], np.cumsum(lengths)])[offsets]
        out = []
        for i in range(len(offsets) - 1):
            skip = int(offsets[i + 1] > offsets[i] and self.leads_blank[ids[offsets[i]]])
            out.append(raw[ends[i] + skip:ends[i + 1]].decode("utf-8", "replace"))
        return out


def split_words(text: str) -> list[str]:
    return WORDS.findall(MARK + text.replace(" ", MARK)) if text else []


def encode(df: DataFrame, text: str = "text", out: str = "ids", path: str | None = None) -> DataFrame:
    """``df`` with the ids of its text column."""
    path = path or model_path()

    def make(batch):
        pool = resident(("sentencepiece pool", path), lambda: WordPool(
            resident(("sentencepiece", path), lambda: PieceModel(path)).encode_words))
        for part in chunks(batch, text):
            ids, offsets = pool.texts([split_words(t) for t in texts_of(part, text)])
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))],
                [*part.schema.names, out])

    return with_column(df, out, "array<int>", make)


def encode_and_decode(df: DataFrame, text: str = "text", ids: str = "ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """``df`` with the ids of its text column and the text that they decode to, in one Python worker
    a task (``encode`` and then ``decode`` need two)."""
    path = path or model_path()

    def make(batch):
        model = resident(("sentencepiece", path), lambda: PieceModel(path))
        pool = resident(("sentencepiece pool", path), lambda: WordPool(model.encode_words))
        for part in chunks(batch, text):
            flat, offsets = pool.texts([split_words(t) for t in texts_of(part, text)])
            made = pa.StructArray.from_arrays([pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
                                               pa.array(model.decode(flat, offsets), pa.string())], [ids, out])
            yield pa.RecordBatch.from_arrays([*part.columns, made], [*part.schema.names, "_made"])

    made = with_column(df.drop(ids, out), "_made", f"struct<`{ids}`:array<int>,`{out}`:string>", make)
    return made.select("*", "_made.*").drop("_made")


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """``df`` with the text of its id column."""
    path = path or model_path()

    def make(batch):
        model = resident(("sentencepiece", path), lambda: PieceModel(path))
        tokens = pc.fill_null(pc.list_value_length(batch.column(ids)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        for part, lengths in slices(batch, tokens, DECODED_AT_ONCE):
            column = part.column(ids)
            flat = column.flatten().to_numpy(zero_copy_only=False)
            texts = model.decode(flat, np.concatenate([[0], np.cumsum(lengths)]))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, out])

    return with_column(df, out, "string", make)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = encode(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "ids")
    return decode(ids).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op3_sentencepiece": op3_sentencepiece}

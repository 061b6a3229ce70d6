"""Token-id output in Arrow stream files: packed sequences of equal length, with masks.

Documents go in ascending ``doc_id`` order (null ids first, equal ids by the hash of their
text) to shards of equal id width; a shard is one task's sorted run, written batch by batch:

* ``shard-<n>.arrow``: an Arrow IPC stream of batches with columns ``input_ids``
  (fixed-size list of uint16, or uint32 for larger vocabularies) and ``mask`` (fixed-size
  list of bool, false in the padding of the shard's last sequence);
* ``shard-<n>.index.arrow``: doc_id, start (in the shard) and n_tokens of its documents.

A reader maps the file and takes each sequence as a view on the mapped pages. A task
writes to a name of its own and renames it when complete, so a retried task replaces the
file by an equal one and a half-written file is never read.

Defined cases: null or empty text is the end id alone; an empty table gives no shard;
repeated rows are written each; further columns of the input do not matter.
"""

from __future__ import annotations

import math
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import chunks, documents, range_of, resident, shared_path, texts_of, written
from .wordpool import WordPool

ROWS_PER_SHARD = 4_000
MAX_SHARDS = 200_000
MAX_READERS = 10_000
SEQUENCE = 2_048
SEQUENCES_PER_BATCH = 128
END_ID = 2
POOL = 1_000_000
# No token of this model holds a blank or line feed, so any text may be cut there.
WORDS = re.compile("[^ \n]+")
# Texts of Latin letters alone are cut as the model's own rule does, after its lower-casing:
# contractions, runs of letters, single numbers, runs of other marks (below U+0250).
LETTERS, NUMBERS, BLANKS = "A-Za-zªµºÀ-ÖØ-öø-\u024f", "0-9²³¹¼½¾", "\t\n\x0b\x0c\r \x85\xa0"
PIECES = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{LETTERS}]+|[{NUMBERS}]|[^{BLANKS}{LETTERS}{NUMBERS}]+")
BEYOND = re.compile("[^\x00-\u024f]")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def load_tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def split_text(text: str) -> list[str]:
    """Parts of a text whose ids, one after the other, are the ids of the text."""
    lowered = text.lower()  # some capitals below U+0250 have their small letter beyond it
    if (lowered.isascii() or not BEYOND.search(lowered)) and "<|" not in text:
        return PIECES.findall(lowered)
    return WORDS.findall(text)


def word_encoder(tokenizer):
    def encode(words: list[str]):
        ids = [e.ids for e in tokenizer.encode_batch(words, add_special_tokens=False)]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for x in ids for i in x), np.int32, int(lengths.sum())), lengths
    return encode


def token_pool(path: str) -> WordPool:
    return resident(("token pool", path), lambda: WordPool(word_encoder(load_tokenizer(path)), POOL))


def with_shard(docs: DataFrame) -> DataFrame:
    """Adds ``shard``: the place of doc_id among ranges of equal width (null ids: -1)."""
    lo, hi, n = docs.agg(F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1))).first()
    shards = max(1, min(MAX_SHARDS, math.ceil((n or 0) / ROWS_PER_SHARD)))
    width = max(1, -(-((hi or 0) - (lo or 0) + 1) // shards))
    return docs.withColumn("shard", range_of("doc_id", lo, width))


class ShardWriter:
    """Packs token ids of one shard into sequences; ``close`` makes both files visible."""

    def __init__(self, folder: str, shard: int, length: int, dtype: str):
        self.fs, root = pafs.FileSystem.from_uri(folder)
        self.fs.create_dir(root, recursive=True)
        self.length, self.dtype, self.final = length, np.dtype(dtype), f"{root}/shard-{shard}"
        self.temporary = f"{root}/.{shard}-{uuid.uuid4().hex}"
        self.schema = pa.schema([("input_ids", pa.list_(pa.from_numpy_dtype(self.dtype), length)),
                                 ("mask", pa.list_(pa.bool_(), length))])
        self.sink = self.fs.open_output_stream(self.temporary)
        self.out = pa.ipc.new_stream(self.sink, self.schema)
        self.waiting, self.waits, self.total = [], 0, 0
        self.docs = []

    def add(self, doc_ids: list, ids: np.ndarray, lengths: np.ndarray) -> None:
        ends = self.total + np.cumsum(lengths)
        self.docs.append(pa.table({"doc_id": pa.array(doc_ids, pa.int64()), "start": ends - lengths, "n_tokens": lengths}))
        self.total = int(ends[-1])
        self.waiting.append(ids.astype(self.dtype))
        self.waits += len(ids)
        if self.waits >= self.length * SEQUENCES_PER_BATCH:
            self.flush(self.waits // self.length * self.length)

    def flush(self, n: int, real: int | None = None) -> None:
        flat = np.concatenate(self.waiting)
        self.waiting, self.waits = [flat[n:]], len(flat) - n
        size = self.length * SEQUENCES_PER_BATCH
        for at in range(0, n, size):
            part = flat[at:min(at + size, n)]
            mask = np.arange(at, at + len(part)) < (n if real is None else real)
            self.out.write_batch(pa.record_batch(
                [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (part, mask)], schema=self.schema))

    def close(self) -> tuple[int, int]:
        if self.waits:
            real = self.waits
            padding = -real % self.length
            self.waiting.append(np.zeros(padding, self.dtype))
            self.waits += padding
            self.flush(self.waits, real)
        self.out.close()
        self.sink.close()
        index = pa.concat_tables(self.docs)
        with self.fs.open_output_stream(f"{self.temporary}.index") as sink, pa.ipc.new_stream(sink, index.schema) as out:
            out.write_table(index)
        self.fs.move(f"{self.temporary}.index", f"{self.final}.index.arrow")
        self.fs.move(self.temporary, f"{self.final}.arrow")
        return index.num_rows, self.total


class ShardReader:
    """Sequences and documents of one shard; on a local file system, views on the mapped file."""

    def __init__(self, folder: str, shard: int):
        fs, root = pafs.FileSystem.from_uri(folder)
        local = isinstance(fs, pafs.LocalFileSystem)

        def read(name):
            source = pa.memory_map(f"{root}/{name}") if local else fs.open_input_file(f"{root}/{name}")
            return pa.ipc.open_stream(source)

        self.index = read(f"shard-{shard}.index.arrow").read_all()
        self.batches = list(read(f"shard-{shard}.arrow"))
        self.firsts = np.cumsum([0, *(b.num_rows for b in self.batches)])

    def __len__(self) -> int:
        return int(self.firsts[-1])

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """Ids (a view, not a copy) and mask of the i-th sequence."""
        b = int(np.searchsorted(self.firsts, i, "right")) - 1
        row = i - int(self.firsts[b])
        ids, mask = (self.batches[b].column(c)[row].values for c in ("input_ids", "mask"))
        return ids.to_numpy(zero_copy_only=True), mask

    def parts(self, start: int, n: int):
        """The ids [start, start + n) of the shard, as views, one a batch touched."""
        for b, batch in enumerate(self.batches):
            column = batch.column("input_ids")
            length = column.type.list_size
            first, last = int(self.firsts[b]) * length, int(self.firsts[b + 1]) * length
            if first < start + n and last > start:
                yield column.flatten().to_numpy(zero_copy_only=True)[max(start - first, 0):start + n - first]


def write_token_files(docs: DataFrame, folder: str, path: str | None = None, length: int = SEQUENCE,
                      end_id: int = END_ID) -> DataFrame:
    """Writes the files of ``docs`` (doc_id, text); returns one row a shard: shard, docs, tokens."""
    path = path or tokenizer_path()
    dtype = "uint16" if load_tokenizer(path).get_vocab_size() <= 1 << 16 else "uint32"
    rows = (with_shard(docs.select("doc_id", "text")).repartition("shard")
            .sortWithinPartitions("shard", "doc_id", F.xxhash64("text")))

    def run(batches):
        pool, writer, shard = token_pool(path), None, None
        for batch in batches:
            shards = batch.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if b == a:
                    continue
                if shards[a] != shard:
                    if writer:
                        yield closed(writer, shard)
                    shard = int(shards[a])
                    writer = ShardWriter(folder, shard, length, dtype)
                for part in chunks(batch.slice(a, b - a), "text"):
                    ids, offsets = pool.texts([split_text(t) for t in texts_of(part, "text")])
                    writer.add(part.column("doc_id").to_pylist(), np.insert(ids, offsets[1:], end_id),
                               np.diff(offsets) + 1)
        if writer:
            yield closed(writer, shard)

    def closed(writer, shard):
        n_docs, n_tokens = writer.close()
        return pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int64()), "docs": pa.array([n_docs], pa.int64()),
                                           "tokens": pa.array([n_tokens], pa.int64())})

    return written(rows.mapInArrow(run, "shard bigint, docs bigint, tokens bigint"), "shards")


def read_token_files(shards: DataFrame, folder: str) -> DataFrame:
    """Reads the files of the listed shards: doc_id, start, n_tokens, ids_crc32 a document."""
    before = F.coalesce(F.sum("tokens").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    tasks = max(1, min(shards.count(), MAX_READERS))
    shards = shards.select("shard", before.alias("base")).repartition(tasks, "shard")

    def run(batches):
        for batch in batches:
            for shard, base in zip(*(batch.column(c).to_pylist() for c in ("shard", "base"))):
                reader = ShardReader(folder, shard)
                index = reader.index
                crcs = []
                for start, n in zip(*(index.column(c).to_numpy() for c in ("start", "n_tokens"))):
                    crc = 0
                    for part in reader.parts(int(start), int(n)):
                        crc = zlib.crc32(part.astype("<u4"), crc)
                    crcs.append(crc)
                out = pa.table({"doc_id": index.column("doc_id"), "start": index.column("start").to_numpy() + base,
                                "n_tokens": index.column("n_tokens"), "ids_crc32": pa.array(crcs, pa.int64())})
                yield from out.combine_chunks().to_batches(max_chunksize=10_000)

    return shards.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_path(spark, "token-files")
    return read_token_files(write_token_files(documents(spark, sf_dir), folder), folder)


QUERIES = {"op6_token_files": op6_token_files}

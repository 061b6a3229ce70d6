"""Helpers shared by the operators: inputs, materialised tables, column guards, let-binding."""

from __future__ import annotations

import sys
import types
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillspark.session import ensure_checkpoint_dir


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage: a lost executor costs a re-read, and whatever reads the table
    twice sees the same rows.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def range_of(key: str, lo: int | None, width: int) -> Column:
    """The place of a whole-number key among ranges of equal width from ``lo`` on (null key: -1).

    In decimals, as the distance of two ids may not fit a long.
    """
    return F.coalesce(F.expr(f"CAST((CAST(`{key}` AS DECIMAL(20,0)) - CAST('{lo or 0}' AS DECIMAL(20,0))) "
                             f"div CAST('{width}' AS DECIMAL(20,0)) AS BIGINT)"), F.lit(-1))


def let(value: Column, body) -> Column:
    """Bind ``value`` to a lambda variable, so that it is evaluated once per use of ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves remainder 2 modulo 4 (null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def resident(key, make):
    """``make()`` once per Python worker process, kept for the tasks that follow in it.

    Task functions are pickled by value, so a module global would start empty in each.
    """
    store = sys.modules.setdefault("_tillspark_resident", types.ModuleType("_tillspark_resident")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def hand_back() -> None:
    """Gives memory that was freed back to the system: a worker serves many tasks, and what the C
    library keeps for itself counts against the executor (a no-op where it cannot be asked)."""
    import ctypes

    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    pa.default_memory_pool().release_unused()
    if trim:
        trim(0)


def chunks(batch, column: str, most_bytes: int = 1_000_000):
    """Slices of an Arrow batch of about ``most_bytes`` of text (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    return (part for part, _ in slices(batch, sizes, most_bytes))


def slices(batch, sizes: np.ndarray, most: int):
    """Slices of a batch, with the sizes of their rows, that add up to ``most`` (one row at least)."""
    sums, start = np.cumsum(sizes), 0
    while start < batch.num_rows:
        before = sums[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sums, before + most, "right")))
        yield batch.slice(start, end - start), sizes[start:end]
        start = end


def texts_of(batch, column: str) -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


def with_column(df: DataFrame, name: str, kind: str, make) -> DataFrame:
    """``df`` with column ``name`` made from Arrow batches by ``make(batch)`` (an array per
    batch); an input column of that name is replaced. ``make`` runs inside the tasks."""
    df = df.drop(name)

    def run(batches):
        for batch in batches:
            yield from make(batch)
            hand_back()

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T._parse_datatype_string(kind))]))

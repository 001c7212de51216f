"""What the operators share: reading tables, Arrow batches of texts, hold-out rules."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Texts are worked on in slices of about so many bytes; one longer text is a slice by itself.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def doc_columns(docs: DataFrame, *more: str) -> DataFrame:
    """Only ``doc_id`` (as long), ``text`` and the named columns; other columns cannot clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def crc_of_id(divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``limit`` bytes of text, or one row."""
    offsets = flat(batch.column(column))[1]
    start, rows = 0, batch.num_rows
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), rows)
        yield batch.slice(start, stop - start)
        start = stop


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and where each begins (one more entry at the end)."""
    filled = column.cast(pa.large_binary())
    if filled.null_count:
        filled = filled.fill_null(b"")
    _, offsets, data = filled.buffers()
    at = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def strings(column: pa.Array) -> list[str]:
    """Texts as Python strings, null as the empty one."""
    return [x if x is not None else "" for x in column.to_pylist()]


def per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive offsets; zero for an empty range."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def ascii_lower_aligned(text: str) -> str:
    """Lower case with every character where it was, so that offsets stay those of the text."""
    low = text.lower()
    if len(low) == len(text):
        return low
    return "".join(c if len(x := c.lower()) != 1 else x for c in text)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as make it new to ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


# A table of keys of at most so many rows is sent to all tasks; a longer one is shuffled.
BROADCAST_ROWS = 500_000


def sent(keys: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``keys``, a stored table of a few short columns, broadcast when it is known to be short."""
    return F.broadcast(keys) if keys.count() <= limit else keys


def without(docs: DataFrame, gone: DataFrame, *keys: str) -> DataFrame:
    """Rows of ``docs`` whose ``keys`` are not among those of ``gone``, a stored table; null
    equals null."""
    names = [free_name(docs, f"gone_{i}") for i in range(len(keys))]
    held = gone.select(*(F.col(k).alias(n) for k, n in zip(keys, names)))
    same = F.lit(True)
    for key, name in zip(keys, names):
        same = same & F.col(key).eqNullSafe(F.col(name))
    return docs.join(sent(held), same, "left_anti")


def appended(schema: StructType, ddl: str) -> StructType:
    """The schema with one more column, given as ``name type``."""
    return StructType([*schema.fields, *StructType.fromDDL(ddl).fields])


_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def map_batches(df: DataFrame, run: Callable, schema: StructType | str) -> DataFrame:
    """``mapInArrow`` with workers that look for this package where the driver found it."""
    environment = df.sparkSession.sparkContext.environment
    path = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in path:
        environment["PYTHONPATH"] = os.pathsep.join([*path, _ROOT])
    return df.mapInArrow(run, schema)

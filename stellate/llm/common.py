"""Helpers shared by the operators: reading tables, staged tables, bounded text batches.

Row identity is ``doc_id``. Rows that repeat a ``doc_id`` are one document with several
rows; every operator states what it does with them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.session import scratch_path
from stellate.sinks.staging import delete_path

#: Rows per Arrow batch sent to a Python worker, and bytes of text worked on at once.
ARROW_ROWS = 1000
SLICE_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_input(df: DataFrame, *columns: Column | str) -> DataFrame:
    """``df`` cut to ``columns``, with Arrow batches small enough for very long texts."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return df.select(*columns)


def slices(batches: Iterator[pa.RecordBatch], column: int = 1, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in order, in pieces of about ``limit`` bytes of text (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column)
        size = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
        piece = np.cumsum(size) // limit
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)


def gathered(batches: Iterator[pa.RecordBatch], limit: int, column: int = 1) -> Iterator[pa.RecordBatch]:
    """The same rows in order, in pieces of about ``limit`` bytes of text also across batches."""
    held: list[pa.RecordBatch] = []
    size = 0
    for piece in slices(batches, column, limit):
        held.append(piece)
        size += int(pc.sum(pc.binary_length(piece.column(column))).as_py() or 0)
        if size >= limit:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: computed once, and
    safe from lost executors. The path is kept on the frame for ``discard``."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.parquet(path)
    out._staged_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in frames:
        delete_path(df.sparkSession, df._staged_at)


def lists(values: np.ndarray, lengths: np.ndarray | list[int]) -> pa.ListArray:
    """A list column from its flat values and the length of each row."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def text_print(text: Column) -> Column:
    """64-bit print of a text; with ``doc_id`` it names a row."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def _row_key(doc_id: Column, mark: Column) -> Column:
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), mark.cast("string"))


def survivors(docs: DataFrame, kept: DataFrame, once: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that ``kept (doc_id, print)`` names; with ``once``,
    rows that repeat both id and text become one. A sort-merge join at every size."""
    key = "__row_key__"
    named = kept.select(_row_key(F.col("doc_id"), F.col("print")).alias(key)).distinct()
    out = docs.withColumn(key, _row_key(F.col(id_column), text_print(F.col(text_column)))).join(named.hint("merge"), key, "left_semi")
    return (out.dropDuplicates([key]) if once else out).drop(key)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (equal inputs and only those give equal outputs)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def sha256_of_list(items: Column) -> Column:
    """Lowercase hex SHA-256 of the items as text, joined by commas."""
    return F.sha2(F.array_join(items.cast("array<string>"), ",").cast("binary"), 256)

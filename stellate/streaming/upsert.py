"""Incremental load with Structured Streaming.

New files in a folder are picked up as micro-batches (``trigger(availableNow=True)`` runs
what is there and stops; ``maxFilesPerTrigger`` bounds one batch). Each micro-batch is
deduplicated on its own — two files in one batch may carry the same key — typed, and
merged into the target with ``stellate.sinks.tables.merge_into_path``.

No watermark is needed: the merge is keyed, so a late row simply updates its key. Order
does matter where two batches both hold a value for one cell — the later batch wins, as
with committed batches. The stream's checkpoint (in the shared folder) makes a restart skip
committed files; a micro-batch that was merged but not yet checkpointed comes again, and the
target's ledger, which knows it by stream and number, leaves it out and gives its counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from stellate.operators import dedup, mapping
from stellate.operators.mapping import TableMap
from stellate.session import scratch_path
from stellate.sinks import staging, tables
from stellate.sinks.files import Files


def upsert_stream(
    stream: DataFrame,
    batch_rows: Callable[[DataFrame], DataFrame],
    target_path: str,
    keys: list[str],
    checkpoint_location: str,
    partition_col: str | None = None,
    partition_of: Callable[[], object] | None = None,
    available_now: bool = True,
    log: list | None = None,
    dedup_within_batch: bool = True,
    unique_batches: bool = False,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Start a stream that merges ``batch_rows(micro_batch)`` into ``target_path``.

    Two files in one micro-batch may hold the same key, so by default each batch keeps
    the most complete row per key before merging (the merge needs unique keys).
    ``dedup_within_batch=False`` is for rows that ``batch_rows`` has already made unique;
    the merge checks that unless ``unique_batches`` vouches for it.
    ``log`` (a list) receives ``(batch_id, counts)`` per micro-batch for load metrics.
    ``interval`` is the time between micro-batches unless ``available_now``.
    """
    name = _stream_name(checkpoint_location)

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch_rows(batch)
        if dedup_within_batch:
            rows = dedup.most_complete(rows, keys).drop(dedup.SCORE)
        # Written once: the merge reads it for its months, its size and its rows.
        once = tables.write_staged(rows, "stream-batch")
        try:
            counts = tables.merge_into_path(
                spark,
                spark.read.schema(rows.schema).parquet(once),
                target_path,
                keys,
                partition_col,
                partition_of() if partition_of else None,
                unique_source=dedup_within_batch or unique_batches,
                batch=f"{name}-{batch_id}",
                source_bytes=Files(spark, once).size(once),
            )
        finally:
            staging.delete_path(spark, once)
        if log is not None:
            log.append((batch_id, counts))

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def _stream_name(checkpoint_location: str) -> str:
    """A stream is its checkpoint: the same folder goes on with the same batch numbers."""
    return "stream-" + hashlib.md5(checkpoint_location.encode(), usedforsecurity=False).hexdigest()[:12]


def run_fact_stream(
    spark: SparkSession,
    events_path: str,
    start: DataFrame,
    fact: TableMap,
    max_files_per_trigger: int = 1,
) -> DataFrame:
    """Stream the ``events`` files matching ``events_path`` (a folder plus a file-name
    pattern, e.g. ``…/events*.parquet``) into one fact table that starts as ``start``.

    Each micro-batch: wide view → most complete row per (entity, day) → typed fact →
    merge into the month-partitioned target. Returns the target after the stream ends.
    """
    from stellate.plans import views as V

    target_path = scratch_path(spark, f"stream-{fact.name}")
    ckpt = scratch_path(spark, f"stream-{fact.name}-ckpt")
    day = fact.key_names[1]
    tables.merge_into_path(spark, start, target_path, fact.key_names, "month", tables.month_of(day))

    folder, _, pattern = events_path.rstrip("/").rpartition("/")
    schema = spark.read.parquet(events_path).schema
    stream = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .option("pathGlobFilter", pattern)
        .parquet(folder)
    )
    q = upsert_stream(
        stream,
        lambda b: mapping.project(V.w_dedup(V.wide_view(b)), fact),
        target_path,
        fact.key_names,
        ckpt,
        partition_col="month",
        partition_of=lambda: tables.month_of(day),
        dedup_within_batch=False,
        unique_batches=True,  # w_dedup leaves one row for each key
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")
    return spark.read.parquet(target_path).select(*fact.key_names, *fact.value_names)


def load_wide_stream(
    spark: SparkSession,
    folder: str,
    schema,
    targets_root: str,
    checkpoint_location: str,
    header: list[str],
    max_files_per_trigger: int = 1,
    strict: bool = True,
    available_now: bool = True,
    log: list | None = None,
    interval: str = "1 minute",
) -> StreamingQuery:
    """The whole wide-file load as a stream: every new CSV file in ``folder`` (all with
    ``header``) is read as text and loaded like a batch file — dedup, dimension, facts —
    in its micro-batch. ``log`` receives ``(batch_id, LoadResult)`` per micro-batch.

    Files of one micro-batch are deduplicated together; across micro-batches the later
    one wins where both carry a value, as with files loaded one after another.
    """
    from stellate.plans.load import load_wide_frame
    from stellate.sources.csv import check_header, text_schema

    check_header(header, schema.required)
    stream = (
        spark.readStream.schema(text_schema(header))
        .option("header", True)
        .option("enforceSchema", False)  # every file's header must be this one, else the batch fails
        .option("mode", "FAILFAST")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .csv(folder)
    )

    def each(batch: DataFrame, batch_id: int) -> None:
        run_id = f"{_stream_name(checkpoint_location)}-{batch_id}"
        res = load_wide_frame(batch.sparkSession, batch, schema, targets_root, strict=strict, run_id=run_id)
        if log is not None:
            log.append((batch_id, res))

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()

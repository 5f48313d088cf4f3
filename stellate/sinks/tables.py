"""Writing targets.

Parquet has no row-level update. A merge therefore rewrites whole partitions: the merged
rows of the *affected* partitions replace those partitions, and only those. Untouched
months are never read or rewritten.

Failures. A merge first writes the complete new partitions beside the target's ledger
(``stellate.sinks.ledger``). Then it is published there, which decides it, and Spark's own
committers put the staged rows in place: a dynamic partition overwrite, or a plain overwrite
of a target without partitions. The staged rows stay until that job has committed. A driver
lost before the publishing leaves the old target; one lost after it leaves staged rows that
the next merge puts in place again. Partitions that do not exist yet are written straight
into the target, published before, so that an unfinished write is known and taken back.

Reading never changes anything. ``read_target`` gives the rows that the ledger has decided:
while a merge is being put in place, its partitions come from the staged rows and all others
from the target. A reader that has planned its scan before a switch fails on the replaced
files and plans again, as with any Spark overwrite; it never sees a part of the rows.

A target's schema is that of its last merge: a source without one of its columns leaves that
column's values alone, and a source with a new column adds it.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.functions import expressions as X
from stellate.operators import checks, merge
from stellate.session import scratch_path
from stellate.sinks.files import Files
from stellate.sinks.ledger import Ledger

#: Bytes that rows take in memory for each byte of their Parquet files, at most.
EXPANSION = 10


def month_of(day: str) -> Column:
    """Partition value ``yyyy-MM`` of a DATE column."""
    return F.date_format(F.col(day), "yyyy-MM")


def write_staged(df: DataFrame, name: str, partition_by: Sequence[str] = (), compression: str | None = None) -> str:
    """Write ``df`` once to a fresh path in the shared checkpoint folder; return the path.

    A written table survives the loss of an executor, unlike cached blocks, and cuts the
    lineage for every later reader.
    """
    path = scratch_path(df.sparkSession, name)
    _written(df, path, partition_by, compression=compression)
    return path


def _written(df: DataFrame, path: str, partition_by: Sequence[str], mode: str = "errorifexists", compression: str | None = None) -> None:
    w = df.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
        if mode == "overwrite":
            w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def write_csv_file(df: DataFrame, spark: SparkSession, name: str, pad_header: bool = False) -> str:
    """Write ``df`` as CSV with a header to a fresh staged folder (test and bench input)."""
    out = df.toDF(*[f" {c} " for c in df.columns]) if pad_header else df
    path = scratch_path(spark, name)
    out.write.option("header", True).csv(path)
    return path


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The target's own schema, or ``None`` before its first load."""
    last = Ledger(spark, path).last()
    if last is not None:
        return T.StructType.fromJson(json.loads(last["schema"]))
    try:  # a table that something else wrote
        return spark.read.parquet(path).schema if Files(spark, path).exists(path) else None
    except AnalysisException as e:
        if "UNABLE_TO_INFER_SCHEMA" in (e.getCondition() or ""):
            return None
        raise


def read_target(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of the target at ``path`` with its own schema, ``None`` before its first
    load. Changes nothing, also while a merge is being put in place."""
    placing = Ledger(spark, path).in_place()
    if placing is None:
        schema = stored_schema(spark, path)
        return None if schema is None else _rows_at(spark, path, schema)
    _, entry = placing
    if entry["rows"] is None and entry["first"]:
        return None  # its first rows are on their way
    schema = T.StructType.fromJson(json.loads(entry["schema"]))
    rows = spark.createDataFrame([], schema) if entry["rows"] is None else _rows_at(spark, entry["rows"], schema)
    if not entry["partition_by"]:
        return rows
    kept = ~F.col(entry["partition_by"]).isin(entry["partitions"])
    return _rows_at(spark, path, schema).filter(kept).unionByName(rows)


def _rows_at(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if not Files(spark, path).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def create_target(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """An empty target that knows its schema; an existing one stays as it is."""
    if stored_schema(spark, path) is None:
        ledger = Ledger(spark, path)
        Files(spark, path).mkdirs(path)
        entry = _entry(None, schema, [], None)
        number = ledger.number() + 1
        ledger.publish(number, entry)
        ledger.close(number, entry)


def evolved(target: T.StructType | None, source: T.StructType, last: Sequence[str] = ()) -> T.StructType:
    """The target's columns, then the source's new ones; partition columns last."""
    fields = {f.name: f for f in (*(target or T.StructType()), *(f for f in source if target is None or f.name not in target.names))}
    return T.StructType([f for n, f in fields.items() if n not in last] + [fields[n] for n in last])


def _entry(batch: str | None, schema: T.StructType, partitions: list, partition_by: str | None, rows: str | None = None, first: bool = False, counts: dict | None = None, total: int = 0) -> dict:
    """What the ledger holds of a merge. ``rows`` are its staged rows; without, it writes
    partitions that did not exist straight into the target (``first``: all that there is)."""
    return {
        "batch": batch,
        "schema": schema.json(),
        "partition_by": partition_by,
        "partitions": partitions,
        "rows": rows,
        "first": first,
        "counts": counts or {},
        "total": total,
    }


def settle(spark: SparkSession, path: str) -> None:
    """Finish or take back what a lost writer left. Called by every merge before it reads
    the target, never by a reader; one writer at a time works on a target."""
    ledger = Ledger(spark, path)
    placing = ledger.in_place()
    if placing is not None:
        number, entry = placing
        if entry["rows"] is not None:
            put_in_place(spark, path, entry)
            ledger.close(number, entry)
        else:
            _take_back(spark, path, entry)
            ledger.files.delete(f"{ledger.folder}/{number:08d}.open")
    ledger.clean()


def put_in_place(spark: SparkSession, path: str, entry: dict) -> None:
    """Overwrite the merge's partitions, or the target without any, by its staged rows. Can
    be repeated. Nothing is deleted unless all staged rows are there."""
    schema = T.StructType.fromJson(json.loads(entry["schema"]))
    if not Files(spark, path).exists(f"{entry['rows']}/_SUCCESS"):
        raise FileNotFoundError(f"{path}: the staged rows {entry['rows']} of a published merge are missing or incomplete")
    parts = [entry["partition_by"]] if entry["partition_by"] else []
    _written(spark.read.schema(schema).parquet(entry["rows"]), path, parts, "overwrite")


def _take_back(spark: SparkSession, path: str, entry: dict) -> None:
    """Remove the rows of an unfinished write into partitions that did not exist before it."""
    files = Files(spark, path)
    written = files.names(path)
    if entry["partition_by"]:
        written = sorted({_folder(spark, entry["partition_by"], v) for v in entry["partitions"]}.intersection(written))
    for name in written:
        files.delete(f"{path}/{name}")


def _folder(spark: SparkSession, partition_col: str, value: str | None) -> str:
    """The folder of a partition, named by Spark's own rule."""
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(partition_col, value)


def _clustered(df: DataFrame, partition_col: str | None, keys: Sequence[str]) -> DataFrame:
    """Group rows by partition value before a partitioned write (``REBALANCE`` hint).

    Without it every task holds rows of every month and writes one small file into each
    (tasks × months files). ``REBALANCE(month)`` hash-partitions by month and lets AQE
    split a partition that is too big — a month holding a third of all rows goes to
    several tasks — and merge ones that are too small, with no sampling pass.
    """
    if not partition_col:
        return df
    return df.hint("rebalance", partition_col)


def row_count(spark: SparkSession, path: str) -> int:
    """Rows of the target: the running total in its ledger, or a count where none is kept."""
    last = Ledger(spark, path).last()
    if last is not None:
        return int(last["total"])
    target = read_target(spark, path)
    return 0 if target is None else target.count()


def footer_counts(spark: SparkSession, path: str, by: Sequence[str] = ()) -> DataFrame:
    """Row count of a Parquet table, by partition columns ``by``, from the footers of its
    files alone: Spark's newer file source answers the aggregate from the row groups' own
    counts, and no column is read. The session that reads so is one of its own."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    rows = session.read.parquet(path)
    return (rows.groupBy(*by) if by else rows.groupBy()).agg(F.count(F.lit(1)).alias("n_rows"))


def distinct_partitions(df: DataFrame, partition_col: str | Column) -> list:
    """The partition values present in ``df``: as many as folders the merge will touch,
    which a table's file listing holds on the driver anyway."""
    c = F.col(partition_col) if isinstance(partition_col, str) else partition_col
    return [r[0] for r in df.select(c.alias("__p")).distinct().collect()]


def merge_into_path(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_col: str | None = None,
    partition_value: Column | None = None,
    strategy: str = "auto",
    partition_values: Sequence | None = None,
    unique_source: bool = True,
    batch: str | None = None,
    source_bytes: int | None = None,
    published: Callable[[], None] | None = None,
    by: str | None = None,
    by_rows: dict[int, int] | None = None,
    arranged: bool = False,
) -> dict:
    """Merge ``source`` into the Parquet target at ``path``; return the load counts.

    ``partition_col`` (computed from the key by ``partition_value``, e.g. the month of the
    day) partitions the target on disk, as text. Only partitions that occur in the source are
    read, merged and replaced. ``partition_values`` (from ``distinct_partitions``) spares the
    scan for them when several merges share a source.

    ``batch`` names the merge: one that the ledger holds as complete is not done again, and
    its counts are returned with ``replayed``. ``published`` is called when the merge is
    decided and before its rows are put in place.

    ``strategy='auto'`` broadcasts the source when its bytes are below the session's broadcast
    threshold: ``source_bytes``, the listed size of the files it is read from, times
    ``EXPANSION``, or else its measured bytes. The broadcast merge reads the target in place
    and keeps its file layout. Counts are observed in the writing stage, whose tasks count
    once even when stages before it are run again. ``unique_source=False`` checks the source
    for repeated keys first, which would both be inserted where a primary key would refuse
    them.

    ``by`` names a source column that is not stored; the counts then also have ``by``, a list
    of its values, each with the rows inserted and matched; ``by_rows`` are the source's rows of
    each, counted before, all of them with keys. ``arranged`` says that the source's
    files are laid out by partition: rows without a target are then written as they are read.
    """
    keys = list(keys)
    ledger = Ledger(spark, path)
    settle(spark, path)
    if batch is not None and (done := ledger.committed(batch)) is not None:
        return done["counts"] | {"total": row_count(spark, path), "commit_sec": 0.0, "replayed": True}
    number = ledger.number() + 1

    src = source.withColumn(partition_col, partition_value.cast("string")) if partition_col and partition_value is not None else source
    parts = [partition_col] if partition_col else []
    if not unique_source:
        checks.assert_empty(checks.duplicate_keys(merge.valid_source(src, keys), keys), f"source keys {keys} repeat")
    target_schema = stored_schema(spark, path)
    schema = evolved(target_schema, src.drop(by).schema if by else src.schema, parts)
    values = list(partition_values if partition_values is not None else distinct_partitions(merge.valid_source(src, keys), partition_col)) if parts else []
    before = row_count(spark, path) if target_schema is not None else 0
    obs = Observation("merge")
    counts = [
        F.count(F.when(F.col(merge.IN_SOURCE) & ~F.col(merge.IN_TARGET), 1)).alias("inserted"),
        F.count(F.when(F.col(merge.IN_SOURCE) & F.col(merge.IN_TARGET), 1)).alias("matched_before"),
        F.count(F.when(F.col(merge.IN_TARGET) & ~F.col(merge.IN_SOURCE), 1)).alias("target_only"),
        F.count(F.lit(1)).alias("rows_written"),
    ]

    def entry(rows: str | None, seen: dict | None = None, each: list | None = None) -> dict:
        seen = {k: int(v) for k, v in (seen or {}).items()}
        if seen:
            seen["updated"] = seen["inserted"] + seen["matched_before"]
        if each is not None:
            seen["by"] = each
        return _entry(batch, schema, values, partition_col, rows, target_schema is None, seen, before + seen.get("inserted", 0))

    def inserted(rows: DataFrame) -> DataFrame:
        """Source rows for partitions that the target does not have: nothing to join them with."""
        new = merge.valid_source(rows, keys).select(
            *[X.col(c) if c in rows.columns else F.lit(None).cast(schema[c].dataType).alias(c) for c in schema.names],
            *([X.col(by)] if by else []),
            F.lit(False).alias(merge.IN_TARGET),
            F.lit(True).alias(merge.IN_SOURCE),
        )
        return new if arranged else _clustered(new, partition_col, keys)

    old = _present(spark, path, partition_col, values)
    if old is not None and not old:  # nothing to replace
        observed = inserted(src).observe(obs, *counts).select(*[X.col(c) for c in schema.names])
        ledger.publish(number, entry(None))
        if published:
            published()
        try:
            _written(observed, path, parts, "append")
        except Exception:
            settle(spark, path)  # the target as it was
            raise
        each = None
        if by:  # all are new
            each = [[v, n, 0] for v, n in sorted(by_rows.items())] if by_rows is not None else _by(merge.valid_source(src, keys).withColumn(merge.IN_TARGET, F.lit(False)), by)
        final = entry(None, _observed(obs, src), each)
        began = time.perf_counter()
    else:
        target = _rows_at(spark, path, schema)  # a new column reads as missing
        joined, absent = src, [v for v in values if v is not None and v not in old] if parts else []
        if parts:
            target = target.filter(F.col(partition_col).isin(values))
        if absent:
            joined = src.filter(~F.coalesce(F.col(partition_col).isin(absent), F.lit(False)))
        if strategy in ("auto", "broadcast"):
            limit = merge.broadcast_limit(spark)
            fits = source_bytes * EXPANSION <= limit if source_bytes is not None else merge.source_fits_broadcast(joined, limit)
            strategy = "broadcast" if fits else "shuffle"
        if by:  # the source's value goes along; rows of the target alone have none
            target = target.withColumn(by, F.lit(None).cast(src.schema[by].dataType))
        merged = merge.upsert(target, joined, keys + parts, strategy=strategy, with_flags=True, measured=True)
        if strategy == "shuffle":
            merged = _clustered(merged, partition_col, keys)
        if absent:  # staged and put in place with the others, but not joined
            merged = merged.unionByName(inserted(src.filter(F.col(partition_col).isin(absent))))
        rows = f"{ledger.folder}/rows-{uuid.uuid4().hex[:12]}"
        try:
            extra = T.StructType([src.schema[by], T.StructField(merge.IN_TARGET, T.BooleanType())]) if by else T.StructType()
            _written(merged.observe(obs, *counts).select(*[X.col(c) for c in (*schema.names, *extra.names)]), rows, parts)
            each = _by(spark.read.schema(extra).parquet(rows), by) if by else None  # not read when put in place
            final = entry(rows, _observed(obs, src), each)
            began = time.perf_counter()
            ledger.publish(number, final)
        except Exception:
            ledger.files.delete(rows)
            raise
        if published:
            published()
        put_in_place(spark, path, final)
    ledger.close(number, final)
    if final["rows"]:
        ledger.files.delete(final["rows"])
    spark.catalog.refreshByPath(path)
    return final["counts"] | {"total": final["total"], "commit_sec": time.perf_counter() - began, "replayed": False}


def _by(rows: DataFrame, by: str) -> list[list[int]]:
    """By value of ``by``: rows inserted, and rows that matched."""
    old = F.col(merge.IN_TARGET)
    found = rows.filter(X.col(by).isNotNull()).groupBy(X.col(by)).agg(F.count(F.when(~old, 1)), F.count(F.when(old, 1)))
    return sorted([list(r) for r in found.collect()])


def _present(spark: SparkSession, path: str, partition_col: str | None, values: list) -> list | None:
    """The partitions among ``values`` that the target has files of, none if it has no files at
    all; ``None`` for a target without partitions that has files."""
    names = set(Files(spark, path).names(path))
    if not partition_col:
        return None if names else []
    return [v for v in values if _folder(spark, partition_col, v) in names]


def _observed(obs: Observation, src: DataFrame) -> dict:
    """The observed counts. When the optimizer proves the input empty it removes the whole
    plan, observation included, and no metrics arrive; the counts are then all zero."""
    try:
        return dict(obs.get)
    except Exception:  # noqa: BLE001 - py4j surfaces the missing metrics row as a generic error
        if src.isEmpty():
            return {"inserted": 0, "matched_before": 0, "target_only": 0, "rows_written": 0}
        raise


def observed_rows(obs: Observation, df: DataFrame) -> int:
    """The observed ``rows``, 0 when the optimizer proved the input empty."""
    try:
        return int(obs.get["rows"])
    except Exception:  # noqa: BLE001 - as above
        if df.isEmpty():
            return 0
        raise


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, mode: str = "overwrite") -> None:
    """Save ``df`` as a table bucketed and sorted on ``keys``.

    A merge against a bucketed target with the same key exchanges only the source side:
    the target's bucketing already satisfies the join's distribution.
    """
    df.write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys).format("parquet").saveAsTable(table)

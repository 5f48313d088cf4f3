"""Text-typed CSV staging.

The wide file is read as text: every column a ``StringType``, no inference pass, so a bad
number cannot fail the load itself and the cast happens later, per target, where the
rules for missing values are applied once. Header names are trimmed (values are not) and
checked before any work: a missing required column or a duplicate name is an error.

The CSV source splits a file by block, so one large file is read by many tasks; only
``multiline=True`` (quoted newlines inside cells) makes a file unsplittable.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.functions import expressions as X
from stellate.sinks.files import Files


class SourceError(ValueError):
    pass


def source_files(spark: SparkSession, path: str) -> list[str]:
    """The data files at ``path``: a file, a folder, or a pattern. A listing, no data."""
    files = Files(spark, path)
    found = files.glob(path)
    if not found:
        raise SourceError(f"source file not found or unreadable: {path}")
    return found


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row, if this is the beginning of a file; the rest is never asked for."""
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1 if batch.column(2)[0].as_py() == 0 else 0)
            return


#: Files up to this size are read whole, many by a task: opening one costs no less.
SMALL_FILE = 1024 * 1024
#: Entries of folders whose files one scan lists: the driver holds a listing of its files.
LISTED = 20_000


def first_lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """``file`` and ``line``, the first line of every file that is not empty, read by tasks.

    Small files are read whole, some hundred by a task, so tasks grow with the files' bytes and
    not with their number. Of a large file, a task reads one piece and stops after its first
    rows. The sessions that plan it so are its own.

    A folder of more than ``LISTED`` entries in its folders is read some folders at a time,
    the lines staged, so that the driver never holds a listing of all files. That needs
    folders in it which are not that large themselves.
    """
    from stellate.session import scratch_path

    sessions = (_listing_session(spark, False), _listing_session(spark, True))
    groups = _folder_groups(spark, path)
    if len(groups) < 2:
        return _lines(*sessions, path, encoding)
    at = scratch_path(spark, "first-lines")
    for group in groups:  # a group's frame, with its listing, is let go before the next
        _lines(*sessions, group, encoding).write.mode("append").parquet(at)
    return spark.read.schema("file string, line string").parquet(at)


def _folder_groups(spark: SparkSession, path: str) -> list[list[str]]:
    """What is right below a folder, in groups of about ``LISTED`` entries: a file is one, a
    folder has as many as its own listing. One group for anything but a large folder."""
    files = Files(spark, path)
    inside = files.readable(path)
    groups: list[list[str]] = [[]]
    room = LISTED
    for name, is_folder in inside:
        n = max(1, len(files.readable(name))) if is_folder and len(inside) <= LISTED else 1
        if n > room and groups[-1]:
            groups.append([])
            room = LISTED
        groups[-1].append(name)
        room -= n
    return groups


def _listing_session(spark: SparkSession, small: bool) -> SparkSession:
    session = spark.newSession()
    most = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(session.conf.get("spark.sql.files.maxPartitionBytes")))
    session.conf.set("spark.sql.files.openCostInBytes", str(min(SMALL_FILE // 4, most) if small else most))
    session.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", "200")  # tasks that list folders
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    session.conf.set("spark.sql.hive.filesourcePartitionFileCacheSize", "0")  # a listing is used once
    return session


def _lines(large_files: SparkSession, small_files: SparkSession, path: str | list[str], encoding: str) -> DataFrame:
    def scan(session: SparkSession, small: bool) -> DataFrame:
        rows = session.read.option("encoding", encoding).option("recursiveFileLookup", True).text(path, wholetext=small)
        size = F.col("_metadata.file_size")  # leaves files out before they are opened
        return rows.where((size > 0) & (size <= SMALL_FILE) if small else size > SMALL_FILE)

    large, small = scan(large_files, False), scan(small_files, True)
    file = F.col("_metadata.file_path").alias("file")
    place = large.select(file, F.col("value").alias("line"), F.col("_metadata.file_block_start").alias("start"))
    line = F.regexp_extract("value", "^\ufeff?([^\r\n]*)", 1).alias("line")
    return place.mapInArrow(_first_lines, place.schema).drop("start").unionByName(small.select(file, line))


def raw_headers(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> dict[str, tuple[str, ...]]:
    """Every file's first line as fields, names untouched, in order of the files' names.
    Empty files have no header and are left out. The driver receives one line for each file,
    next to the listing that it holds of them."""
    source_files(spark, path)  # a missing source is an error of its own
    rows = sorted((unquote(r["file"]), r["line"]) for r in first_lines(spark, path, encoding).collect())
    headers = {f: tuple(next(csv.reader([line.removeprefix("\ufeff")], delimiter=sep), ())) for f, line in rows}
    return {f: h for f, h in headers.items() if h}


def read_header(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> list[str]:
    """Header names of the CSV at ``path`` (of its first file), trimmed, duplicates and all."""
    headers = raw_headers(spark, path, sep, encoding)
    return [c.strip() for c in next(iter(headers.values()), ())]


def check_header(header: Sequence[str], required: Sequence[str] = ()) -> None:
    """Fail before any work on a missing required column or a duplicate name."""
    seen, dups = set(), []
    for c in header:
        if c in seen:
            dups.append(c)
        seen.add(c)
    if dups:
        raise SourceError(f"duplicate column names in header: {sorted(set(dups))}")
    missing = [c for c in required if c not in seen]
    if missing:
        raise SourceError(f"required columns missing from header: {missing}")


def text_schema(header: Sequence[str]) -> T.StructType:
    """One nullable ``StringType`` column per header field."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in header])


def read_text_csv(
    spark: SparkSession,
    path: str,
    required: Sequence[str] = (),
    multiline: bool = False,
    mode: str = "FAILFAST",
    sep: str = ",",
    encoding: str = "UTF-8",
    keep_quoted_empty: bool = False,
) -> DataFrame:
    """All-text staging frame of the CSV file(s) at ``path``.

    Every file's header is checked. Files whose columns stand in another order are read by
    their own order; a file with other columns is an error.

    ``mode='FAILFAST'`` rejects ragged rows (short or long), as a database COPY does.
    An unquoted empty cell reads as NULL; a quoted empty one as NULL too, unless
    ``keep_quoted_empty`` keeps it as ``''``. Both mean "missing" to every operator
    downstream (``NULLIF(x, '')``).
    """
    headers = raw_headers(spark, path, sep, encoding)
    if not headers:
        raise SourceError(f"no header in {path}")
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, raw in headers.items():
        groups.setdefault(tuple(c.strip() for c in raw), []).append(file)
    first = next(iter(groups))
    for names, files in groups.items():
        check_header(names, required)
        if set(names) != set(first):
            raise SourceError(f"{files[0]}: columns {sorted(set(names) ^ set(first))} are not in all files of {path}")

    def read(names: tuple[str, ...], files: list[str]) -> DataFrame:
        reader = (
            spark.read.schema(text_schema(names))
            .option("header", True)
            .option("enforceSchema", True)  # by position: each of these files has this very header
            .option("mode", mode)
            .option("sep", sep)
            .option("encoding", encoding)
            .option("multiLine", multiline)
        )
        if keep_quoted_empty:
            # With a sentinel null marker, an unquoted empty cell still reads as NULL while a
            # quoted one keeps its '' (the default folds both into NULL).
            reader = reader.option("nullValue", "\u0001")
        flat = len(groups) == 1 and not any(Files(spark, path).folders(path))
        return reader.csv(path if flat else files).select(*[X.col(c) for c in first])

    frames = [read(names, files) for names, files in groups.items()]
    return reduce(DataFrame.union, frames)


RAW, FILE = "__raw", "__file"


def stage_with_rejects(spark: SparkSession, path: str, required: Sequence[str] = (), sep: str = ",", encoding: str = "UTF-8") -> tuple[DataFrame, DataFrame, str]:
    """Stage the CSV file(s) at ``path`` in one scan, ragged rows set aside.

    Returns the all-text rows that have as many cells as the header; the rejects, each with
    its ``file`` and ``raw`` text; and the staged folder that both read, which the caller
    deletes. All files must have one header. ``required`` is checked as in ``read_text_csv``.
    """
    from stellate.sinks.tables import write_staged

    headers = {tuple(c.strip() for c in h) for h in raw_headers(spark, path, sep, encoding).values()}
    if len(headers) != 1:
        raise SourceError(f"{path}: {len(headers)} different headers, one is needed")
    names = list(headers.pop())
    check_header(names, required)
    reader = spark.read.schema(text_schema([*names, RAW])).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW)
    reader = reader.option("header", True).option("enforceSchema", True).option("sep", sep).option("encoding", encoding).option("recursiveFileLookup", True)
    rows = reader.csv(path).withColumn(FILE, F.col("_metadata.file_path"))
    at = write_staged(rows, "csv-rows")
    staged = spark.read.schema(rows.schema).parquet(at)
    good = staged.filter(F.col(RAW).isNull()).drop(RAW, FILE)
    return good, staged.filter(F.col(RAW).isNotNull()).select(F.col(FILE).alias("file"), F.col(RAW).alias("raw")), at


def line_count(spark: SparkSession, path: str, header_lines: int = 1) -> int:
    """Physical data lines (newlines minus the header), as a load denominator.

    A quoted newline inside a cell makes this larger than the parsed row count; compare
    both in ``load_audit`` rather than trusting either alone.
    """
    files = spark.read.format("binaryFile").load(path).select("path").count()
    return spark.read.text(path).count() - header_lines * files


def source_bytes(spark: SparkSession, path: str) -> int:
    """Total bytes of the source files; only the ``length`` column is read."""
    row = spark.read.format("binaryFile").load(path).agg(F.sum("length").alias("n")).first()
    return int(row["n"] or 0)


def load_audit(spark: SparkSession, path: str, staged: DataFrame | None = None) -> dict:
    """Lines in the file, bytes and (given ``staged``) rows parsed: the COPY statistics.

    Counting ``staged`` parses the whole file once more; a load that already observes its
    staged row count passes ``staged=None`` and fills in ``rows`` itself.
    """
    out = {"lines": line_count(spark, path), "bytes": source_bytes(spark, path)}
    if staged is not None:
        out["rows"] = staged.count()
        out["lines_match_rows"] = out["lines"] == out["rows"]
    return out

"""NULL-preserving merge of a keyed source into a keyed target.

Per value column ``new = COALESCE(source, target)``: a missing source value never erases a
known one, rows only in the target stay as they are, and source keys absent from the
target are inserted. The end state equals the database's INSERT-if-absent followed by the
UPDATE … COALESCE, computed in one plan.

Two physical strategies give the same rows:

* ``shuffle``   one full outer join on the key. Both sides are exchanged on the key — or
                only the source, when the target is bucketed on the key (see
                ``stellate.sinks.tables.write_bucketed``). For an initial or very large load.
* ``broadcast`` for a source that is small next to the target (a daily file against years
                of history). The target is read in place and never shuffled:
                ``target LEFT JOIN broadcast(source)`` updates, ``source LEFT ANTI
                broadcast(matched keys)`` inserts. Chosen only after the source's size is
                checked against ``broadcast_limit_bytes``; anything larger takes ``shuffle``.

Source rows with a NULL key are never merged (the database would reject them); they are
counted by ``merge_counts``. Both sides must be unique on the key; ``stellate.operators
.checks.duplicate_keys`` tests that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.functions import expressions as X

IN_TARGET = "__in_target"
IN_SOURCE = "__in_source"

DEFAULT_BROADCAST_LIMIT = 10 * 1024 * 1024


def _value_columns(target: DataFrame, keys: Sequence[str], columns: Sequence[str] | None) -> list[str]:
    if columns is not None:
        return list(columns)
    return [c for c in target.columns if c not in keys]


def _key_not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & X.col(k).isNotNull()
    return cond


def valid_source(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows that can be merged: every key column holds a value."""
    return source.filter(_key_not_null(keys))


def absent_rows(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key is not in the target (``LEFT JOIN … WHERE t.key IS NULL``)."""
    keys = list(keys)
    return valid_source(source, keys).join(target.select(*keys), keys, "left_anti")


def insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target after inserting the absent source rows; existing rows are untouched."""
    new = absent_rows(source, target, keys).select(*target.columns)
    return target.unionByName(new)


def update_existing(
    target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Target after ``UPDATE t SET c = COALESCE(s.c, t.c) FROM s WHERE t.key = s.key``.

    No row is added or removed; unmatched target rows keep every value.
    """
    keys = list(keys)
    cols = _value_columns(target, keys, columns)
    s = valid_source(source, keys).select(*keys, *[X.col(c).alias(f"__s_{c}") for c in cols])
    j = target.join(s, keys, "left")
    return j.select(
        *[F.coalesce(F.col(f"__s_{c}"), X.col(c)).alias(c) if c in cols else X.col(c) for c in target.columns]
    )


def touched_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target's rows that the source updates, as they are after it: an inner join. Spark
    may hand the source's keys to the target's scan as a Bloom filter, which drops most of a
    large target before its exchange; a full outer join never can."""
    keys = list(keys)
    cols = [c for c in _value_columns(target, keys, None) if c in source.columns]
    s = valid_source(source, keys).select(*keys, *[X.col(c).alias(f"__s_{c}") for c in cols])
    j = target.join(s, keys, "inner")
    return j.select(*[F.coalesce(F.col(f"__s_{c}"), X.col(c)).alias(c) if c in cols else X.col(c) for c in target.columns])


def upsert_by_parts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The merge as three sets: untouched rows (anti join), touched rows (``touched_rows``) and
    absent ones. For a source that is small next to the target but too large to broadcast."""
    keys = list(keys)
    untouched = target.join(valid_source(source, keys).select(*keys), keys, "left_anti")
    missing = [F.lit(None).cast(target.schema[c].dataType).alias(c) for c in target.columns if c not in source.columns]
    new = absent_rows(source, target, keys).select("*", *missing).select(*target.columns)
    return untouched.unionByName(touched_rows(target, source, keys)).unionByName(new)


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the rows of ``df``: text and binary as they are, eight for any other field."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    size = F.lit(16 + 8 * len(df.columns))
    for c in text:
        size = size + F.coalesce(F.octet_length(X.col(c)), F.lit(0))
    for c in nested:
        size = size + F.coalesce(F.octet_length(F.to_json(X.col(c))), F.lit(0))
    return int(df.agg(F.sum(size.cast("long"))).first()[0] or 0)


def broadcast_limit(spark) -> int:
    """The session's broadcast threshold in bytes (``spark.sql.autoBroadcastJoinThreshold``),
    or ``DEFAULT_BROADCAST_LIMIT``; ``-1`` (broadcast disabled) gives 0."""
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    if raw is None:
        return DEFAULT_BROADCAST_LIMIT
    raw = str(raw).strip().lower()
    mult = {"b": 1, "k": 1024, "kb": 1024, "m": 1024**2, "mb": 1024**2, "g": 1024**3, "gb": 1024**3}
    for suffix in sorted(mult, key=len, reverse=True):
        if raw.endswith(suffix):
            return max(0, int(float(raw[: -len(suffix)]) * mult[suffix]))
    return max(0, int(raw))


def source_fits_broadcast(source: DataFrame, limit_bytes: int = DEFAULT_BROADCAST_LIMIT) -> bool:
    """Whether the source's measured bytes are within the limit. One pass over the source's
    text columns (small or already materialised), never over the target."""
    return limit_bytes > 0 and measured_bytes(source) <= limit_bytes


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    strategy: str = "shuffle",
    with_flags: bool = False,
    broadcast_limit_bytes: int | None = None,
    measured: bool = False,
) -> DataFrame:
    """Insert absent keys, COALESCE-update present ones, keep the rest.

    ``strategy`` is ``shuffle``, or ``broadcast`` / ``auto``: broadcast when the source's
    measured bytes are within ``broadcast_limit_bytes`` (by default the session's
    ``spark.sql.autoBroadcastJoinThreshold``), else shuffle. ``measured`` says that the
    caller has just done that check. ``with_flags`` adds ``__in_target`` / ``__in_source``
    booleans from which ``merge_counts`` derives the load counts without another pass.
    """
    keys = list(keys)
    cols = _value_columns(target, keys, columns)
    out_cols = keys + [c for c in target.columns if c not in keys]
    # A target column the source lacks is all-missing in the source: it never overwrites.
    src = valid_source(source, keys).select(
        *keys,
        *[
            (X.col(c) if c in source.columns else F.lit(None).cast(target.schema[c].dataType)).alias(f"__s_{c}")
            for c in cols
        ],
    )

    if strategy in ("auto", "broadcast") and not measured:
        limit = broadcast_limit(source.sparkSession) if broadcast_limit_bytes is None else broadcast_limit_bytes
        strategy = "broadcast" if source_fits_broadcast(src, limit) else "shuffle"

    def value(c: str) -> Column:
        return F.coalesce(F.col(f"__s_{c}"), X.col(c)).alias(c) if c in cols else X.col(c)

    if strategy == "shuffle":
        t = target.withColumn(IN_TARGET, F.lit(True))
        s = src.withColumn(IN_SOURCE, F.lit(True))
        j = t.join(s, keys, "full_outer")
        flags = [
            F.coalesce(F.col(IN_TARGET), F.lit(False)).alias(IN_TARGET),
            F.coalesce(F.col(IN_SOURCE), F.lit(False)).alias(IN_SOURCE),
        ]
        return j.select(*[value(c) for c in out_cols], *(flags if with_flags else []))

    if strategy == "broadcast":
        s = F.broadcast(src.withColumn(IN_SOURCE, F.lit(True)))
        updated = target.join(s, keys, "left").select(
            *[value(c) for c in out_cols],
            *(
                [F.lit(True).alias(IN_TARGET), F.coalesce(F.col(IN_SOURCE), F.lit(False)).alias(IN_SOURCE)]
                if with_flags
                else []
            ),
        )
        matched = target.select(*keys).join(F.broadcast(src.select(*keys)), keys, "left_semi")
        inserted = src.join(F.broadcast(matched), keys, "left_anti").select(
            *keys,
            *[
                (F.col(f"__s_{c}") if c in cols else F.lit(None).cast(target.schema[c].dataType)).alias(c)
                for c in out_cols
                if c not in keys
            ],
            *([F.lit(False).alias(IN_TARGET), F.lit(True).alias(IN_SOURCE)] if with_flags else []),
        )
        return updated.unionByName(inserted)

    raise ValueError(f"unknown merge strategy {strategy!r}")


def merge_counts(
    merged_with_flags: DataFrame, source: DataFrame | None = None, keys: Sequence[str] | None = None
) -> DataFrame:
    """Load counts of one merge, from ``upsert(..., with_flags=True)``, in one aggregation.

    ``inserted`` source keys new to the target; ``matched_before`` source keys already
    there; ``updated`` = inserted + matched_before, the count the database reports for an
    UPDATE that runs after the INSERT; ``target_only`` untouched rows; ``total_after``.
    Given the ``source`` and its ``keys``, ``rejected_null_keys`` counts source rows that
    could not be merged because a key is NULL.
    """
    flags = merged_with_flags.select(IN_TARGET, IN_SOURCE, F.lit(False).alias("__rejected"))
    if source is not None:
        rejected = source.filter(~_key_not_null(keys or [])).select(
            F.lit(False).alias(IN_TARGET), F.lit(False).alias(IN_SOURCE), F.lit(True).alias("__rejected")
        )
        flags = flags.unionByName(rejected)
    it, iS, rej = F.col(IN_TARGET), F.col(IN_SOURCE), F.col("__rejected")
    out = flags.agg(
        F.count(F.when(iS & ~it, 1)).alias("inserted"),
        F.count(F.when(iS & it, 1)).alias("matched_before"),
        F.count(F.when(it & ~iS, 1)).alias("target_only"),
        F.count(F.when(~rej, 1)).alias("total_after"),
        F.count(F.when(rej, 1)).alias("rejected_null_keys"),
    )
    return out.withColumn("updated", F.col("inserted") + F.col("matched_before"))


BATCH = "__batch"


def merge_in_batches(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    batches: int,
    columns: Sequence[str] | None = None,
    strategy: str = "shuffle",
) -> tuple[DataFrame, DataFrame]:
    """Merge ``source`` in ``batches`` key-disjoint slices; return the merged rows and the
    log ``(batch, inserted, matched_before, target_only)``.

    Both sides are cut by the same hash of the key and written once, partitioned by slice;
    each slice then merges its own part of the target only, and its result is written
    before the next begins. So the target is read once and written once in all, whatever
    the number of slices, work and memory per step are bounded, and because the slices are
    key-disjoint the end state equals one merge of the whole source.
    """
    from stellate.session import scratch_path
    from stellate.sinks.staging import delete_path

    spark, keys = target.sparkSession, list(keys)
    cut = lambda df: df.withColumn(BATCH, F.pmod(F.xxhash64(*[X.col(k) for k in keys]), F.lit(batches)).cast("int"))
    sides = {}
    for name, df in (("target", target), ("source", valid_source(source, keys))):
        path = scratch_path(spark, f"slices-{name}")
        cut(df).hint("rebalance", BATCH).write.partitionBy(BATCH).parquet(path)
        sides[name] = (path, spark.read.schema(T.StructType([*df.schema, T.StructField(BATCH, T.IntegerType())])).parquet(path))
    merged = scratch_path(spark, "slices-merged")
    for i in range(batches):
        t, s = (sides[n][1].filter(F.col(BATCH) == i).drop(BATCH) for n in ("target", "source"))
        out = upsert(t, s, keys, columns, strategy=strategy, with_flags=True)
        out.withColumn(BATCH, F.lit(i)).write.mode("append").partitionBy(BATCH).parquet(merged)
    for path, _ in sides.values():
        delete_path(spark, path)
    flags = [T.StructField(IN_TARGET, T.BooleanType()), T.StructField(IN_SOURCE, T.BooleanType()), T.StructField(BATCH, T.IntegerType())]
    schema = T.StructType([*target.schema, *flags])
    done = spark.read.schema(schema).parquet(merged)
    it, iS = F.col(IN_TARGET), F.col(IN_SOURCE)
    log = done.groupBy((F.col(BATCH) + 1).alias("batch")).agg(
        F.count(F.when(iS & ~it, 1)).alias("inserted"),
        F.count(F.when(iS & it, 1)).alias("matched_before"),
        F.count(F.when(it & ~iS, 1)).alias("target_only"),
    )
    return done.select(*[X.col(c) for c in target.columns]), log

"""Registered queries: one per operator, each over whole tables of ``sf_dir``.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame; ``stellate.plans.oracle``
holds the equivalent DuckDB SQL under the same name with the same column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.functions import expressions as X
from stellate.operators import checks, dedup, mapping, merge, ordinal
from stellate.plans import views as V

# Rows per key-range batch in ``key_batches`` / ``batched_upsert`` (the loader's default).
BATCH_SIZE = 20_000
# Number of batches the batched upsert splits its source into.
UPSERT_BATCHES = 4
# Files, and so micro-batches, of the streamed upsert.
STREAM_FILES = 4
# Key ranges of the range-batched load, and buckets of the bucketed one.
RANGE_BATCHES = 5
BUCKETS = 8


def _materialised(df: DataFrame) -> DataFrame:
    """Compute ``df`` once for several consumers: a reliable checkpoint in the shared
    checkpoint folder (survives executor loss and cuts the lineage)."""
    from stellate.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-2: all-text staging view (``''`` for a missing cell)."""
    return V.w(spark, sf_dir)


def typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B-1, F-1..F-5: rename + NULLIF + strict casts of every W column."""
    return mapping.project(V.w(spark, sf_dir), V.W_TYPED)


def rint_bigint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-5: text → double → half-to-even BIGINT; ``p_size / 2`` has many .5 cases."""
    part = V.read(spark, sf_dir, "part")
    half = F.col("p_size") / F.lit(2.0)
    return part.select(
        "p_partkey",
        half.alias("half"),
        X.text_to_rounded_bigint(half.cast("string")).alias("half_rounded"),
    )


def completeness_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-6, F-7, B-4, B-8: present cells per row over all but keys, label and tie-break."""
    scored = dedup.with_score(V.w(spark, sf_dir), list(V.W_KEYS) + [V.W_LABEL, V.W_TIEBREAK])
    return scored.select(*V.W_KEYS, V.W_TIEBREAK, dedup.SCORE)


def dedup_most_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-1, D-3, B-5, D-7: most complete row per (entity, day)."""
    return V.w_dedup(V.w(spark, sf_dir))


def dedup_any_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-4: one arbitrary row per key. Which one is free, so the rows are looked up in the
    table: each key comes back once, with whether its kept row exists there as a whole."""
    keys = ["l_orderkey", "l_linenumber"]
    lines = V.read(spark, sf_dir, "lineitem")
    kept = dedup.any_per_key(lines, keys)
    found = lines.distinct().withColumn("row_exists", F.lit(True))
    return kept.join(found, lines.columns, "left").select(*keys, F.coalesce("row_exists", F.lit(False)).alias("row_exists"))


def latest_per_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-1, D-5, S9, S10: latest deduplicated row per entity, day compared as a DATE."""
    return V.latest_rows(V.w_dedup(V.w(spark, sf_dir)))


def split_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B-2: the dimension from the latest row per entity."""
    return V.dimension(V.w_dedup(V.w(spark, sf_dir)))


def _split_fact(n: int) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return mapping.project(V.w_dedup(V.w(spark, sf_dir)), V.W_FACTS[n])

    q.__doc__ = f"B-2: fact {V.W_FACTS[n].name} from the deduplicated rows."
    return q


def insert_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-2, E-1: orders target after inserting the source's new keys."""
    return merge.insert_absent(V.orders_target(spark, sf_dir), V.orders_source(spark, sf_dir), ["o_orderkey"])


def _w_fact_halves(spark: SparkSession, sf_dir: str, n: int) -> tuple[DataFrame, DataFrame]:
    wide = V.w(spark, sf_dir)
    fact = V.W_FACTS[n]
    return mapping.project(V.w_target_half(wide), fact), mapping.project(V.w_source_half(wide), fact)


def insert_absent_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-3: composite key (user, day), the source side typed before the anti-join."""
    t, s = _w_fact_halves(spark, sf_dir, 2)
    return merge.insert_absent(t, s, V.W_FACTS[2].key_names)


def update_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-5, E-2: orders target after the NULL-preserving update (no rows added)."""
    return merge.update_existing(V.orders_target(spark, sf_dir), V.orders_source(spark, sf_dir), ["o_orderkey"])


def update_coalesce_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-6: the same on the composite key."""
    t, s = _w_fact_halves(spark, sf_dir, 2)
    return merge.update_existing(t, s, V.W_FACTS[2].key_names)


def upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-7, E-3: insert absent + COALESCE update, one full outer join."""
    return merge.upsert(V.orders_target(spark, sf_dir), V.orders_source(spark, sf_dir), ["o_orderkey"])


def upsert_orders_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-7 with ``strategy='auto'``: the source is counted and broadcast (the target then
    never shuffled) when it fits the session's broadcast threshold, else one shuffle join."""
    return merge.upsert(
        V.orders_target(spark, sf_dir), V.orders_source(spark, sf_dir), ["o_orderkey"], strategy="auto"
    )


def _upsert_fact(n: int) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        t, s = _w_fact_halves(spark, sf_dir, n)
        return merge.upsert(t, s, V.W_FACTS[n].key_names)

    q.__doc__ = f"E-4: upsert of fact {V.W_FACTS[n].name}, history vs new extract."
    return q


def upsert_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-3: dimension upsert; each half contributes its latest row per entity."""
    wide = V.w(spark, sf_dir)
    t = V.dimension(V.w_target_half(wide))
    s = V.dimension(V.w_source_half(wide))
    return merge.upsert(t, s, V.W_DIMENSION.key_names)


def runtime_filtered_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-2, C-5: the merge as untouched, touched and absent rows; a Bloom filter of the
    source's keys reaches the target's scan. Spark does so by itself from 10 GB of target; the
    session of this query asks for it at any size."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    session.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "true")
    session.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "0")
    return merge.upsert_by_parts(V.orders_target(session, sf_dir), V.orders_source(session, sf_dir), ["o_orderkey"])


def merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-6: inserted / matched / updated / untouched / total of the orders upsert."""
    s = V.orders_source(spark, sf_dir)
    flagged = merge.upsert(V.orders_target(spark, sf_dir), s, ["o_orderkey"], with_flags=True)
    return merge.merge_counts(flagged, s, ["o_orderkey"])


def upsert_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-11, S15: the same source merged twice gives the single-merge table."""
    t, s = V.orders_target(spark, sf_dir), V.orders_source(spark, sf_dir)
    once = merge.upsert(t, s, ["o_orderkey"])
    return merge.upsert(once, s, ["o_orderkey"])


def key_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-2: ``ROW_NUMBER() OVER (ORDER BY o_orderkey)`` without a single-partition window."""
    keys = V.read(spark, sf_dir, "orders").select("o_orderkey")
    return ordinal.global_ordinal(keys, ["o_orderkey"])


def key_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B-6, C-4, E-5: every key with its inclusive key-range batch of ``BATCH_SIZE``."""
    keys = ordinal.global_ordinal(V.read(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])
    return keys.select(
        "o_orderkey", "rn", (F.floor((F.col("rn") - 1) / F.lit(BATCH_SIZE)) + 1).cast("bigint").alias("batch")
    )


def key_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-4, B-6: the source rows whose key's ordinal lies in the second of
    ``UPSERT_BATCHES`` inclusive ranges, by an inner join on the key."""
    src = V.orders_source(spark, sf_dir)
    numbered = ordinal.global_ordinal(src.select("o_orderkey"), ["o_orderkey"])
    lo, hi = ordinal.batch_bounds(total := numbered.count(), max(1, -(-total // UPSERT_BATCHES)))[1]
    return ordinal.batch_of(numbered, src, ["o_orderkey"], lo, hi)


def batched_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-5: the orders source merged in ``UPSERT_BATCHES`` slices; equals one upsert."""
    target, source = V.orders_target(spark, sf_dir), V.orders_source(spark, sf_dir)
    return merge.merge_in_batches(target, source, ["o_orderkey"], UPSERT_BATCHES)[0]


def batch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-8: inserted, updated and seconds of all batches, by table."""
    from stellate.plans import metrics as M

    return M.accumulate_batches(V.batch_log(spark, sf_dir)).withColumnRenamed("table", "tbl")


def staging_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-9: seconds of all stages."""
    from stellate.plans import metrics as M

    return M.staging_total_sec(V.load_log(spark, sf_dir))


def upserts_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-9: seconds of the fact upserts."""
    from stellate.plans import metrics as M

    return M.upsert_total_sec(V.load_log(spark, sf_dir), V.LOG_FACTS)


def stage_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-10, G-4: stages by seconds."""
    from stellate.plans import metrics as M

    return M.stage_ranking(V.load_log(spark, sf_dir))


def phase_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G-5: seconds and share of copy, dedup, upserts and commit."""
    from stellate.plans import metrics as M

    return M.phase_shares(V.load_log(spark, sf_dir), V.LOG_FACTS)


def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G-1, G-2: rows and megabytes a second."""
    from stellate.plans import metrics as M

    return M.throughput(V.load_log(spark, sf_dir))


def orphan_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-8: documents that no label refers to (real orphans of a given pair of tables)."""
    docs = V.read(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return checks.orphans(docs, V.read(spark, sf_dir, "labels"), "doc_id")


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-9: (l_orderkey, l_linenumber) keys that are not unique, with their counts."""
    return checks.duplicate_keys(V.read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-10: NOT NULL on (user_key, day, user_label); error reports carry no label."""
    wide = V.w(spark, sf_dir).withColumn(
        "label", F.when(F.col("m_error") != "", F.lit("")).otherwise(F.col("label"))
    )
    typed = mapping.project(wide, V.W_TYPED)
    return checks.null_violations(typed, ["user_key", "day", "user_label"])


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-6, G-7: row count of each split table."""
    deduped = _materialised(V.w_dedup(V.w(spark, sf_dir)))
    parts = [V.dimension(deduped).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("users").alias("tbl"), "n_rows")]
    for m in V.W_FACTS:
        parts.append(
            mapping.project(deduped, m).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(m.name).alias("tbl"), "n_rows")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G-3: staged rows, deduplicated rows and the retention percentage: one row is kept
    for each key, so partial counts by key are all that travels."""
    per_key = V.w(spark, sf_dir).groupBy(*V.W_KEYS).agg(F.count(F.lit(1)).alias("n"))
    counts = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("staged_rows"), F.count(F.lit(1)).alias("dedup_rows"))
    return counts.select(
        "staged_rows",
        "dedup_rows",
        X.safe_ratio(F.col("dedup_rows"), F.col("staged_rows"), 100.0).alias("retention_pct"),
    )


def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G-6, G-8: inserted / updated / total after, per target, for the incremental load."""
    wide = V.w(spark, sf_dir)
    tgt, src = _materialised(V.w_target_half(wide)), _materialised(V.w_source_half(wide))
    parts = []
    pairs = [(V.W_DIMENSION, V.dimension(tgt), V.dimension(src))]
    pairs += [(m, mapping.project(tgt, m), mapping.project(src, m)) for m in V.W_FACTS]
    for m, t, s in pairs:
        counts = merge.merge_counts(merge.upsert(t, s, m.key_names, with_flags=True))
        parts.append(counts.select(F.lit(m.name).alias("tbl"), "inserted", "updated", "total_after"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-5 streaming: ``events`` arrive as ``STREAM_FILES`` files, in order of time; each is
    a micro-batch that is deduplicated, typed and merged into the activity fact (which
    starts as the history half)."""
    from stellate.session import scratch_path
    from stellate.streaming.upsert import run_fact_stream

    start = mapping.project(V.w_target_half(V.w(spark, sf_dir)), V.W_FACTS[0])
    events = V.read(spark, sf_dir, "events")
    day = F.to_date("ts")
    first, days = events.agg(F.min(day), F.datediff(F.max(day), F.min(day)) + 1).first()
    inbox = scratch_path(spark, "events-inbox")
    for i in range(STREAM_FILES if first else 0):
        part = F.floor(F.datediff(day, F.lit(first)) * STREAM_FILES / F.lit(days))
        events.filter(part == i).coalesce(1).write.mode("append").parquet(inbox)
    return run_fact_stream(spark, f"{inbox}/part-*", start, V.W_FACTS[0])


def csv_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-1..A-3, S1, S2: W written as a CSV with padded header names, read back all-text
    with the FAILFAST CSV source, then normalised (empty → NULL)."""
    from stellate.sources.csv import read_text_csv
    from stellate.sinks.tables import write_csv_file

    wide = V.w(spark, sf_dir)
    path = write_csv_file(wide, spark, "w-csv", pad_header=True)
    staged = read_text_csv(spark, path, required=list(V.W_KEYS))
    return staged.select(*[X.missing_to_null(c).alias(c) for c in staged.columns])


def csv_many_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-1, A-3: W written as three CSV files, one of them with its columns the other way
    round, and read back from their folder, each by its own header."""
    from stellate.session import scratch_path
    from stellate.sources.csv import read_text_csv

    wide = V.w(spark, sf_dir)
    folder = scratch_path(spark, "w-csv-files")
    parts = (F.col("m_click") != "", (F.col("m_click") == "") & (F.col("m_view") != ""), (F.col("m_click") == "") & (F.col("m_view") == ""))
    for i, (name, where) in enumerate(zip("abc", parts, strict=True)):
        columns = wide.columns[::-1] if i == 1 else wide.columns
        wide.filter(where).select(columns).write.option("header", True).csv(f"{folder}/{name}")
    staged = read_text_csv(spark, folder, required=list(V.W_KEYS))
    return staged.select(*[X.missing_to_null(c).alias(c) for c in wide.columns])


def _health_exact():
    """The health load schema with its tie-break spelled out: every scored column in file
    order, which is also the load's default."""
    import dataclasses

    from stellate.plans import health as H

    scored = [n for _, n, _, _ in V.health_cells() if n != H.LABEL]
    return dataclasses.replace(H.HEALTH, tiebreak=tuple(scored))


def _health_deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stellate.plans import load
    from stellate.session import wide_session

    wide = V.health_wide_view(V.read(wide_session(spark), sf_dir, "lineitem"))
    return load.deduplicate(wide, _health_exact())


def health_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-1 on the real 67-column layout: most complete row per (iso_code, date)."""
    from stellate.plans import load

    return _health_deduped(spark, sf_dir).drop(load.DAY)


def health_locatii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-1, B-1, F-5: the location dimension from the latest row per entity."""
    from stellate.plans import load

    return load.dimension_rows(_health_deduped(spark, sf_dir), _health_exact())


def _health_fact(n: int) -> Callable[[SparkSession, str], DataFrame]:
    from stellate.plans import health as H

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        from stellate.plans import load

        return load.fact_rows(_health_deduped(spark, sf_dir), H.FACTS[n])

    q.__doc__ = f"B-1, B-2, E-4: typed daily fact {H.FACTS[n].name} of the deduplicated rows."
    return q


def health_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole load (A..G) on the 67-column rows derived from ``lineitem``, into fresh
    targets in the shared checkpoint folder: dedup, dimension, five month-partitioned fact
    merges, NOT NULL and reference checks. Returns inserted / updated / total per table."""
    from stellate.plans import load
    from stellate.plans import metrics as M
    from stellate.session import scratch_path

    wide = V.health_wide_view(V.read(spark, sf_dir, "lineitem"))
    res = load.load_wide_frame(spark, wide, _health_exact(), scratch_path(spark, "health-load"))
    return M.load_summary(res.frame(spark)).drop("sec")


def batched_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-5, D-8: the load in batches of at most about ``BATCH_SIZE`` keys; inserted and updated
    rows of all batches, by table, and a digest of every row of the targets read back."""
    from stellate.plans import health as H
    from stellate.plans import load
    from stellate.plans import metrics as M
    from stellate.session import scratch_path

    wide = V.health_wide_view(V.read(spark, sf_dir, "lineitem"))
    res = load.load_wide_frame(spark, wide, _health_exact(), scratch_path(spark, "batched-load"), batch_rows=BATCH_SIZE)
    counts = M.accumulate_batches(res.batch_log(spark)).select(F.col("table").alias("tbl"), "inserted", "updated")
    targets = load.read_targets(spark, res.paths, _health_exact())
    digests = None
    for f in H.FACTS:
        one = targets[f.name].agg(F.sum(_row_digest(f)).alias("rows_digest")).select(F.lit(f.name).alias("tbl"), "rows_digest")
        digests = one if digests is None else digests.unionByName(one)
    return counts.join(digests, "tbl")


def _row_digest(fact: mapping.TableMap) -> "F.Column":
    """32 bits of the MD5 of a row's cells, numbers in hundredths; sums compare whole tables."""
    cells = []
    for c in fact.all_columns:
        v = F.round(F.col(c.target) * 100).cast("bigint") if c.kind == "double" else F.col(c.target)
        cells.append(F.coalesce(v.cast("string"), F.lit("~")))
    return F.conv(F.substring(F.md5(F.concat_ws("|", *cells).cast("binary")), 1, 8), 16, 10).cast("bigint")


def _w_facts(targets: dict[str, DataFrame]) -> DataFrame:
    """The three facts of ``W`` one under the other, values as text."""
    out = None
    for m in V.W_FACTS:
        values = [F.col(v).cast("double") for v in m.value_names] + [F.lit(None).cast("double")] * (3 - len(m.value_names))
        one = targets[m.name].select(F.lit(m.name).alias("tbl"), *m.key_names, *[v.alias(f"v{i}") for i, v in enumerate(values, 1)])
        out = one if out is None else out.unionByName(one)
    return out


def range_batched_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-5, B-6: ``W``, a month in all, loaded in ``RANGE_BATCHES`` key ranges cut by a quantile
    sketch; every row of the three facts, read back."""
    from stellate.plans import load
    from stellate.session import scratch_path

    wide = V.w_text(spark, sf_dir)
    keys = wide.select(*V.W_KEYS).distinct().count()
    res = load.load_wide_frame(spark, wide, V.w_schema(), scratch_path(spark, "range-load"), batch_rows=max(1, -(-keys // RANGE_BATCHES)))
    return _w_facts(load.read_targets(spark, res.paths, V.w_schema()))


def replayed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-5, E-6: a load in batches that is run again under its run id: no batch is merged
    twice, and the counts are those of the first run."""
    from stellate.plans import load
    from stellate.plans import metrics as M
    from stellate.session import scratch_path

    wide, root = V.w_text(spark, sf_dir), scratch_path(spark, "replayed-load")
    for _ in range(2):
        res = load.load_wide_frame(spark, wide, V.w_schema(), root, batch_rows=BATCH_SIZE, run_id="day")
    return M.load_summary(res.frame(spark)).drop("sec")


def concurrent_read_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-8, A-9: the orders merged into a target by month and into one without partitions.
    A reader takes all rows while the merge is decided and its rows are not yet in place
    (``during``), and again when it has ended (``after``)."""
    from stellate.session import scratch_path
    from stellate.sinks import tables

    out = None
    for kind, part in (("months", ("month", F.date_format("o_orderdate", "yyyy-MM"))), ("whole", ())):
        path, seen = scratch_path(spark, f"orders-{kind}"), []
        read = lambda: tables.read_target(spark, path).drop("month")  # noqa: B023, E731
        tables.merge_into_path(spark, V.orders_target(spark, sf_dir), path, ["o_orderkey"], *part)
        tables.merge_into_path(
            spark, V.orders_source(spark, sf_dir), path, ["o_orderkey"], *part,
            published=lambda: seen.append(tables.write_staged(read(), "orders-during")),  # noqa: B023
        )
        during = spark.read.parquet(seen[0])
        for moment, rows in (("during", during), ("after", read())):
            one = rows.select(F.lit(kind).alias("kind"), F.lit(moment).alias("moment"), *during.columns)
            out = one if out is None else out.unionByName(one)
    return out


def footer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-6, G-7: rows of the tables a load has written, by month, from their files' footers."""
    from stellate.plans import load
    from stellate.session import scratch_path
    from stellate.sinks import tables

    res = load.load_wide_frame(spark, V.w_text(spark, sf_dir), V.w_schema(), scratch_path(spark, "footer-load"))
    out = None
    for m in V.W_FACTS:
        one = tables.footer_counts(spark, res.paths[m.name], ["month"]).select(F.lit(m.name).alias("tbl"), F.col("month").cast("string").alias("month"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


def bucketed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-7: the orders merged into a target with the same buckets as the staged source."""
    from stellate.session import scratch_path
    from stellate.sinks.buckets import merge_into_buckets

    folder = scratch_path(spark, "bucketed")
    table = f"orders_{folder.rsplit('-', 1)[1]}"
    for rows in (V.orders_target(spark, sf_dir), V.orders_source(spark, sf_dir)):
        merge_into_buckets(spark, rows, table, folder, ["o_orderkey"], BUCKETS)
    return spark.table(table)


def csv_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-1: ``W`` in some hundred CSV files; every file's first line, read by tasks."""
    from stellate.session import scratch_path
    from stellate.sinks.staging import delete_path
    from stellate.sources.csv import LISTED, first_lines

    folder, staged = scratch_path(spark, "w-many-files"), scratch_path(spark, "w-by-users")
    wide = V.w(spark, sf_dir)
    # The users in some folders, one written after the other: a job that writes files tells
    # the driver the name of each.
    folders = 1 + wide.agg(F.approx_count_distinct("label")).first()[0] * 2 // LISTED
    wide.withColumn("users", F.pmod(F.xxhash64("label"), F.lit(folders))).hint("rebalance", "users").write.partitionBy("users").parquet(staged)
    rows = spark.read.schema(wide.schema.add("users", "long")).parquet(staged)
    tasks = 2 * spark.sparkContext.defaultParallelism
    for i in range(folders):
        some = rows.filter(F.col("users") == i).drop("users").repartition(tasks, "label").withColumn("part", F.col("label"))
        # a file for each user: put in place by the tasks that write them, not one by one by the driver
        some.write.partitionBy("part").option("header", True).option("mapreduce.fileoutputcommitter.algorithm.version", "2").csv(f"{folder}/users={i}")
    delete_path(spark, staged)
    user = F.regexp_extract("file", "part=([^/]*)/", 1)
    # a user whose rows are many may have several files
    return first_lines(spark, folder).select(user.alias("label"), "line").distinct()


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-3, S17: ``W`` as CSV in which the lines of errors are too short or too long. One scan
    stages the good rows and sets the ragged lines aside with their raw text."""
    from stellate.session import scratch_path
    from stellate.sources.csv import stage_with_rejects

    folder = scratch_path(spark, "w-ragged")
    wide = V.w(spark, sf_dir).withColumn("event_id", F.col("event_id").cast("string"))
    line = F.concat_ws(",", *wide.columns)
    short = F.concat_ws(",", *wide.columns[:-1])
    ragged = F.when(F.col("m_error") == "", line).when(F.col("m_early") != "", F.concat(line, F.lit(",more"))).otherwise(short)
    wide.select(ragged.alias(",".join(wide.columns))).write.option("header", True).option("sep", "\u0001").csv(folder)
    good, rejects, _ = stage_with_rejects(spark, folder, V.W_KEYS)
    cells = [F.coalesce(F.col(c), F.lit("")) for c in good.columns]
    return good.select(F.lit("good").alias("kind"), F.concat_ws(",", *cells).alias("raw")).unionByName(rejects.select(F.lit("reject").alias("kind"), "raw"))


def cast_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B-1, F-2..F-4: a lenient load of ``W`` with bad cells; by target column, the cells that
    did not convert, counted in the scan that wrote the deduplicated rows."""
    from stellate.plans import load
    from stellate.session import scratch_path

    wide = V.bad_cells(V.w_text(spark, sf_dir))
    res = load.load_wide_frame(spark, wide, V.w_schema(), scratch_path(spark, "lenient-load"), strict=False)
    return res.frame(spark).where("section = 'cast_errors'").select(F.col("name").alias("target_column"), F.col("value").cast("bigint").alias("cells"))


def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G-4, D-8: rows and order of the micro-batches of a stream over ``events``, from the
    history that a listener has written."""
    from stellate.session import scratch_path
    from stellate.streaming.progress import progress_history, recorded

    inbox, ckpt, history = (scratch_path(spark, f"progress-{n}") for n in ("inbox", "ckpt", "history"))
    events = V.read(spark, sf_dir, "events")
    events.withColumn("kind", F.col("event_type")).repartition("kind").write.partitionBy("kind").parquet(inbox)
    with recorded(spark, history):
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{inbox}/*")
        q = stream.writeStream.format("noop").option("checkpointLocation", ckpt).trigger(availableNow=True).start()
        q.awaitTermination()
    return progress_history(spark, history).agg(F.sum("rows").alias("n_rows"), F.min("batch").alias("first_batch"))


def _health_upsert(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        import dataclasses

        from stellate.plans import load
        from stellate.session import scratch_path

        full = _health_exact()
        schema = dataclasses.replace(full, facts=tuple(f for f in full.facts if f.name == name))
        root = scratch_path(spark, f"health-upsert-{name}")
        for extract in V.health_extracts(V.read(spark, sf_dir, "lineitem")):
            res = load.load_wide_frame(spark, extract, schema, root)
        return load.read_targets(spark, res.paths, schema)[name]

    q.__doc__ = f"E-3, E-4: table {name}, read back after two overlapping loads of history and a newer extract."
    return q


def narrow_source_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-4: the facts' merge path with a source that lacks the last two columns: they keep
    the target's values."""
    from stellate.plans import health as H
    from stellate.plans import load
    from stellate.session import scratch_path, wide_session
    from stellate.sinks import tables
    from stellate.sinks.files import Files
    from stellate.sinks.staging import delete_path

    spark = wide_session(spark)
    fact, path = H.FACTS[0], scratch_path(spark, "narrow-merge")
    first, second = V.health_extracts(V.read(spark, sf_dir, "lineitem"))
    for i, extract in enumerate((first, second)):
        rows = load.fact_rows(load.deduplicate(extract, _health_exact()), fact)
        rows = rows.drop(*fact.value_names[-2:]) if i else rows
        once = tables.write_staged(rows, "narrow-rows")  # read for its months and its rows
        staged = spark.read.schema(rows.schema).parquet(once)
        tables.merge_into_path(spark, staged, path, fact.key_names, load.PARTITION, tables.month_of(fact.key_names[1]), source_bytes=Files(spark, once).size(once))
        delete_path(spark, once)
    return tables.read_target(spark, path).select(*fact.key_names, *fact.value_names)


def _health_names() -> list[str]:
    from stellate.plans import health as H

    return [H.LOCATII.name, *[f.name for f in H.FACTS]]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stage_text": stage_text,
    "typed_projection": typed_projection,
    "rint_bigint": rint_bigint,
    "completeness_score": completeness_score,
    "dedup_most_complete": dedup_most_complete,
    "dedup_any_per_key": dedup_any_per_key,
    "latest_per_entity": latest_per_entity,
    "split_dimension": split_dimension,
    "split_fact_1": _split_fact(0),
    "split_fact_2": _split_fact(1),
    "split_fact_3": _split_fact(2),
    "insert_absent": insert_absent,
    "insert_absent_composite": insert_absent_composite,
    "update_coalesce": update_coalesce,
    "update_coalesce_composite": update_coalesce_composite,
    "upsert_orders": upsert_orders,
    "upsert_orders_auto": upsert_orders_auto,
    "runtime_filtered_upsert": runtime_filtered_upsert,
    "upsert_fact_1": _upsert_fact(0),
    "upsert_fact_2": _upsert_fact(1),
    "upsert_fact_3": _upsert_fact(2),
    "upsert_dimension": upsert_dimension,
    "merge_counts": merge_counts,
    "upsert_idempotent": upsert_idempotent,
    "key_ordinal": key_ordinal,
    "key_batches": key_batches,
    "key_slice": key_slice,
    "batched_upsert": batched_upsert,
    "batch_totals": batch_totals,
    "staging_total": staging_total,
    "upserts_total": upserts_total,
    "stage_ranking": stage_ranking,
    "phase_shares": phase_shares,
    "throughput": throughput,
    "orphan_check": orphan_check,
    "duplicate_keys": duplicate_keys,
    "null_violations": null_violations,
    "table_counts": table_counts,
    "retention": retention,
    "load_summary": load_summary,
    "stream_upsert": stream_upsert,
    "csv_stage": csv_stage,
    "csv_many_files": csv_many_files,
    "health_dedup": health_dedup,
    "health_locatii": health_locatii,
    "health_cazuri_zilnice": _health_fact(0),
    "health_testari_zilnice": _health_fact(1),
    "health_vaccinari_zilnice": _health_fact(2),
    "health_spitalizari_zilnice": _health_fact(3),
    "health_mortalitate_exces_zilnica": _health_fact(4),
    "health_load": health_load,
    "batched_load": batched_load,
    "range_batched_load": range_batched_load,
    "replayed_load": replayed_load,
    "concurrent_read_merge": concurrent_read_merge,
    "footer_counts": footer_counts,
    "bucketed_load": bucketed_load,
    "csv_headers": csv_headers,
    "csv_rejects": csv_rejects,
    "cast_errors": cast_errors,
    "stream_metrics": stream_metrics,
    "narrow_source_merge": narrow_source_merge,
    **{f"health_upsert_{n}": _health_upsert(n) for n in _health_names()},
}

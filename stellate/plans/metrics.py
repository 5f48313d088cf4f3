"""Load metrics as a small long-format DataFrame: (section, name, metric, value).

The loader's report is data, not a page: stage durations and their ranking, phase shares,
throughput, dedup retention, inserted/updated per table and final counts are all queries
over this frame. It holds a few dozen rows per run, so it is built on the driver; runs
can be appended to a Parquet/JSON history with ``append_history``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.functions.expressions import safe_ratio

SCHEMA = T.StructType(
    [
        T.StructField("section", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("metric", T.StringType(), False),
        T.StructField("value", T.DoubleType(), True),
    ]
)

# The stages shown in the report's ranking and the phases of its share chart.
REPORT_STAGES = ("create_staging", "copy", "dedup", "drop_staging", "commit")
PHASES = ("copy", "dedup", "upserts", "commit")


def metrics_frame(spark: SparkSession, records: Iterable[tuple[str, str, str, float]]) -> DataFrame:
    return spark.createDataFrame([(s, n, m, float(v)) for s, n, m, v in records], SCHEMA)


def stage_ranking(m: DataFrame) -> DataFrame:
    """G-4, D-10: stage durations, longest first."""
    return (
        m.filter((F.col("section") == "stages") & (F.col("metric") == "sec") & F.col("name").isin(*REPORT_STAGES))
        .select(F.col("name").alias("stage"), F.col("value").alias("sec"))
        .orderBy(F.col("sec").desc(), F.col("stage"))
    )


def staging_total_sec(m: DataFrame) -> DataFrame:
    """D-9: sum of every stage's seconds (commits included, upserts not)."""
    return m.filter((F.col("section") == "stages") & (F.col("metric") == "sec")).agg(
        F.coalesce(F.sum("value"), F.lit(0.0)).alias("staging_total_sec")
    )


def upsert_total_sec(m: DataFrame, facts: Iterable[str]) -> DataFrame:
    """D-9: seconds of the fact upserts together (the dimension excluded)."""
    return m.filter(
        (F.col("section") == "upserts") & (F.col("metric") == "sec") & F.col("name").isin(*list(facts))
    ).agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("upserts_sec"))


def phase_shares(m: DataFrame, facts: Iterable[str]) -> DataFrame:
    """G-5: copy, dedup, upserts (facts only), commit — seconds and share of their sum."""
    facts = list(facts)
    is_ = lambda section, name, metric="sec": (F.col("section") == section) & (F.col("name") == name) & (F.col("metric") == metric)
    tagged = m.select(
        *[F.sum(F.when(is_("stages", p), F.col("value"))).alias(p) for p in ("copy", "dedup", "commit")],
        # Facts merged side by side: the wall time, where the run recorded it.
        F.coalesce(
            F.max(F.when(is_("upserts", "facts", "wall_sec"), F.col("value"))),
            F.sum(F.when((F.col("section") == "upserts") & F.col("name").isin(*facts) & (F.col("metric") == "sec"), F.col("value"))),
        ).alias("upserts"),
    )
    per = tagged.select(F.explode(F.array(*[F.struct(F.lit(p).alias("phase"), F.col(p).alias("sec")) for p in PHASES])).alias("x")).select("x.*").filter(F.col("sec").isNotNull())
    # At most four phase rows, so a window over all of them is bounded.
    total = F.sum("sec").over(Window.partitionBy())
    return per.select("phase", "sec", safe_ratio(F.col("sec"), total).alias("share"))


def throughput(m: DataFrame) -> DataFrame:
    """G-1, G-2: rows per second and MB per second of the copy, 0 without a duration."""
    p = m.filter(F.col("section") == "copy").groupBy("name").pivot("metric", ["rows", "bytes", "sec", "lines"]).agg(
        F.first("value")
    )
    return p.select(
        F.col("rows").alias("processed"),
        F.col("lines").alias("total_lines"),
        F.col("sec").alias("duration_sec"),
        safe_ratio(F.col("rows"), F.col("sec")).alias("rows_per_sec"),
        safe_ratio(F.col("bytes") / F.lit(1_000_000.0), F.col("sec")).alias("mb_per_sec"),
        (F.col("bytes") / F.lit(1_000_000.0)).alias("size_mb"),
    )


def retention(m: DataFrame) -> DataFrame:
    """G-3: 100 · dedup rows / staged rows, 0 when nothing was staged."""
    p = (
        m.filter((F.col("section") == "stages") & (F.col("metric") == "rows"))
        .groupBy()
        .pivot("name", ["staging", "dedup"])
        .agg(F.first("value"))
    )
    return p.select(
        F.col("staging").alias("staged_rows"),
        F.col("dedup").alias("dedup_rows"),
        safe_ratio(F.col("dedup"), F.col("staging"), 100.0).alias("retention_pct"),
    )


def load_summary(m: DataFrame) -> DataFrame:
    """G-6, G-8: inserted, updated, seconds and final rows per table."""
    up = (
        m.filter((F.col("section") == "upserts") & F.col("metric").isin("inserted", "updated", "sec"))
        .groupBy("name")
        .pivot("metric", ["inserted", "updated", "sec"])
        .agg(F.first("value"))
    )
    fin = m.filter(F.col("section") == "final_counts").select("name", F.col("value").alias("total_after"))
    return up.join(fin, "name", "full_outer").select(
        F.col("name").alias("tbl"),
        F.coalesce("inserted", F.lit(0.0)).cast("long").alias("inserted"),
        F.coalesce("updated", F.lit(0.0)).cast("long").alias("updated"),
        F.coalesce("sec", F.lit(0.0)).alias("sec"),
        F.coalesce("total_after", F.lit(0.0)).cast("long").alias("total_after"),
    )


def accumulate_batches(batch_log: DataFrame) -> DataFrame:
    """D-8: per-table totals over a batch log (table, inserted, updated, sec)."""
    return batch_log.groupBy("table").agg(
        F.sum("inserted").alias("inserted"), F.sum("updated").alias("updated"), F.sum("sec").alias("sec")
    )


def append_history(m: DataFrame, path: str, run_id: str, fmt: str = "parquet") -> None:
    """A-13: append one run's metrics to a history table."""
    m.withColumn("run_id", F.lit(run_id)).write.mode("append").format(fmt).save(path)

"""Targets as catalog tables bucketed on their key.

The target and the staged source have the same buckets, so a merge joins them bucket by
bucket without moving a row of either: the full outer join's partitions are the buckets, and
each is written as the new bucket. The rows go to a folder of their own; the table's location
in the catalog is then switched to it, in one step for every reader of the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stellate.functions import expressions as X
from stellate.operators import merge
from stellate.sinks.files import Files


def write_buckets(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> None:
    """``df`` as the external table ``table`` at ``path``, bucketed and sorted on ``keys``."""
    df.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).format("parquet").saveAsTable(table)


def location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def bucketed_merge(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The merge of two tables with the same buckets, with its flags: no exchange."""
    return merge.upsert(target, source.hint("merge"), keys, strategy="shuffle", with_flags=True)


def merge_into_buckets(spark: SparkSession, source: DataFrame, table: str, folder: str, keys: Sequence[str], buckets: int) -> dict:
    """Merge ``source`` (unique on ``keys``) into ``table``, whose data lie under ``folder``.

    Only the source is exchanged, once, to be staged in buckets. A driver lost before the
    switch leaves the table as it was; what it staged is in folders that no table names.
    """
    fresh = lambda: f"{folder}/{uuid.uuid4().hex[:12]}"
    staged, new = f"{table}__source", fresh()
    source_at = fresh()
    valid = merge.valid_source(source, keys)
    write_buckets(valid.repartition(buckets, *[X.col(k) for k in keys]), staged, source_at, keys, buckets)
    try:
        if not spark.catalog.tableExists(table):
            write_buckets(spark.table(staged), table, new, keys, buckets)
            rows = spark.table(table).count()
            return {"inserted": rows, "matched_before": 0, "updated": rows, "total": rows}
        old = location(spark, table)
        obs = Observation("buckets")
        in_target, in_source = F.col(merge.IN_TARGET), F.col(merge.IN_SOURCE)
        merged = bucketed_merge(spark.table(table), spark.table(staged), keys).observe(
            obs,
            F.count(F.when(in_source & ~in_target, 1)).alias("inserted"),
            F.count(F.when(in_source & in_target, 1)).alias("matched_before"),
            F.count(F.lit(1)).alias("total"),
        )
        write_buckets(merged.select(*[X.col(c) for c in spark.table(table).columns]), f"{table}__next", new, keys, buckets)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{new}'")
        spark.sql(f"DROP TABLE {table}__next")  # external: its files are the target's now
        spark.catalog.refreshTable(table)
        Files(spark, folder).delete(old)
        counts = {k: int(v) for k, v in obs.get.items()}
        return counts | {"updated": counts["inserted"] + counts["matched_before"]}
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        Files(spark, folder).delete(source_at)

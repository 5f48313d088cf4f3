"""Staging tables: a namespace, a recreated table per run, kept or dropped at the end.

The intermediate rows of a load (the deduplicated wide rows) are written once and read by
every target. Held as a managed catalog table they can be inspected after the run
(``keep_staging``) and removed with ``DROP TABLE`` otherwise; without a catalog they are a
folder under the shared checkpoint location.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stellate.functions.expressions import qident


def table_name(namespace: str, name: str) -> str:
    return f"{qident(namespace)}.{qident(name)}"


def create_namespace(spark: SparkSession, namespace: str) -> None:
    """``CREATE DATABASE IF NOT EXISTS``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {qident(namespace)}")


def write_staging_table(df: DataFrame, namespace: str, name: str) -> DataFrame:
    """Recreate the staging table from ``df`` (drop + create in one overwrite) and return
    it as a table scan, so later readers start from the written rows."""
    spark = df.sparkSession
    create_namespace(spark, namespace)
    full = table_name(namespace, name)
    df.write.mode("overwrite").format("parquet").saveAsTable(full)
    return spark.table(full)


def drop_staging_table(spark: SparkSession, namespace: str, name: str) -> None:
    """``DROP TABLE IF EXISTS`` (a managed table's files go with it)."""
    spark.sql(f"DROP TABLE IF EXISTS {table_name(namespace, name)}")


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a staged folder through the Hadoop file system the path belongs to."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(hpath, True))

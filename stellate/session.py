"""Session helpers: a local session for tests and benches, and the checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "stellate") -> SparkSession:
    """Local session for tests and benches. On a cluster, build the session with the
    cluster's own settings instead; nothing in the library depends on these."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        # Wide rows (dozens of text columns scored in one expression) generate methods
        # larger than the JIT compiles (8000 bytes); above this limit Spark uses split,
        # JIT-compiled code instead of one whole-stage method.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Read ``spark.checkpoint.dir`` from the session (the cluster names it). Only a local
    session with no such setting gets a fresh temporary folder, as in tests; on a cluster a
    machine-local folder would not survive the loss of an executor, so it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder (HDFS/S3/ABFS) for checkpoints"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="stellate-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a staged table."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/staged/{name}-{uuid.uuid4().hex[:12]}"


#: Larger methods are not compiled by the JVM's just-in-time compiler.
METHOD_BYTES = 8000
#: Input of a task over wide rows: read, a byte of compressed columns becomes up to twenty.
WIDE_TASK_BYTES = 16 * 1024 * 1024


def wide_session(spark: SparkSession) -> SparkSession:
    """A session of its own for work on rows of dozens of text columns, with the settings of
    ``spark`` but two. Its generated code is split where one method would be too large to be
    compiled, and its scans cut their files into smaller tasks, whose rows fit into memory."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and session.conf.isModifiable(key):
            session.conf.set(key, value)
    at_most = {"spark.sql.codegen.hugeMethodLimit": METHOD_BYTES, "spark.sql.files.maxPartitionBytes": WIDE_TASK_BYTES}
    utils = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils
    for key, most in at_most.items():
        if utils.byteStringAsBytes(session.conf.get(key)) > most:
            session.conf.set(key, str(most))
    return session

"""Global ordinal ``ROW_NUMBER() OVER (ORDER BY keys)`` without a single-partition window.

A window with no ``PARTITION BY`` moves every row into one task. Instead:

1. range-partition on the keys (ties spread by a content hash) and sort inside each
   partition (one shuffle, sampled bounds, so partitions are roughly equal even when one
   key value holds a third of the rows);
2. tag each row with its partition id and position inside the partition
   (``monotonically_increasing_id`` is ``partition_id << 33 | position``);
3. materialise that with a reliable ``checkpoint()`` in the shared checkpoint folder, so
   the partition contents are fixed before they are counted;
4. count rows per partition — one small row per partition, a size bounded by the
   partition count, not by the data — and turn the counts into running offsets;
5. broadcast the offsets (again one row per partition) and add them to the positions.

Ties in the keys get distinct, arbitrary ordinals, as with ``ROW_NUMBER``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stellate.functions import expressions as X
from stellate.session import checkpoint_dir

ORDINAL = "rn"
_PID = "__pid"
_POS = "__pos"
_PLACE = "__place"


def global_ordinal(
    df: DataFrame,
    keys: Sequence[str],
    ordinal_col: str = ORDINAL,
    num_partitions: int | None = None,
) -> DataFrame:
    """``df`` plus a 1-based ordinal in ``keys`` order (ascending, NULLs last)."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Ties are in no particular order (as with ROW_NUMBER), so a content hash may settle
    # them: rows sharing a hot key value then spread over several range partitions instead
    # of one. Rows equal in all columns are told apart by their place in the input, fixed by
    # a checkpoint before it is used, so that a retried task sees the same partitioning.
    placed = df.withColumn(_PLACE, F.monotonically_increasing_id()).checkpoint(eager=True)
    order = [X.col(k).asc_nulls_last() for k in keys] + [F.xxhash64(_PLACE).asc()]
    tagged = (
        placed.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn(_PID, F.spark_partition_id())
        .withColumn(_POS, F.monotonically_increasing_id() - F.shiftleft(F.col(_PID).cast("long"), 33))
        .checkpoint(eager=True)
    )
    # One row per partition: bounded by the partition count, safe to broadcast.
    counts = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        _PID,
        (F.sum("__n").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1))).alias("__off"),
    ).fillna(0, subset=["__off"])
    return tagged.join(F.broadcast(offsets), _PID, "inner").select(
        *[X.col(c) for c in df.columns],
        (F.col("__off") + F.col(_POS) + F.lit(1)).alias(ordinal_col),
    )


def slice_between(df: DataFrame, lo: int, hi: int, ordinal_col: str = ORDINAL) -> DataFrame:
    """Rows with ``lo <= ordinal <= hi`` (inclusive range)."""
    return df.filter(F.col(ordinal_col).between(lo, hi))


def batch_of(df: DataFrame, source: DataFrame, keys: Sequence[str], lo: int, hi: int, ordinal_col: str = ORDINAL) -> DataFrame:
    """Source rows whose key's ordinal falls in ``[lo, hi]``: inner join on the keys."""
    keys = list(keys)
    return source.join(slice_between(df, lo, hi, ordinal_col).select(*keys), keys, "inner")


def batch_bounds(total: int, batch_size: int) -> list[tuple[int, int]]:
    """Inclusive ``(lo, hi)`` ranges of at most ``batch_size`` covering ``1..total``."""
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    return [(lo, min(lo + batch_size - 1, total)) for lo in range(1, total + 1, batch_size)]

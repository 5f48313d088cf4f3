"""Constraint checks that the database enforced and Spark does not.

Each returns the violating rows (a DataFrame), so a check is an ordinary distributed
query; ``assert_empty`` turns one into an error with a bounded sample in the message.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.functions import expressions as X


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "n") -> DataFrame:
    """Primary-key check: keys that occur more than once, with their count.

    ``GROUP BY keys HAVING COUNT(*) > 1``; partial counts are combined map-side, so a hot
    key costs one row per map task in the shuffle.
    """
    return (
        df.groupBy(*[X.col(k) for k in keys])
        .agg(F.count(F.lit(1)).alias(count_col))
        .filter(F.col(count_col) > 1)
    )


def null_violations(df: DataFrame, not_null: Sequence[str]) -> DataFrame:
    """NOT NULL check: rows with a NULL in any of ``not_null`` columns."""
    cond = F.lit(False)
    for c in not_null:
        cond = cond | X.col(c).isNull()
    return df.filter(cond)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: NULL count per column (one pass)."""
    return df.agg(*[F.count(F.when(X.col(c).isNull(), 1)).alias(c) for c in columns])


def orphans(
    fact: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dim_key: str | None = None,
) -> DataFrame:
    """Foreign-key check: fact rows whose key is not in the dimension (``NOT EXISTS``).

    A fact row with a NULL key is not an orphan (SQL FK semantics); NOT NULL catches it.
    Facts are keyed by entity, and one entity may hold a third of all fact rows: below the
    session's broadcast threshold Spark checks the facts where they lie, above it the join
    shuffles and AQE's skew handling splits the hot entity's partition.
    """
    dim_key = dim_key or fact_key
    d = dimension.select(X.col(dim_key).alias("__fk")).distinct()
    return fact.filter(X.col(fact_key).isNotNull()).join(d, X.col(fact_key) == F.col("__fk"), "left_anti")


def with_reference(fact: DataFrame, dimension: DataFrame, fact_key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose key exists in the dimension (``left_semi``)."""
    dim_key = dim_key or fact_key
    d = dimension.select(X.col(dim_key).alias("__fk"))
    return fact.join(d, X.col(fact_key) == F.col("__fk"), "left_semi")


class ConstraintViolation(ValueError):
    pass


def assert_empty(violations: DataFrame, what: str, sample: int = 5) -> None:
    """Raise if ``violations`` has a row; only a bounded sample reaches the driver."""
    rows = violations.take(sample)
    if rows:
        raise ConstraintViolation(f"{what}: violations found, e.g. {[r.asDict() for r in rows]}")


def assert_dedup_nonempty(staged_rows: int, dedup_rows: int) -> None:
    """Dedup sanity guard: a non-empty staging must not dedup to nothing."""
    if staged_rows > 0 and dedup_rows == 0:
        raise ConstraintViolation(f"dedup produced 0 rows from {staged_rows} staged rows")

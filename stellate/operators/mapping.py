"""Table mappings: one wide text row → typed target tables sharing a key.

A ``TableMap`` says which source column feeds which target column with which type. The
health schema and the test schemas are just different mappings passed to the same
operators (``project``, ``split``, ``empty_target``).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.functions import expressions as X

# Target type name → (Spark type, conversion from a text cell).
_TYPES = {
    "text": T.StringType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "bigint_round": T.LongType(),
    "date": T.DateType(),
}


#: Kinds read from number text.
_NUMBERS = ("double", "bigint", "bigint_round")
PLAIN = "__plain"


def convert(source: Column | str, kind: str, strict: bool = True, plain: Column | None = None) -> Column:
    """Typed value of a text cell. ``strict`` raises on bad input (ANSI casts). ``plain`` is
    the outcome of ``plain_numbers`` for a row with this cell."""
    if kind == "text":
        return X.to_text(source)
    if kind == "double":
        return X.to_double(source, strict, plain)
    if kind == "bigint":
        return X.to_bigint(source, strict, plain)
    if kind == "bigint_round":
        return X.text_to_rounded_bigint(source, strict, plain)
    if kind == "date":
        return X.to_date(source, strict)
    raise ValueError(f"unknown column type {kind!r}")


@dataclass(frozen=True)
class ColMap:
    source: str
    target: str
    kind: str = "double"
    nullable: bool = True

    def __post_init__(self):
        if self.kind not in _TYPES:
            raise ValueError(f"unknown column type {self.kind!r} for {self.target}")


@dataclass(frozen=True)
class TableMap:
    """One target table: key columns first, then measures."""

    name: str
    keys: tuple[ColMap, ...]
    columns: tuple[ColMap, ...] = field(default_factory=tuple)

    @property
    def key_names(self) -> list[str]:
        return [k.target for k in self.keys]

    @property
    def value_names(self) -> list[str]:
        return [c.target for c in self.columns]

    @property
    def all_columns(self) -> tuple[ColMap, ...]:
        return self.keys + self.columns

    @property
    def source_columns(self) -> list[str]:
        return [c.source for c in self.all_columns]

    @property
    def not_null(self) -> list[str]:
        """Columns that must hold a value: the keys and any declared NOT NULL column."""
        return self.key_names + [c.target for c in self.columns if not c.nullable]

    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c.target, _TYPES[c.kind], c.nullable and c not in self.keys) for c in self.all_columns]
        )


def table(name: str, keys: Sequence[tuple], columns: Iterable[tuple]) -> TableMap:
    """Shorthand: ``table('t', [('src','tgt','text')], [('src','tgt','double'), …])``."""
    return TableMap(name, tuple(ColMap(*k, nullable=False) for k in keys), tuple(ColMap(*c) for c in columns))


def project(df: DataFrame, tmap: TableMap, strict: bool = True, keep: Sequence[str] = (), known: dict[tuple[str, str], str] | None = None) -> DataFrame:
    """Typed projection of the source onto one target (rename + normalise + cast).

    Only the mapped columns are read, so Catalyst prunes the rest down to the scan.
    ``keep`` are columns that go along as they are. ``known`` names, for a source column and
    a type, the column that has its converted values already.
    """
    missing = [c for c in tmap.source_columns if c not in df.columns]
    if missing:
        raise ValueError(f"{tmap.name}: source lacks columns {missing}")
    known, kinds = known or {}, {f.name: f.dataType for f in df.schema}
    numbers = list(dict.fromkeys(c.source for c in tmap.all_columns if c.kind in _NUMBERS and kinds[c.source] == T.StringType()))
    if len(numbers) > 1:
        df = df.withColumn(PLAIN, X.plain_numbers(numbers))

    def value(c: ColMap) -> Column:
        if (c.source, c.kind) in known:
            return X.col(known[c.source, c.kind])
        return convert(X.col(c.source), c.kind, strict, F.col(PLAIN) if len(numbers) > 1 and c.source in numbers else None)

    return df.select(*[value(c).alias(c.target) for c in tmap.all_columns], *[X.col(c) for c in keep])


def split(df: DataFrame, maps: Sequence[TableMap], strict: bool = True) -> dict[str, DataFrame]:
    """Vertical split of one wide frame into several typed frames sharing its key."""
    return {m.name: project(df, m, strict) for m in maps}


def empty_target(spark: SparkSession, tmap: TableMap) -> DataFrame:
    """An empty frame with the target's schema (the table before its first load)."""
    return spark.createDataFrame([], tmap.schema())


def failed(c: ColMap) -> Column:
    """Whether a cell is present but does not convert to its type."""
    return X.is_present(c.source) & convert(X.col(c.source), c.kind, strict=False).isNull()


def cast_failures(maps: Iterable[TableMap]) -> list[Column]:
    """For ``DataFrame.observe``: by target column (``table.column``), the cells that are
    present but do not convert. Counted in the scan that writes the rows, not in another."""
    return [F.count(F.when(failed(c), 1)).alias(f"{m.name}.{c.target}") for m in maps for c in m.all_columns if c.kind != "text"]


def quarantine(df: DataFrame, tmap: TableMap) -> tuple[DataFrame, DataFrame]:
    """Lenient mode: rows whose cells all convert go to ``good``; rows with a cell that is
    present but does not convert go to ``bad`` (with the raw text kept for inspection).
    """
    from functools import reduce

    flags = [failed(c) for c in tmap.all_columns if c.kind != "text"]
    bad_flag = reduce(lambda a, b: a | b, flags) if flags else F.lit(False)
    flagged = df.withColumn("__bad", bad_flag)
    good = project(flagged.filter(~F.col("__bad")), tmap, strict=False)
    bad = flagged.filter(F.col("__bad")).drop("__bad")
    return good, bad

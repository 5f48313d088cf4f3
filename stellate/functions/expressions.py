"""Column expressions shared by every operator.

All of them are built-in Catalyst expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text forms accepted for a date cell. Strict: '2020-1-5' is rejected rather than folded
# into '2020-01-05', so two spellings of one day never collide on the primary key.
DATE_FORMAT = "yyyy-MM-dd"


def qident(name: str) -> str:
    """Quote a column name for Spark SQL, doubling embedded backticks.

    Header names may hold spaces, dots or quotes; a quoted name is always a single column.
    """
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """Column by exact name, safe for names with dots or spaces."""
    return F.col(qident(name))


def missing_to_null(c: Column | str) -> Column:
    """``NULLIF(c, '')``: an empty cell is a missing value.

    One shared normalise step for every text cell, applied before both insert and update.
    """
    c = col(c) if isinstance(c, str) else c
    return F.nullif(c, F.lit(""))


def is_present(c: Column | str) -> Column:
    """True when the cell holds a value: ``NULLIF(c,'') IS NOT NULL``.

    Works for a column of any type (a typed extra column in the staging counts when it is
    not NULL); the text form is compared, so no ``''`` is ever cast to a number.
    """
    c = col(c) if isinstance(c, str) else c
    return c.isNotNull() & (c.cast("string") != F.lit(""))


# Number text as the database reads it (no type suffix, no hex).
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
SPECIAL_NUMBER = r"^\s*([+-]?(?i:inf(inity)?)|(?i:nan))\s*$"
INTEGER = r"^\s*[+-]?\d+\s*$"
DATE = r"^\d{4}-\d{2}-\d{2}$"
#: In a text of these characters alone, Spark's casts read what ``NUMBER`` does, and no more.
PLAIN = "0-9.eE+-"
LEAST_BIGINT, BEYOND_BIGINT = -9223372036854775808.0, 9223372036854775808.0


def _checked(text: Column, value: Column, kind: str, strict: bool) -> Column:
    """``value``, but a present cell that gave none is an error when strict. Raised
    explicitly, so the outcome does not depend on the session's ANSI flag."""
    if not strict:
        return value
    failed = F.raise_error(F.concat(F.lit(f"not a {kind}: "), text)).cast(kind)
    return F.coalesce(value, F.when(text.isNotNull(), failed))  # computes the value once


def plain_numbers(columns: Iterable[str]) -> Column:
    """Whether the text cells ``columns`` hold only characters of ``PLAIN``. One search of a
    row, which spares its numbers a search each: hand it to ``to_double`` and the others."""
    return ~F.concat_ws("", *[col(c) for c in columns]).rlike(f"[^{PLAIN}]")


def _read(plain: Column | None, quick: Column, searched: Column) -> Column:
    return searched if plain is None else F.when(plain, quick).otherwise(searched)


def to_double(c: Column | str, strict: bool = True, plain: Column | None = None) -> Column:
    """Text → DOUBLE. Strict: a bad number is an error; lenient: NULL."""
    v = missing_to_null(c)
    searched = F.when(v.rlike(NUMBER) | v.rlike(SPECIAL_NUMBER), F.trim(v).try_cast("double"))
    return _checked(v, _read(plain, v.try_cast("double"), searched), "double", strict)


def to_bigint(c: Column | str, strict: bool = True, plain: Column | None = None) -> Column:
    """Text → BIGINT. ``'5.0'``, ``'abc'`` and numbers out of range are bad."""
    v = missing_to_null(c)
    quick = F.when(~F.contains(v, F.lit(".")), v.try_cast("bigint"))  # a cast alone cuts decimals off
    return _checked(v, _read(plain, quick, F.when(v.rlike(INTEGER), F.trim(v).try_cast("bigint"))), "bigint", strict)


def round_half_even_bigint(c: Column, strict: bool = True) -> Column:
    """``ROUND(double)::bigint`` with the half-to-even rule: 2.5 → 2, 3.5 → 4.

    ``F.round`` rounds half up, so ``rint`` (IEEE round-to-nearest-even) is used. NaN and
    numbers out of range are bad.
    """
    r = F.rint(c)
    fits = ~F.isnan(r) & (r >= LEAST_BIGINT) & (r < BEYOND_BIGINT)
    return _checked(r.cast("string"), F.when(fits, r.try_cast("bigint")), "bigint", strict)


def text_to_rounded_bigint(c: Column | str, strict: bool = True, plain: Column | None = None) -> Column:
    """Text → DOUBLE → half-even rounded BIGINT (used for counts published with decimals)."""
    return round_half_even_bigint(to_double(c, strict, plain), strict)


def to_date(c: Column | str, strict: bool = True) -> Column:
    """Text → DATE with the strict ``yyyy-MM-dd`` pattern."""
    v = missing_to_null(c)
    return _checked(v, F.when(v.rlike(DATE), F.try_to_date(v, DATE_FORMAT)), "date", strict)


def to_text(c: Column | str) -> Column:
    """Text → TEXT with empty cells treated as missing."""
    return missing_to_null(c)


def completeness_score(columns: Iterable[str]) -> Column:
    """Number of present (non-NULL, non-empty) cells among ``columns``.

    The length of a text with one character for each present cell: its terms are compiled
    into methods of their own, where a sum of dozens of terms is one too large to be compiled.
    """
    terms = [F.when(is_present(c), F.lit("1")) for c in columns]
    if not terms:
        return F.lit(0)
    return F.octet_length(F.concat_ws("", *terms))


def score_columns(columns: Iterable[str], exclude: Iterable[str]) -> list[str]:
    """Columns that count toward the score: every column except the excluded ones
    (keys and the entity label). Unknown extra columns count."""
    ex = set(exclude)
    return [c for c in columns if c not in ex]


def safe_ratio(numerator: Column, denominator: Column, scale: float = 1.0) -> Column:
    """``scale * n / d``, or 0 when ``d`` is 0 or NULL (rates and percentages)."""
    return F.coalesce(F.try_divide(numerator * F.lit(scale), denominator), F.lit(0.0))

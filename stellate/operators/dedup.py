"""Deduplication: one row per key.

* ``most_complete``     keep the row with the most present cells per key (ties broken
                        by an explicit, repeatable order)
* ``any_per_key``       keep one row per key, no preference
* ``latest_per_entity`` keep the row with the largest date per entity

Skew: every operator here combines on the map side before its single shuffle, so a key
that holds a third of all rows still sends at most one row per map task across the
network. ``most_complete`` plans a partial ``WindowGroupLimit`` below the exchange;
``latest_per_entity`` is a grouped maximum with a partial one below the exchange.

Width: the text cells of a wide row are sorted and exchanged as one packed text
(``stellate.functions.packing``), a third of the row's size in memory, so that a task's rows
are sorted without spilling.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.functions import expressions as X
from stellate.functions import packing

SCORE = "score"
RANK = "rn"
PACKED = "__packed"
ESCAPED = "__escaped"
#: Rows with so many text cells in their order travel packed.
PACK_FROM = 16


def _order(cols: Sequence[str | Column]) -> list[Column]:
    out = []
    for c in cols:
        out.append(X.col(c).asc_nulls_last() if isinstance(c, str) else c)
    return out


def with_score(df: DataFrame, exclude: Sequence[str], score_col: str = SCORE) -> DataFrame:
    """Add the completeness score: present cells over all columns but ``exclude``."""
    return df.withColumn(score_col, X.completeness_score(X.score_columns(df.columns, exclude)))


def most_complete_ranked(
    df: DataFrame,
    keys: Sequence[str],
    exclude: Sequence[str] = (),
    tiebreak: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Every row with its ``score`` and its rank ``rn`` inside its key (1 = kept)."""
    keys = list(keys)
    scored = with_score(df, list(keys) + list(exclude))
    if tiebreak is None:
        # Content order: the scored cells, compared left to right; a comparison stops at
        # the first cell that differs, so in practice it costs about one column.
        tiebreak = X.score_columns(df.columns, list(keys) + list(exclude))
    wide = packing_of(df, keys, exclude, tiebreak)
    if wide is None:
        return scored.withColumn(RANK, F.row_number().over(_best_first(keys, _order(tiebreak))))
    return wide.opened(_ranked(wide.packed(df), keys))


def _best_first(keys: Sequence[str], order: Sequence[Column]):
    return Window.partitionBy(*[X.col(k) for k in keys]).orderBy(F.col(SCORE).desc(), *order)


def _ranked(packed: DataFrame, keys: Sequence[str]) -> DataFrame:
    return packed.withColumn(RANK, F.row_number().over(_best_first(keys, [F.col(PACKED)])))


@dataclass(frozen=True)
class Packing:
    """Wide rows whose ``cells`` travel as one text, beside their score and other columns."""

    columns: tuple[str, ...]
    cells: tuple[str, ...]
    scored: tuple[str, ...]

    def packed(self, df: DataFrame) -> DataFrame:
        others = [X.col(c) for c in df.columns if c not in self.cells]
        return df.select(*others, X.completeness_score(self.scored).alias(SCORE), packing.packed(self.cells).alias(PACKED))

    def opened(self, df: DataFrame) -> DataFrame:
        """The columns in their first order, the score, then what ``df`` has besides."""
        added = [c for c in df.columns if c not in (*self.columns, SCORE, PACKED)]
        # one split and one search for each row: columns of their own
        parts = df.withColumn(ESCAPED, packing.escaped(F.col(PACKED))).withColumn(PACKED, packing.opened(F.col(PACKED)))
        place = {c: i for i, c in enumerate(self.cells)}
        cell = lambda c: packing.cell(F.col(PACKED), place[c], F.col(ESCAPED)).alias(c)
        return parts.select(*[cell(c) if c in place else X.col(c) for c in self.columns], SCORE, *[X.col(c) for c in added])


    def grouped(self, df: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
        """The packed text cut into one for each group of cells, to be opened on its own
        (``open_group``). Cells of no group are left out."""
        place = {c: i for i, c in enumerate(self.cells)}
        others = [X.col(c) for c in df.columns if c != PACKED]
        texts = [packing.regrouped(F.col(PACKED), [place[c] for c in cells]).alias(group_text(g)) for g, cells in groups.items() if cells]
        return df.withColumn(PACKED, packing.opened(F.col(PACKED))).select(*others, *texts)


def group_text(group: str) -> str:
    return f"{PACKED}_{group}"


def open_group(df: DataFrame, group: str, cells: Sequence[str]) -> DataFrame:
    """The cells of one group as columns, beside the columns that were never packed."""
    others = [X.col(c) for c in df.columns if not c.startswith(PACKED)]
    if not cells:
        return df.select(*others)
    text = X.col(group_text(group))
    parts = df.select(*others, packing.escaped(text).alias(ESCAPED), packing.opened(text).alias(PACKED))
    return parts.select(*others, *[packing.cell(F.col(PACKED), i, F.col(ESCAPED)).alias(c) for i, c in enumerate(cells)])


def packing_of(
    df: DataFrame, keys: Sequence[str], exclude: Sequence[str] = (), tiebreak: Sequence[str | Column] | None = None
) -> Packing | None:
    """How the rows of ``df`` travel through ``most_complete``: packed, or ``None`` as they are."""
    scored = X.score_columns(df.columns, [*keys, *exclude])
    cells = _packable(df, keys, scored if tiebreak is None else tiebreak)
    return Packing(tuple(df.columns), tuple(cells), tuple(scored)) if cells else None


def most_complete_packed(
    packed: DataFrame,
    wide: Packing,
    keys: Sequence[str],
    arranged: Callable[[DataFrame], DataFrame] | None = None,
    groups: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """``most_complete`` of rows that ``wide`` has packed. ``arranged`` lays the kept rows out
    for what comes next while they are packed, by their other columns. With ``groups`` they
    are not opened but stay packed, the cells of each group as one text."""
    kept = _ranked(packed, keys).filter(F.col(RANK) == 1).drop(RANK)
    kept = kept if arranged is None else arranged(kept)
    return wide.opened(kept) if groups is None else wide.grouped(kept, groups)


def _packable(df: DataFrame, keys: Sequence[str], tiebreak: Sequence[str | Column]) -> list[str]:
    """The tie-break's columns when they can travel packed in their place, else none: all of
    them text cells besides the keys, and many."""
    if not all(isinstance(c, str) for c in tiebreak):
        return []
    cells = list(dict.fromkeys(tiebreak))
    text = {f.name for f in df.schema if f.dataType == T.StringType()} - set(keys)
    return cells if len(cells) >= PACK_FROM and text.issuperset(cells) else []


def most_complete(
    df: DataFrame,
    keys: Sequence[str],
    exclude: Sequence[str] = (),
    tiebreak: Sequence[str | Column] | None = None,
    keep_rank: bool = False,
) -> DataFrame:
    """One row per ``keys``: the highest completeness score wins.

    ``exclude`` lists columns left out of the score besides the keys (the label).
    ``tiebreak`` orders rows with equal scores; by default every scored column ascending
    (NULLs last), which makes the choice independent of input order and partitioning.
    The result carries ``score`` (and ``rn`` = 1 when ``keep_rank``). The ``rn = 1``
    filter lets Catalyst plan a partial ``WindowGroupLimit`` before the shuffle.
    """
    ranked = most_complete_ranked(df, keys, exclude, tiebreak).filter(F.col(RANK) == 1)
    return ranked if keep_rank else ranked.drop(RANK)


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One arbitrary row per key (the DISTINCT ON fallback). Map-side combined."""
    return df.dropDuplicates(list(keys))


def latest_per_entity(
    df: DataFrame,
    entity: str,
    date: str,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Row with the largest ``date`` per ``entity`` (the whole row, not per-column last values).

    Rows with a NULL entity or a NULL date take no part, as an equi-join on the group's
    maximum drops them. Of several rows of the latest date the first in ``tiebreak`` and then
    content order stays: the maximum of a struct, largest in this order, with one row for
    each entity from a map task. The rows are computed once and exchanged once.
    ``date`` must be a DATE (or an ISO text), so the maximum is chronological.
    """
    valid = df.filter(X.col(entity).isNotNull() & X.col(date).isNotNull())
    order = dict.fromkeys([date, *tiebreak, *[c for c in df.columns if c != entity]])
    row = F.struct(*[X.col(c).alias(f"c{i}") for i, c in enumerate(order)])
    last = valid.groupBy(X.col(entity).alias("__entity")).agg(F.max(row).alias("__last"))
    found = {c: F.col(f"__last.c{i}") for i, c in enumerate(order)} | {entity: F.col("__entity")}
    return last.select(*[found[c].alias(c) for c in df.columns])


def latest_per_entity_join(df: DataFrame, entity: str, date: str) -> DataFrame:
    """The same result written as the classic self-join on ``(entity, MAX(date))``.

    Kept for comparison: with one hot entity the join side puts all of that entity's rows
    into one task, which ``latest_per_entity`` avoids.
    """
    m = df.groupBy(X.col(entity)).agg(F.max(X.col(date)).alias(date))
    return df.join(m, [entity, date], "inner").select(*[X.col(c) for c in df.columns])


def group_max(df: DataFrame, keys: Sequence[str], value: str, alias: str | None = None) -> DataFrame:
    """``MAX(value) … GROUP BY keys``."""
    return df.groupBy(*[X.col(k) for k in keys]).agg(F.max(X.col(value)).alias(alias or value))

"""Many text cells of a row as one text that sorts as they do.

A wide row of short cells is mostly offsets, lengths and padding. Packed, it holds its
characters and one mark between two cells, and comparing two packed texts gives the order of
their cells from left to right, each ascending, NULL last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stellate.functions import expressions as X

# BETWEEN two cells sorts below, and a MISSING (NULL) one above, what a cell can hold: these
# characters are written as an escape and another one, and so are the escapes.
BETWEEN, ESCAPE = "\x00", "\x01"
HIGH_ESCAPE, MISSING = "\U0010fffe", "\U0010ffff"
ESCAPED = {
    BETWEEN: ESCAPE + "\x03",
    ESCAPE: ESCAPE + "\x04",
    HIGH_ESCAPE: HIGH_ESCAPE + "\x03",
    MISSING: HIGH_ESCAPE + "\x04",
}


def _replaced(c: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def _holds(text: Column, marks: Sequence[str]) -> Column:
    found = F.contains(text, F.lit(marks[0]))
    for m in marks[1:]:
        found = found | F.contains(text, F.lit(m))
    return found


def packed(columns: Sequence[str]) -> Column:
    """The text cells ``columns`` as one text."""
    # the escapes themselves first: the others' codes begin with them
    pairs = sorted(ESCAPED.items(), key=lambda p: p[0] not in (ESCAPE, HIGH_ESCAPE))
    cells = [X.col(c) for c in columns]
    # few rows hold a character to escape: one search of the row spares four of each cell
    special = _holds(F.concat_ws("", *cells), list(ESCAPED))
    escaped = F.array_join(F.transform(F.array(*cells), lambda c: _replaced(c, pairs)), BETWEEN, MISSING)
    return F.when(special, escaped).otherwise(F.concat_ws(BETWEEN, *[F.coalesce(c, F.lit(MISSING)) for c in cells]))


def escaped(text: Column) -> Column:
    """Whether a packed text holds an escape."""
    return _holds(text, [ESCAPE, HIGH_ESCAPE])


def opened(text: Column) -> Column:
    """A packed text as an array, from which ``cell`` reads."""
    return F.split(text, BETWEEN, -1)


def regrouped(parts: Column, places: Sequence[int]) -> Column:
    """Cells of an opened text as a packed text of their own, in the order of ``places``."""
    return F.concat_ws(BETWEEN, *[parts[i] for i in places])


def cell(parts: Column, i: int, escaped: Column | None = None) -> Column:
    """Cell ``i`` of an opened text. ``escaped`` tells whether the text holds an escape at
    all: few do, and one search of a row then spares four of each cell."""
    # the escapes themselves last, as their codes leave characters that begin the others' codes
    pairs = sorted(((new, old) for old, new in ESCAPED.items()), key=lambda p: p[1] in (ESCAPE, HIGH_ESCAPE))
    text = F.nullif(parts[i], F.lit(MISSING))
    return _replaced(text, pairs) if escaped is None else F.when(escaped, _replaced(text, pairs)).otherwise(text)

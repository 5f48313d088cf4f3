"""Fill-in-middle transformation: cuts at text units, found by word-parallel byte marks.

A unit is a run of ASCII letters or any other single code point. Two hashes of ``doc_id``
give the units after which the prefix and the middle end; two more choose the form:

* ``plain``  the text as it is;
* ``psm``    ``<P>`` prefix ``<S>`` suffix ``<M>`` middle;
* ``spm``    ``<S>`` suffix ``<P>`` prefix ``<M>`` middle.

Method (SWAR, SIMD within a register). The UTF-8 bytes of a batch of texts are viewed as
uint64 words. Additions and shifts on whole words mark, in the top bit of each byte, the
bytes that end a unit; ``bitwise_count`` counts the marks of a word and a running sum of the
counts ranks any byte. To find the end of unit ``k`` the running sum is searched for the
word, and inside the word a multiplication spreads the prefix counts over its bytes, so that
one comparison gives the byte. No text is split, decoded or walked character by character.

Scale. A map over the input partitions without a shuffle; a text stays in its task and is
never cut short. Memory is about four times the bytes of a batch (4 MB, or one longer text).

Edge cases: a null text is empty, and an empty text is plain; a text that contains one of
the three marks is plain, so that every output can be taken apart again; a null ``doc_id``
hashes as the empty string; rows that repeat a ``doc_id`` are cut one by one; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import slices, text_input

#: Fixed values of the output format and the choice of forms.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
PLAIN_FROM, SPM_BELOW = 90, 20

TOP = np.uint64(0x8080808080808080)
LOW = np.uint64(0x7F7F7F7F7F7F7F7F)
ONES = np.uint64(0x0101010101010101)
#: Words marked at once: bounds the temporary arrays of a very long text.
BLOCK_WORDS = 1 << 17


def _at_least(bytes7: np.ndarray, value: int) -> np.ndarray:
    """Top bit of each byte whose low seven bits are ``value`` or more."""
    return (bytes7 + ONES * np.uint64(0x80 - value)) & TOP


def letters(words: np.ndarray) -> np.ndarray:
    """Marks of the bytes that are ASCII letters."""
    lower = (words | ONES * np.uint64(0x20)) & LOW
    return _at_least(lower, 0x61) & ~_at_least(lower, 0x7B) & ~words & TOP


def continuations(words: np.ndarray) -> np.ndarray:
    """Marks of the bytes ``10xxxxxx``, which do not begin a code point."""
    return words & ~(words << np.uint64(1)) & TOP


def _following(marks: np.ndarray, last: np.uint64) -> np.ndarray:
    """Each byte's mark replaced by that of the byte after it (little-endian words)."""
    after = np.append(marks[1:], last)
    return marks >> np.uint64(8) | after << np.uint64(56)


def unit_ends(words: np.ndarray) -> np.ndarray:
    """Marks of the bytes that end a unit: a letter before a byte that is none, or another
    byte before one that begins a code point."""
    out = np.empty_like(words)
    for a in range(0, len(words), BLOCK_WORDS):
        block = words[a : a + BLOCK_WORDS + 1]  # one word more, to look ahead
        letter, rest = letters(block), continuations(block)
        none = np.uint64(0)
        ends = (letter & ~_following(letter, none)) | (~letter & ~_following(rest, none) & TOP)
        out[a : a + BLOCK_WORDS] = ends[:BLOCK_WORDS]
    return out


class Marks:
    """Rank and select over marked bytes."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.upto = np.cumsum(np.bitwise_count(marks), dtype=np.int64)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marks before byte ``at``."""
        word, within = at >> 3, (at & 7).astype(np.uint64)
        padded = np.minimum(word, len(self.marks) - 1)
        inside = self.marks[padded] & ((np.uint64(1) << (within << np.uint64(3))) - np.uint64(1))
        before = np.where(word > 0, self.upto[np.maximum(word, 1) - 1], 0)
        return before + np.where(word < len(self.marks), np.bitwise_count(inside), 0)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte of the ``k``-th mark (from 1)."""
        word = np.searchsorted(self.upto, k, "left")
        marks = self.marks[word]
        left = (k - (self.upto[word] - np.bitwise_count(marks))).astype(np.uint64)
        counts = (marks >> np.uint64(7)) * ONES  # byte i holds the marks of bytes 0 to i
        reached = ((counts | TOP) - ONES * left) & TOP
        return word * 8 + 8 - np.bitwise_count(reached)


def choices(doc_id: str) -> tuple[int, int, int, int]:
    """The four hashes of a row."""
    digest = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    return tuple(int(digest[i : i + 8], 16) for i in range(0, 32, 8))


def _form(text: bytes, h3: int, h4: int) -> str:
    if not text or h3 % 100 >= PLAIN_FROM or any(m.encode() in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return PLAIN
    return SPM if h4 % 100 < SPM_BELOW else PSM


def transform(texts: list[bytes], ids: list[str]) -> list[tuple[int, str, int | None, int | None, str]]:
    """``(units, form, prefix_chars, middle_chars, output)`` of every text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    buffer = b"".join(texts)
    words = np.frombuffer(buffer + bytes(-len(buffer) % 8 + 8), "<u8")
    marks = unit_ends(words)
    last = ends[sizes > 0] - 1  # the end of a text ends its last unit, whatever comes next
    np.bitwise_or.at(marks, last >> 3, np.uint64(0x80) << ((last & 7).astype(np.uint64) << np.uint64(3)))
    units, points = Marks(marks), Marks(~continuations(words) & TOP)
    before = units.rank(starts)
    n = units.rank(ends) - before

    hashes = np.array([choices(i) for i in ids], np.int64).reshape(-1, 4)
    cuts = np.sort(hashes[:, :2] % (n + 1)[:, None], axis=1)
    at = np.repeat(starts[:, None], 2, axis=1)
    at[cuts > 0] = units.select((before[:, None] + cuts)[cuts > 0]) + 1
    chars = points.rank(np.column_stack([starts, at]).ravel()).reshape(-1, 3)

    out = []
    for i, text in enumerate(texts):
        form = _form(text, *hashes[i, 2:].tolist())
        if form == PLAIN:
            out.append((int(n[i]), form, None, None, text.decode("utf-8")))
            continue
        a, b = (at[i] - starts[i]).tolist()
        prefix, middle, suffix = text[:a].decode("utf-8"), text[a:b].decode("utf-8"), text[b:].decode("utf-8")
        parts = (PREFIX, prefix, SUFFIX, suffix) if form == PSM else (SUFFIX, suffix, PREFIX, prefix)
        out.append((int(n[i]), form, *np.diff(chars[i]).tolist(), "".join([*parts, MIDDLE, middle])))
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
        made = transform(texts, ["" if i is None else str(i) for i in batch.column(0).to_pylist()])
        n, form, prefix, middle, output = zip(*made, strict=True)
        columns = [pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string())]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``n`` units, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``."""
    kind = docs.schema[id_column].dataType.simpleString()
    source = text_input(docs, F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return source.mapInArrow(_rows, f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(form: Column, output: Column) -> Column:
    """The text again, from the output and its form alone. No mark can begin inside another
    or across a seam, so the first mark found is the one that was set."""

    def between(start: str, end: str) -> Column:
        return F.substring_index(F.substring_index(output, start, -1), end, 1)

    middle = F.substring_index(output, MIDDLE, -1)
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)


def infill_digests(made: DataFrame) -> DataFrame:
    """One digest row per document from the real outputs, each taken apart again."""
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        digest(F.col("output")).alias("output_sha256"),
        digest(restored(F.col("form"), F.col("output"))).alias("restored_sha256"),
    )

"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Method. Rows are dealt to *chunks*. Each chunk sends its sorted distinct fingerprints to
the *owners* of the fingerprint ranges, as Golomb (Rice) coded gaps. An owner decodes all
messages, finds the fingerprints that more than one chunk sent, and answers every message
with a bitmap. A chunk marks the rows whose bit is set, or whose fingerprint it holds
twice, as suspects. Only suspects, one representative for each chunk and text, fetch their
text for the verification byte by byte.

Scale. A row costs 64 bytes after the first pass; texts move only for representatives. A
text that a third of all rows share is one fingerprint per chunk, one representative per
chunk, and one partial aggregate: no task sees all its rows. Chunks and owners grow with
the number of rows.

Edge cases: a null text is an empty text, and empty texts equal each other; of rows that
repeat both ``doc_id`` and text exactly one stays; a null ``doc_id`` sorts first among
equal texts; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import discard, slices, staged, text_input, text_print

#: Fixed value: the characters that do not count.
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
CHUNK_ROWS, OWNER_ROWS, LEAST_CHUNKS, LEAST_OWNERS = 1_000_000, 4_000_000, 24, 12
FINGERPRINT_BITS = 63


def rice_encode(values: np.ndarray) -> bytes:
    """Sorted distinct unsigned numbers as Rice-coded gaps: count, parameter, first the
    unary quotients and then the fixed-width remainders, as two bit streams."""
    n = len(values)
    gaps = np.diff(values, prepend=np.int64(0)).astype(np.int64)
    mean = float(values[-1]) / n if n else 0.0
    k = max(0, math.floor(math.log2(mean * math.log(2)))) if mean > 2 else 0
    quotient = gaps >> k
    unary = np.zeros(int(quotient.sum()) + n, np.uint8)
    unary[np.cumsum(quotient + 1) - 1] = 1
    rest = ((gaps[:, None] >> np.arange(k)) & 1).astype(np.uint8).ravel()
    head = np.array([n, k, len(unary)], np.int64).tobytes()
    return head + np.packbits(unary).tobytes() + np.packbits(rest).tobytes()


def rice_decode(blob: bytes) -> np.ndarray:
    n, k, unary_bits = np.frombuffer(blob, np.int64, 3).tolist()
    body = np.frombuffer(blob, np.uint8, offset=24)
    cut = (unary_bits + 7) // 8
    ends = np.flatnonzero(np.unpackbits(body[:cut], count=unary_bits))
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.int64) << k
    if k:
        rest = np.unpackbits(body[cut:], count=n * k).reshape(n, k)
        for bit in range(k):
            gaps |= rest[:, bit].astype(np.int64) << bit
    return np.cumsum(gaps)


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = 0
    for batch in slices(batches):
        place = np.arange(seen, seen := seen + batch.num_rows)
        texts = [t or "" for t in batch.column(1).to_pylist()]
        coded = [t.encode() for t in texts]
        digests = [hashlib.sha256(t.translate(None, BLANKS)).digest() for t in coded]
        prints = np.array([xxhash.xxh64_intdigest(t, seed=42) for t in coded], np.uint64).astype(np.int64)  # Spark's xxhash64
        heads = np.frombuffer(b"".join(d[:8] for d in digests), ">u8") >> np.uint64(64 - FINGERPRINT_BITS)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(heads.astype(np.int64)), pa.array(digests, pa.binary()), pa.array(prints), pa.array(place)],
            names=["doc_id", "n_chars", "fingerprint", "sha", "print", "place"],
        )


def _send(bits: int, owners: int):
    """A chunk's messages: its sorted distinct fingerprints, cut by owner."""

    def run(chunk: pd.DataFrame) -> pd.DataFrame:
        values = np.unique(chunk["fingerprint"].to_numpy() >> (FINGERPRINT_BITS - bits))
        width = -(-(1 << bits) // owners)
        of = values // width
        cuts = np.searchsorted(of, np.arange(owners + 1))
        sent = [(o, a, b) for o, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
        return pd.DataFrame({
            "chunk": chunk["chunk"].iloc[0],
            "owner": [o for o, _, _ in sent],
            "message": [rice_encode(values[a:b] - o * width) for o, a, b in sent],
        })

    return run


def _answer(messages: pd.DataFrame) -> pd.DataFrame:
    """An owner's answers: for each message one bit for each fingerprint, set if any other
    chunk sent it too."""
    held = [rice_decode(m) for m in messages["message"]]
    values, counts = np.unique(np.concatenate(held), return_counts=True)
    twice = counts > 1
    bitmaps = [np.packbits(twice[np.searchsorted(values, h)]).tobytes() for h in held]
    return pd.DataFrame({"chunk": messages["chunk"], "owner": messages["owner"], "n": [len(h) for h in held], "bitmap": bitmaps})


def _mark(bits: int):
    """A chunk's rows with ``suspect``, and ``first`` for one of rows equal in id and text."""

    def run(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        answers = answers.sort_values("owner")
        twice = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(answers["bitmap"], answers["n"], strict=True)]).astype(bool)
        values, at, counts = np.unique(rows["fingerprint"].to_numpy() >> (FINGERPRINT_BITS - bits), return_inverse=True, return_counts=True)
        rows["suspect"] = (twice | (counts > 1))[at]
        rows = rows.sort_values("print", kind="stable")
        rows["first"] = ~rows.duplicated(["doc_id", "n_chars", "sha"])
        return rows[["chunk", "doc_id", "n_chars", "sha", "print", "suspect", "first"]]

    return run


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256, n_chars,
    print`` (the last names the row's text, see ``common.survivors``).

    Texts are equal when identical without blanks. Of equal texts the row with the most
    code points stays, then the smallest ``doc_id``.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_column].dataType.simpleString()
    source = text_input(docs, F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    prints = staged(source.mapInArrow(_fingerprint, f"doc_id {kind}, n_chars bigint, fingerprint bigint, sha binary, print bigint, place bigint"), "exact-prints")
    n = prints.count()
    chunks, owners = max(LEAST_CHUNKS, n // CHUNK_ROWS), max(LEAST_OWNERS, n // OWNER_ROWS)
    bits = min(FINGERPRINT_BITS, max(n, 2).bit_length() + 20)
    # The staged place in the input spreads also rows that are equal in id and text.
    rows = prints.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "sha", "place"), F.lit(chunks))).drop("place")

    sent = rows.select("chunk", "fingerprint").groupBy("chunk").applyInPandas(_send(bits, owners), "chunk bigint, owner int, message binary")
    answers = sent.groupBy("owner").applyInPandas(_answer, "chunk bigint, owner int, n bigint, bitmap binary")
    marked = staged(
        rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
            _mark(bits), f"chunk bigint, doc_id {kind}, n_chars bigint, sha binary, print bigint, suspect boolean, first boolean"
        ),
        "exact-marked",
    )
    discard(prints)

    # Of rows equal in id and text the chunk settles the one that stays.
    best = F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").alias("id"), "print", "chunk")
    reps = staged(marked.where("suspect").groupBy("chunk", "sha").agg(F.min(best).alias("best"), F.count("*").alias("rows")), "exact-reps")
    # Sort-merge at every size: representatives grow with the input, a broadcast would not scale.
    # Fetch the representatives' texts, then group by the bytes themselves.
    fetch = reps.select(F.col("best.id").alias("want"), F.col("best.print").alias("want_print"), "sha", "best", "rows")
    norm = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), "[\\x20\\x09-\\x0D]+", "").cast("binary")
    with_text = (
        source.join(fetch.hint("merge"), F.col("doc_id").eqNullSafe(F.col("want")) & (text_print(F.col("text")) == F.col("want_print")))
        .withColumn("norm", norm)
        .where(F.unhex(F.sha2("norm", 256)) == F.col("sha"))
        .dropDuplicates(["sha", "norm", "best", "rows"])
    )
    by_bytes = with_text.groupBy("sha", "norm").agg(F.min("best").alias("best"), F.sum("rows").alias("rows"))
    groups = staged(
        by_bytes.groupBy("sha").agg(F.min("best").alias("best"), F.sum("rows").alias("rows"), F.count("*").alias("texts"))
        .where(F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts share one SHA-256")).cast("boolean")).otherwise(F.col("rows") > 1)),
        "exact-groups",
    )
    # By chunk, so that the rows of a very common text stay spread.
    verdicts = reps.select("chunk", "sha").join(groups, "sha").select("chunk", "sha", "best", "rows")
    out = marked.join(verdicts, ["chunk", "sha"], "left")
    alone = F.col("best").isNull()
    return out.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("rows")).cast("long").alias("group_size"),
        (F.col("first") & (alone | (best.eqNullSafe(F.col("best"))))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "n_chars", "print",
    )

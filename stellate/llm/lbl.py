"""Language-model scores from a log-bilinear model trained by noise-contrastive estimation.

Method.

1. *Corpus counts.* One pass tokenises every text and writes, for each batch of documents,
   its distinct words with their training counts, and each document as indices into that
   list. Word counts over all training documents follow by grouping the words.
2. *Units.* A word with at least ``sqrt(N) / PER_ROOT`` of the ``N`` training tokens is a unit
   of its own, so the units grow with the corpus, and are at most ``PER_ROOT * sqrt(N)``. Rarer
   words share ``BUCKETS`` units by their last letters (hashed); a word has its unit's
   probability times its share of the unit by training counts. Units in order of their mass
   are cut into about ``sqrt(units)`` classes of like mass.
3. *Model.* The units before a token predict a vector, each position with its own diagonal
   weights; its products with the class vectors, plus biases, are the class scores, those
   with the vectors of a class's units the scores inside the class. Training is
   noise-contrastive at both levels: each true class against ``NOISE`` classes, each true unit
   against ``INNER_NOISE`` units of its class, drawn by training frequency, in numpy
   minibatches with AdaGrad on the rows touched. A first model is fitted on at most
   ``WARM_TOKENS`` tokens of the documents with the least hashes; from it all training
   documents, dealt by hash to parts of about ``PART_TOKENS``, train a copy each, and every
   row of the parameters is averaged by the tokens that touched it, in a grouped aggregation.
4. *Scores.* Context vectors times all class vectors, and times the vectors of the true
   class's units, thousands of tokens at a time, are normalised at both levels, so the scores
   are proper log-probabilities. They do not depend on how the input is partitioned.

Scale. What travels is a few bytes a token (word indices, then units) and a row for each
distinct word of a batch; a very frequent word is one row for each batch. The driver holds one
model (``34 * PER_ROOT * sqrt(N)`` numbers: 5 MB at 30 GB of text, some 40 MB at 100 TB).

Edge cases: a null or empty text is only its end token; documents whose ``doc_id`` is null
take part with the text ``''`` as id; rows that repeat a ``doc_id`` are scored each; with no
training token at all every word is unknown and N is 0; very long texts are whole; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import discard, gathered, slices, staged, text_input
from stellate.llm.ranked import decode_ranks, encode_ranks

#: Units of their own are at most PER_ROOT * sqrt(training tokens); rarer words share the buckets.
PER_ROOT, BUCKETS = 4, 64
CONTEXT, DIMENSIONS, NOISE, INNER_NOISE, MINIBATCH, RATE = 4, 16, 32, 4, 4096, 0.08
WARM_TOKENS, WARM_STEPS, PART_TOKENS = 2 << 20, 1200, 4 << 20
#: Tokens scored together, and scores that stand in the processor's cache at once.
SCORED_AT_ONCE, SCORES_AT_ONCE, SLICE_TOKENS = 1 << 17, 1 << 18, 1 << 20
#: Text of one batch: larger ones repeat fewer words, so fewer rows travel.
BATCH_BYTES = 8 << 20
END = b"\n"  # cannot be a word
SMOOTHING = 0.1


def crc_of_id(doc_id) -> int:
    return zlib.crc32(str("" if doc_id is None else doc_id).encode())


def _tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two kinds of rows in one table: documents (indices into the batch's words) and words."""
    for batch in gathered(batches, BATCH_BYTES):
        name = uuid.uuid4().int >> 65
        of: defaultdict[bytes, int] = defaultdict()
        of.default_factory = of.__len__  # a new word gets the next index
        of[END] = 0
        ids, held, codes, train = batch.column(0), [], [], []
        for doc_id, text in zip(ids.to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = (text or "").encode().lower().split()
            words.append(END)
            at = np.fromiter(map(of.__getitem__, words), np.int32, len(words))
            held.append(crc_of_id(doc_id) % 10 == 0)
            codes.append(pack(at))
            if not held[-1]:
                train.append(at)
        counts = np.bincount(np.concatenate(train) if train else np.empty(0, np.int32), minlength=len(of))
        k, m = len(ids), len(of)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(k + m, name, np.int64)),
                pa.concat_arrays([ids, pa.nulls(m, ids.type)]),
                pa.concat_arrays([pa.array(held, pa.bool_()), pa.nulls(m, pa.bool_())]),
                pa.concat_arrays([pa.array(codes, pa.binary()), pa.nulls(m, pa.binary())]),
                pa.concat_arrays([pa.nulls(k, pa.int32()), pa.array(np.arange(m, dtype=np.int32))]),
                pa.concat_arrays([pa.nulls(k, pa.binary()), pa.array(of, pa.binary())]),
                pa.concat_arrays([pa.nulls(k, pa.int64()), pa.array(counts.astype(np.int64))]),
            ],
            names=["batch", "doc_id", "held_out", "indices", "at", "word", "n"],
        )


def pack(indices: np.ndarray) -> bytes:
    """Indices in byte-aligned codes; common words come first in a batch, so most take one byte."""
    control, data = encode_ranks(indices)
    return len(indices).to_bytes(4, "little") + control + data


def unpack(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:4], "little")
    cut = 4 + -(-n // 4)
    return decode_ranks(packed[4:cut], packed[cut:], n)


class Units:
    """Units in descending order of mass, and the classes they are cut into."""

    def __init__(self, mass: np.ndarray):
        self.mass = (mass + 1.0) / (mass + 1.0).sum()
        ends = np.cumsum(self.mass)
        near = np.floor((ends - self.mass / 2) * max(1, math.isqrt(len(mass)))).astype(np.int64)
        self.of = np.cumsum(np.diff(near, prepend=near[:1]) > 0).astype(np.int32)
        self.first = np.append(np.flatnonzero(np.diff(self.of, prepend=-1)), len(mass))
        self.before = np.append(0.0, ends)
        self.class_mass = np.diff(self.before[self.first])
        self.small = np.uint16 if len(mass) < (1 << 16) - 1 else np.int32
        self.alone = np.diff(self.first) == 1
        self.steps = 1 << (8 * len(mass)).bit_length()
        self.guide = np.searchsorted(self.before, np.arange(self.steps + 1) / self.steps, side="right") - 1

    def at(self, place: np.ndarray) -> np.ndarray:
        """The unit at each place of the running mass: from the one at the step below, upwards."""
        last = len(self) - 1
        out = np.minimum(self.guide.take((place * self.steps).astype(np.int64), mode="clip"), last).ravel()
        left = np.arange(out.size)
        while len(left):
            at = out[left]
            left = left[(at < last) & (self.before.take(at + 1) <= place.ravel().take(left))]
            out[left] += 1
        return out.reshape(place.shape)

    def __len__(self) -> int:
        return len(self.mass)


class LogBilinear:
    """The model, one row of ``rows`` for each vector (and its bias): context units with the
    place before a text, units inside their class, classes, and the context positions' weights."""

    def __init__(self, units: Units, rows: np.ndarray | None = None):
        self.units = units
        n, c, d = len(units), len(units.class_mass), DIMENSIONS
        self.cuts = [n + 1, 2 * n + 1, 2 * n + 1 + c]
        if rows is None:
            r = np.random.default_rng(11)
            rows = r.normal(0, 0.1, (self.cuts[-1] + CONTEXT, d + 1))
            rows[: n + 1, d], rows[self.cuts[-1] :] = 0, 1.0 / CONTEXT
            rows[n + 1 : self.cuts[1], d] = np.log(units.mass / units.class_mass[units.of])
            rows[self.cuts[1] : self.cuts[2], d] = np.log(units.class_mass)
        self.rows = np.array(rows, np.float32)
        self.squares = np.full(self.rows.shape, 1e-6, np.float32)
        self.touched = np.zeros(len(self.rows))

    def tables(self) -> list[np.ndarray]:
        given, inner, classes, weight = np.split(self.rows, self.cuts)
        return [given[:, :-1], inner, classes, weight[:, :-1]]

    @staticmethod
    def contexts(units: np.ndarray, none: int) -> np.ndarray:
        """For each token of one document the units before it; ``none`` where none is."""
        padded = np.concatenate([np.full(CONTEXT, none, units.dtype), units])
        return np.stack([padded[CONTEXT - 1 - i : len(padded) - 1 - i] for i in range(CONTEXT)], axis=1)

    def predicted(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Predicted vectors, with a last 1 for the bias, and the context's rows they are made of."""
        held = self.rows.take(context, axis=0)
        out = np.einsum("nid,id->nd", held, np.split(self.rows, self.cuts)[3])
        out[:, -1] = 1
        return out, held

    def log10(self, context: np.ndarray, units: np.ndarray) -> np.ndarray:
        """Normalised log10 probabilities of the units."""
        out = np.empty(len(units), np.float64)
        _, inner, classes, _ = self.tables()
        u = self.units
        for a in range(0, len(units), SCORED_AT_ONCE):
            ctx, y = context[a : a + SCORED_AT_ONCE], units[a : a + SCORED_AT_ONCE]
            kind = u.of[y]
            q, p = np.empty((len(y), DIMENSIONS + 1), np.float32), np.empty(len(y))
            for b in range(0, len(y), step := max(1, SCORES_AT_ONCE // len(classes))):
                part = slice(b, min(b + step, len(y)))
                q[part] = self.predicted(ctx[part])[0]
                p[part] = log_softmax(q[part], classes, kind[part])
            order = np.argsort(kind.astype(u.small), kind="stable")
            ends = np.cumsum(np.bincount(kind, minlength=len(u.alone)))
            for k in np.flatnonzero((np.diff(ends, prepend=0) > 0) & ~u.alone):
                take = order[ends[k - 1] if k else 0 : ends[k]]
                span = slice(u.first[k], u.first[k + 1])
                step = max(1, SCORES_AT_ONCE // (span.stop - span.start))
                for b in range(0, len(take), step):
                    part = take[b : b + step]
                    p[part] += log_softmax(q.take(part, axis=0), inner[span], y[part] - span.start)
            out[a : a + SCORED_AT_ONCE] = p
        return out / np.log(10)

    def train(self, context: np.ndarray, units: np.ndarray, seed: int) -> None:
        r = np.random.default_rng(seed)
        order = r.permutation(len(units))
        u = self.units
        log_class = np.log(u.class_mass * NOISE).astype(np.float32)
        log_inner = np.log(u.mass / u.class_mass[u.of] * INNER_NOISE).astype(np.float32)
        class_ends = np.cumsum(u.class_mass)
        given_rows, inner_rows, class_rows, weight_rows = np.split(np.arange(len(self.rows)), self.cuts)
        for a in range(0, len(order), MINIBATCH):
            take = order[a : a + MINIBATCH]
            ctx, y = context[take], units[take]
            kind = u.of[y]
            _, inner, classes, _ = self.tables()
            q, held = self.predicted(ctx)
            # the class, against noise that the minibatch shares
            drawn = np.minimum(np.searchsorted(class_ends, r.random(NOISE) * class_ends[-1]), len(classes) - 1)
            t = classes.take(kind, axis=0)
            g_true = (1 - _sigmoid(np.einsum("nd,nd->n", q, t) - log_class[kind]))[:, None]
            noise = classes[drawn]
            g_false = -_sigmoid(q @ noise.T - log_class[drawn])
            g_q = g_true * t + g_false @ noise
            g_class = _sum_rows(kind.astype(u.small), g_true * q)
            g_noise = _sum_rows(drawn.astype(u.small), g_false.T @ q)
            # the unit inside its class, against noise of its own
            some = np.flatnonzero(~u.alone[kind])
            if len(some):
                first, end = u.first.take(kind[some])[:, None], u.first.take(kind[some] + 1)[:, None]
                lo, hi = u.before.take(first), u.before.take(end)
                other = u.at(lo + r.random((len(some), INNER_NOISE)) * (hi - lo))
                at = np.concatenate([y[some][:, None], np.minimum(np.maximum(other, first), end - 1)], axis=1)
                vectors, qs = inner.take(at, axis=0), q.take(some, axis=0)
                g = -_sigmoid(np.einsum("nd,njd->nj", qs, vectors) - log_inner.take(at))
                g[:, 0] += 1
                g_q[some] += np.einsum("nj,njd->nd", g, vectors)
                self.step(inner_rows, *_sum_rows(at.ravel().astype(u.small), lambda o: qs.take(o // (INNER_NOISE + 1), axis=0) * g.take(o)[:, None]), len(take))
            g_weight = np.zeros((CONTEXT, DIMENSIONS + 1), np.float32)
            for i in range(CONTEXT):
                g_weight[i, :-1] = np.einsum("nd,nd->d", g_q[:, :-1], held[:, i, :-1])
            both = _sum_rows(np.concatenate([g_class[0], g_noise[0]]), np.concatenate([g_class[1], g_noise[1]]), np.concatenate([g_class[2], g_noise[2]]))
            self.step(class_rows, *both, len(take))
            by_place, g_q = np.split(self.rows, self.cuts)[3][:, :-1].copy(), g_q[:, :-1].copy()
            at, g_given, many = _sum_rows(ctx.ravel(), lambda o: g_q.take(o // CONTEXT, axis=0) * by_place.take(o % CONTEXT, axis=0))
            self.step(given_rows, at, np.pad(g_given, ((0, 0), (0, 1))), many, len(take))
            self.step(weight_rows, np.arange(CONTEXT), g_weight, np.full(CONTEXT, len(take)), len(take))

    def step(self, rows: np.ndarray, at: np.ndarray, gradient: np.ndarray, tokens: np.ndarray, size: int) -> None:
        at = rows[at]
        gradient = gradient / np.float32(size)
        squares = self.squares.take(at, axis=0)
        squares += gradient * gradient
        self.squares[at] = squares
        gradient *= RATE
        gradient /= np.sqrt(squares, out=squares)
        self.rows[at] += gradient
        self.touched[at] += tokens


def log_softmax(q: np.ndarray, vectors: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Natural logarithms of the normalised probabilities of one row of ``vectors`` for each ``q``."""
    scores = q @ vectors.T
    right = scores[np.arange(len(q)), at].astype(np.float64)
    if len(q) and np.einsum("nd,nd->n", q, q).max() * np.einsum("nd,nd->n", vectors, vectors).max() >= 60 * 60:  # else exp cannot overflow
        most = scores.max(axis=1, keepdims=True)
        scores -= most
        right -= most[:, 0]
    return right - np.log(np.exp(scores, out=scores) @ np.ones(len(vectors), np.float32))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x = np.clip(x, -30, 30)
    np.exp(np.negative(x, out=x), out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _sum_rows(at: np.ndarray, rows: np.ndarray | Callable, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct indices, the sums of their rows, and how many rows (or the sum of ``counts``) each has.
    ``rows`` may be a function that makes the rows in a given order."""
    order = np.argsort(at, kind="stable")
    sorted_at = at[order]
    starts = np.flatnonzero(np.append(True, sorted_at[1:] != sorted_at[:-1]))
    many = np.diff(np.append(starts, len(at))) if counts is None else np.add.reduceat(counts[order], starts)
    taken = rows(order) if callable(rows) else rows.take(order, axis=0)
    return sorted_at[starts].astype(np.int64), np.add.reduceat(taken, starts, axis=0), many


def _classify(total: int, distinct: int):
    """Join a batch's documents with what the corpus knows of its words."""

    def run(docs: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        place = words["place"].to_numpy()
        size = int(place.max() >> 32) + 1
        count, unit = np.zeros(size), np.zeros(size, np.int32)
        count[place >> 32], unit[place >> 32] = words["c"], place & ((1 << 32) - 1)
        share = np.log10(count + SMOOTHING)
        rows = []
        for x in docs.itertuples(index=False):
            at = unpack(x.indices)
            rows.append((x.batch, x.doc_id, x.held_out, len(at), int((count[at] > 0).sum()), float(share[at].sum()), pack(unit[at])))
        out = pd.DataFrame(rows, columns=["batch", "doc_id", "held_out", "n_tokens", "n_known", "log_counts", "units"])
        out["base_score"] = out["log_counts"] - out["n_tokens"] * np.log10(total + SMOOTHING * (distinct + 1))
        return out

    return run


def _examples(packed: list[bytes], units: Units) -> tuple[np.ndarray, np.ndarray]:
    each = [unpack(x).astype(units.small) for x in packed]
    if not each:
        return np.empty((0, CONTEXT), units.small), np.empty(0, units.small)
    return np.concatenate([LogBilinear.contexts(x, len(units)) for x in each]), np.concatenate(each)


def _train(units: Units, start: np.ndarray):
    """The documents of a part train a copy of the first model; its rows by the tokens that touched them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LogBilinear(units, start)
        for i, batch in enumerate(slices(batches, 0, SLICE_TOKENS)):
            model.train(*_examples(batch.column(0).to_pylist(), units), seed=i)
        at = np.flatnonzero(model.touched)
        moved = (model.rows[at] - start[at]).astype(np.float64) * model.touched[at][:, None]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(model.touched[at]), *map(pa.array, np.ascontiguousarray(moved.T))], names=["at", "w", *MOVED])

    return run


#: Columns of a row's summed movement.
MOVED = [f"v{i}" for i in range(DIMENSIONS + 1)]


def _score(units: Units, rows: np.ndarray, log_mass: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LogBilinear(units, rows)
        for batch in slices(batches, packed, SLICE_TOKENS):
            held = batch.column(packed).to_pylist()
            context, y = _examples(held, units)
            each = model.log10(context, y) - log_mass[y]
            starts = np.cumsum([0, *(int.from_bytes(x[:4], "little") for x in held)])[:-1]
            # sums by document (each has its end token), then the words' shares of their units
            score = np.add.reduceat(each, starts) + np.asarray(batch.column(packed + 1), np.float64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:packed], pa.array(score)], names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    packed = 5
    return run


def language_scores(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document row: ``doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score`` (log10 probabilities of the whole text with its end token)."""
    spark = docs.sparkSession
    kind = docs.schema[id_column].dataType.simpleString()
    source = text_input(docs, F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    tokens = staged(source.mapInArrow(_tokenise, f"batch bigint, doc_id {kind}, held_out boolean, indices binary, at int, word binary, n bigint"), "lm-tokens")
    listed = tokens.where("word IS NOT NULL").select("batch", "at", "word", "n")
    counts = staged(listed.groupBy("word").agg(F.sum("n").alias("c")), "lm-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.sum((F.col("c") > 0).cast("long"))).first()
    total, distinct = int(total), int(distinct or 0)

    # Bounded by PER_ROOT * sqrt(total): the words that are units of their own.
    least = max(1.0, math.sqrt(total) / PER_ROOT)
    is_own = (F.col("word") == F.lit(END)) | (F.col("c") >= least)
    bucket = F.pmod(F.xxhash64(F.substring("word", -3, 3)), F.lit(BUCKETS)).cast("int")
    named = [(bytes(r["word"]), None, r["c"] + SMOOTHING) for r in counts.where(is_own).collect()]
    shared = {r["b"]: r["m"] for r in counts.where(~is_own & (F.col("c") > 0)).groupBy(bucket.alias("b")).agg((F.sum("c") + F.count("*") * SMOOTHING).alias("m")).collect()}
    named += [(None, b, shared.get(b, 0.0) + SMOOTHING) for b in range(BUCKETS)]  # with the share of a word that training has not seen
    named.sort(key=lambda x: (-x[2], x[0] or b"", -1 if x[1] is None else x[1]))
    mass = np.array([x[2] for x in named])
    units, log_mass = Units(mass), np.log10(mass)
    own = spark.createDataFrame([(bytearray(w), i) for i, (w, _, _) in enumerate(named) if w is not None] or [(bytearray(b"\n\n"), 0)], "own binary, own_unit int")
    of_bucket = F.array(*(F.lit(i) for _, i in sorted((b, i) for i, (_, b, _) in enumerate(named) if b is not None)))
    known = staged(
        counts.join(F.broadcast(own), F.col("word") == F.col("own"), "left").select("word", "c", F.coalesce("own_unit", F.element_at(of_bucket, bucket + 1)).alias("unit")),
        "lm-units",
    )

    # Every batch's first word is its end token. A task gets about two batches.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), listed.where("at = 0").count() // 2)
    # Each word is once in ``known``, and parts grow with the batches: a part's words fit in memory,
    # and the many rows of ``listed`` need no sort.
    placed = listed.select("batch", "at", "word").repartition(parts, "word").join(known.repartition(parts, "word").hint("shuffle_hash"), "word").select(F.col("batch").alias("word_batch"), (F.shiftleft(F.col("at").cast("long"), 32) + F.col("unit")).alias("place"), "c")
    texts = tokens.where("indices IS NOT NULL").select("batch", "doc_id", "held_out", "indices")
    scored_columns = f"batch bigint, doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, log_counts double, units binary, base_score double"
    classified = staged(
        texts.repartition(parts, "batch").groupBy("batch").cogroup(placed.repartition(parts, "word_batch").groupBy("word_batch")).applyInPandas(_classify(total, distinct), scored_columns),
        "lm-classified",
    )
    discard(tokens, counts, known)

    train = classified.where("NOT held_out").select("units", F.xxhash64("doc_id", "units").alias("h"), "doc_id")
    share = WARM_TOKENS / max(1, total)
    few, seen = [], 0
    for r in train.where(F.pmod("h", F.lit(1 << 30)) < int(share * (1 << 30)) + 1).orderBy("h", "doc_id").toLocalIterator():
        few.append(bytes(r["units"]))
        seen += int.from_bytes(few[-1][:4], "little")
        if seen >= WARM_TOKENS:
            break
    warm = LogBilinear(units)
    context, y = _examples(few, units)
    for epoch in range(-(-WARM_STEPS // max(1, -(-len(y) // MINIBATCH))) if len(y) else 0):
        warm.train(context, y, seed=epoch)
    start = warm.rows
    dealt = train.repartition(total // PART_TOKENS + 1, "h").sortWithinPartitions("h", "doc_id")
    moves = text_input(dealt, "units").mapInArrow(_train(units, start), "at bigint, w double" + "".join(f", {c} double" for c in MOVED))
    rows = start.copy()
    for r in moves.groupBy("at").agg(F.sum("w").alias("w"), *(F.sum(c).alias(c) for c in MOVED)).toLocalIterator():
        rows[r["at"]] += np.array(r[2:]) / r["w"]

    columns = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "units", "log_counts"]
    scored = text_input(classified, *columns).mapInArrow(
        _score(units, rows, log_mass), f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    )
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")

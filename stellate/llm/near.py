"""Near duplicates: one-permutation MinHash, banded buckets, star-shaped candidate edges.

Method.

1. *Signatures.* The distinct five-word shingles of a document are hashed once to 64 bits.
   The hash range is cut into ``BANDS * ROWS`` bins; a bin's value is its least hash. An
   empty bin takes the value of the non-empty bin that comes first in that bin's own random
   order of bins (optimal densification), so equal sets agree and unequal ones agree in each
   bin with a probability of their similarity.
2. *Classes.* Documents with the same shingle set are one class, under its least ``doc_id``.
3. *Buckets.* ``ROWS`` bins make a band, and a band's value a bucket. At a similarity of
   0.75 a pair shares no bucket with probability (1 - 0.75^5)^48 = 2.3e-6.
4. *Stars.* Of the classes that share a bucket, one whose shingles are its own (no other of
   these classes has them) to more than a quarter can be like none, and leaves. The same
   counts bound the similarity of any two from above. A bucket's hub is the class that
   meets the most others in its buckets, and every class is compared with the best of its
   hubs that the bounds admit. Then, where a bucket still holds classes of different
   components, those outside its main component (unless the bounds rule out all others)
   become hubs and are compared with the bucket's classes of other components, blocks of
   hubs with blocks of members and without a row for a pair. About ``HUBS`` of them go
   first, because their links spare others the work, then ``GROWTH`` times as many each
   round, so a million outsiders take five rounds. When all of them have been hubs, all
   pairs across components have been compared: no link is lost to the star shape, and pairs
   inside a component, which could not change it, are never made.
5. *Verification* of every candidate on the full sets (64-bit shingle hashes).
6. *Components* by label propagation with pointer jumping, all in DataFrames.

Scale. Buckets, hubs, links and labels are only joined and grouped; nothing is collected.
Exact copies vanish in step 2 by partial aggregation; a hub of a third of all rows has one
edge for each row; hot joins are inner sort-merge joins, which AQE splits. Texts are read a
second time only for classes that share a bucket, which keeps full sets off the disk for
all others.

Edge cases: null text, no words: no shingles, linked with nothing, a component of its own;
fewer than five words: the whole sequence is the one shingle; rows that repeat a ``doc_id``
are judged row by row, and classes with the same least ``doc_id`` are one node; a null
``doc_id`` is never linked and stays; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import discard, lists, mix64, slices, staged, text_input, text_print

WORDS_PER_SHINGLE, BANDS, ROWS = 5, 48, 5
#: Hubs of a bucket in the first of the later rounds, and how their number grows.
HUBS, GROWTH = 256, 8
#: Shingles of the hubs, and of the members, that one block holds.
BLOCK_SHINGLES = 400_000
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Bytes of text hashed at once.
SLICE = 1 << 20


class Shingler:
    """Shingle sets and signatures of texts, in numpy over the bytes of many texts at once."""

    BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])

    def __init__(self, bands: int = BANDS, rows: int = ROWS):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        # every bin's own random order of all bins, as priorities
        self.order = np.random.default_rng(7).permuted(np.tile(np.arange(self.bins, dtype=np.int16), (self.bins, 1)), axis=1)
        odd = lambda first, n: mix64(np.arange(first, first + n, dtype=np.uint64)) | np.uint64(1)
        self.factors, self.band_factors = odd(1, WORDS_PER_SHINGLE), odd(101, rows)
        self.band_salt = odd(1001, bands)
        self.letters = odd(2001, 256)
        self.base = int(odd(3001, 1)[0])
        self.powers = self.inverse = np.empty(0, np.uint64)

    def _extend(self, n: int) -> None:
        if len(self.powers) < n:
            def step(factor: int) -> np.ndarray:
                out = np.full(n, factor, np.uint64)
                out[0] = 1
                return np.cumprod(out)

            self.powers, self.inverse = step(self.base), step(pow(self.base, -1, 1 << 64))

    def word_hashes(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """64-bit hashes of all words in order, and the number of words of each text.

        A word's hash is the polynomial of its bytes, from one running sum over all bytes.
        """
        coded = [(t or "").encode().lower() for t in texts]
        raw = np.frombuffer(b"\n".join(coded) + b"\n", np.uint8)
        self._extend(len(raw) + 1)
        blank = self.BLANK[raw]
        edge = np.flatnonzero(np.diff(blank, prepend=True))
        start, end = edge[::2], edge[1::2]
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.letters[raw] * self.powers[: len(raw)])])
        hashes = mix64((total[end] - total[start]) * self.inverse[start] + (end - start).astype(np.uint64))
        ends = np.cumsum([len(c) + 1 for c in coded])
        upto = np.searchsorted(start, ends)
        return hashes, np.diff(upto, prepend=0)

    def shingle_sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """For each text the sorted distinct 64-bit hashes of its shingles."""
        hashes, counts = self.word_hashes(texts)
        k = WORDS_PER_SHINGLE
        rolled = np.zeros(max(0, len(hashes) - k + 1), np.uint64)
        for i in range(k):
            rolled += hashes[i : len(hashes) - k + 1 + i] * self.factors[i]
        rolled = mix64(rolled + np.uint64(k))
        out, at = [], 0
        for n in counts.tolist():
            if n >= k:
                own = np.sort(rolled[at : at + n - k + 1])
                out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
            elif n:
                out.append(mix64(np.array([(hashes[at : at + n] * self.factors[:n]).sum(dtype=np.uint64) + np.uint64(n)])))
            else:
                out.append(np.empty(0, np.uint64))
            at += n
        return out

    def band_values(self, hashes: np.ndarray) -> np.ndarray:
        bins = ((hashes >> np.uint64(32)) * np.uint64(self.bins)) >> np.uint64(32)
        filled, first = np.unique(bins.astype(np.int64), return_index=True)
        signature = np.zeros(self.bins, np.uint64)
        signature[filled] = hashes[first]
        if len(filled) < self.bins:
            empty = np.ones(self.bins, bool)
            empty[filled] = False
            take = self.order[np.flatnonzero(empty)][:, filled].argmin(axis=1)
            signature[empty] = hashes[first][take]
        bands = (mix64(signature).reshape(self.bands, self.rows) * self.band_factors).sum(axis=1, dtype=np.uint64)
        return mix64(bands + self.band_salt).astype(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler = Shingler()
    for batch in slices(batches, 1, SLICE):
        sets = shingler.shingle_sets(batch.column(1).to_pylist())
        bands = [shingler.band_values(s) if len(s) else np.empty(0, np.int64) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                lists(np.concatenate(bands), [len(b) for b in bands]),
                batch.column(2),
            ],
            names=["doc_id", "n_shingles", "set_key", "bands", "print"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler = Shingler()
    for batch in slices(batches, 1, SLICE):
        sets = [s.astype(np.int64) for s in shingler.shingle_sets(batch.column(1).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), lists(np.concatenate(sets), [len(s) for s in sets])], names=["cid", "items"])


def components(links: DataFrame, name: str) -> DataFrame:
    """``node, comp`` (least node reachable) for every node of ``links (a, b)``.

    Each round a node takes the least label around it, then the label of that label; rounds
    grow with the logarithm of the longest chain. Every round is a staged table.
    """
    back = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    ends = links.select("a", "b").union(back)
    both = staged(ends.union(ends.select("a", F.col("a").alias("b"))).distinct(), f"{name}-both")  # each node beside itself
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("comp")), f"{name}-labels")
    state = F.sum(F.xxhash64("node", "comp").cast("decimal(38,0)"))
    before = labels.agg(state).first()[0]
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("hop"))
        jump = labels.select(F.col("node").alias("hop"), F.col("comp").alias("next"))
        new = staged(near.join(jump, "hop").select("node", F.least("hop", "next").alias("comp")), f"{name}-labels")
        discard(labels)
        labels, after = new, new.agg(state).first()[0]
        if after == before:
            discard(both)
            return labels
        before = after


def _compare(percent: int):
    """The links between a block's hubs and members of other components."""

    def run(hubs: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(hubs) and len(members):
            members = members.rename(columns=lambda c: c.removesuffix("_2")).sort_values("n", kind="stable")
            size, most, comp, cid = (members[c].to_numpy() for c in ("n", "m", "comp", "cid"))
            lists_, ends = members["items"].to_list(), np.cumsum(members["items"].map(len).to_numpy())
            flat = np.concatenate(lists_)
            for h in hubs.itertuples(index=False):
                able = (comp != h.comp) & ((100 + percent) * np.minimum(most, h.m) >= percent * (size + h.n))
                if not able.any():
                    continue
                a, b = np.flatnonzero(able)[[0, -1]]  # sizes are sorted, so these lie close
                start = ends[a - 1] if a else 0
                own = np.sort(h.items)
                at = np.minimum(np.searchsorted(own, piece := flat[start : ends[b]]), len(own) - 1)
                both = np.add.reduceat((own[at] == piece).astype(np.int64), np.concatenate([[0], ends[a:b] - start]))
                like = able[a : b + 1] & (100 * both >= percent * (size[a : b + 1] + h.n - both))
                out += [(min(h.cid, c), max(h.cid, c)) for c in cid[a : b + 1][like]]
        return pd.DataFrame(out, columns=["a", "b"])

    return run


def possible(n1: Column, m1: Column, n2: Column, m2: Column, percent: int = PERCENT) -> Column:
    """Whether two sets of those sizes can be alike when at most ``m1`` and ``m2`` of their
    items can be shared."""
    return (100 + percent) * F.least(m1, m2) >= percent * (n1 + n2)


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (``a, b``) whose full sets are similar enough."""
    left, right = (sets.select(F.col("cid").alias(c), F.col("items").alias(f"items_{c}")) for c in ("a", "b"))
    both, total = F.size(F.array_intersect("items_a", "items_b")), F.size("items_a") + F.size("items_b")
    return pairs.join(left, "a").join(right, "b").where((100 + percent) * both >= percent * total).select("a", "b").distinct()


def shareable(sets: DataFrame) -> DataFrame:
    """``cid, n, m``: the size of each set, and how many of its items any other set has."""
    single = sets.select("cid", F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("c"), F.min("cid").alias("cid")).where("c = 1").groupBy("cid").agg(F.count("*").alias("own"))
    size = sets.groupBy("cid").agg(F.min(F.size("items")).cast("long").alias("n"), F.max(F.size("items")).cast("long").alias("most"), F.count("*").alias("rows"))
    # of a repeated doc_id with several sets nothing is ruled out
    m = F.when(F.col("rows") > 1, F.col("most")).otherwise(F.col("n") - F.coalesce("own", F.lit(0)))
    return size.join(single, "cid", "left").select("cid", "n", m.alias("m"))


def near_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept, print``."""
    kind = docs.schema[id_column].dataType.simpleString()
    source = text_input(docs, F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"), text_print(F.col(text_column)).alias("print"))
    signed = staged(source.mapInArrow(_signatures, f"doc_id {kind}, n_shingles bigint, set_key binary, bands array<bigint>, print bigint"), "near-signed")
    linkable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = staged(linkable.groupBy("set_key").agg(F.min("doc_id").alias("cid"), F.first("bands").alias("bands")), "near-classes")

    members = classes.select("cid", F.explode("bands").alias("bucket"))
    crowded = lambda df: df.groupBy("bucket").agg(F.count("*").alias("crowd")).where("crowd > 1")
    met = staged(members.join(crowded(members).hint("merge"), "bucket").select("bucket", "cid"), "near-met")
    sets = staged(
        source.where("doc_id IS NOT NULL").join(met.select(F.col("cid").alias("doc_id")).distinct().hint("merge"), "doc_id", "left_semi")
        .select("doc_id", "text").mapInArrow(_sets, f"cid {kind}, items array<bigint>"),
        "near-sets",
    )
    able = shareable(sets).where(100 * F.col("m") >= PERCENT * F.col("n"))
    shared = staged(met.join(able.hint("merge"), "cid"), "near-shared")
    fame = shared.join(crowded(shared), "bucket").groupBy("cid").agg(F.sum("crowd").alias("fame"))
    known = staged(shared.join(fame, "cid"), "near-known")
    discard(met, shared)

    hubs = known.groupBy("bucket").agg(F.max(F.struct("fame", "cid", "n", "m")).alias("top"))
    best = (
        known.join(hubs, "bucket").where((F.col("cid") != F.col("top.cid")) & possible(F.col("n"), F.col("m"), F.col("top.n"), F.col("top.m")))
        .groupBy("cid").agg(F.max("top").alias("top"))
    )
    links = staged(verified(best.select(F.least("cid", "top.cid").alias("a"), F.greatest("cid", "top.cid").alias("b")).distinct(), sets), "near-links")
    labels = components(links, "near")
    used: DataFrame | None = None
    turn, more = 0, True
    blocks_of = lambda total: F.ceil(total / BLOCK_SHINGLES).cast("int")
    block_in = lambda blocks: F.pmod(F.xxhash64("cid"), blocks).cast("int")
    while more:
        placed = known.join(labels.select(F.col("node").alias("cid"), "comp"), "cid", "left").select("bucket", "cid", "n", "m", F.coalesce("comp", "cid").alias("comp"))
        mixed = (
            placed.groupBy("bucket", "comp").agg(F.count("*").alias("k"), F.min("n").alias("least"), F.max(F.col("m") > F.col("n")).alias("loose"), F.sum("n").alias("total"))
            .groupBy("bucket").agg(F.max(F.struct("k", "comp")).alias("main"), F.min("least").alias("least"), F.max("loose").alias("loose"), F.sum("total").alias("total"), F.count("*").alias("comps")).where("comps > 1")
        )
        open_ = placed.join(mixed, "bucket").select("bucket", "cid", "n", "m", "comp", F.col("main.comp").alias("main"), "least", "loose", blocks_of(F.col("total")).alias("blocks"))
        peer = F.greatest("least", "m")  # the size that could be most alike, where no repeated doc_id has m > n
        outside = open_.where((F.col("comp") != F.col("main")) & (F.col("loose") | possible(F.col("n"), F.col("m"), peer, peer)))
        if used is not None:
            outside = outside.join(used, ["bucket", "cid"], "left_anti")
        outside = staged(outside.select("bucket", "cid", "n", "m", "comp", "blocks"), "near-outside")
        # by hash, a share of each bucket's outsiders that makes the round's number of hubs
        draw = F.pmod(F.xxhash64("cid", F.lit(turn)), F.lit(1 << 30)) / F.lit(1 << 30)
        waiting = outside.groupBy("bucket").agg((F.lit(HUBS * GROWTH**turn) / F.count("*")).alias("share"))
        chosen = staged(outside.join(waiting, "bucket").where(draw < F.col("share")).drop("share"), "near-hubs")
        more = not waiting.where("share < 1").isEmpty()
        discard(outside)
        turn += 1
        if chosen.isEmpty():
            discard(chosen)
            continue
        turns = chosen.groupBy("bucket").agg(F.min("blocks").alias("blocks"), blocks_of(F.sum("n")).alias("hub_blocks"))
        every = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
        centres = chosen.drop("blocks").join(turns, "bucket").join(sets, "cid").withColumn("hub_block", block_in(F.col("hub_blocks"))).withColumn("block", every("blocks"))
        others = placed.join(turns, "bucket").join(sets, "cid").withColumn("block", block_in(F.col("blocks"))).withColumn("hub_block", every("hub_blocks"))
        columns = ["bucket", "hub_block", "block", "cid", "n", "m", "comp", "items"]
        found = staged(
            centres.select(columns).groupBy("bucket", "hub_block", "block")
            .cogroup(others.select([F.col(c).alias(f"{c}_2") for c in columns]).groupBy("bucket_2", "hub_block_2", "block_2"))
            .applyInPandas(_compare(PERCENT), f"a {kind}, b {kind}").distinct(),
            "near-found",
        )
        used_now = staged(chosen.select("bucket", "cid") if used is None else used.union(chosen.select("bucket", "cid")), "near-used")
        discard(chosen, *([used] if used is not None else []))
        used = used_now
        if not found.isEmpty():
            joined = staged(links.union(found), "near-links")
            discard(links, labels)
            links, labels = joined, components(joined, "near")
        discard(found)
    discard(known, sets, links, *([used] if used is not None else []))

    by_class = classes.select("set_key", "cid").join(labels.select(F.col("node").alias("cid"), "comp"), "cid", "left")
    out = signed.drop("bands").join(by_class.select("set_key", F.coalesce("comp", "cid").alias("comp")), "set_key", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("comp", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), "print")

"""Benchmark decontamination: a prefix-filtered set join with exact verification.

Only DataFrame functions. Items and documents are word sequences; a window is ``WINDOW``
consecutive item words (a shorter item is one window). A window occurs in a document only
if each of its shingles does, so its rarest shingle is a *necessary prefix token*:

1. Count, over all documents, the shingles of ``SHINGLE`` words that any item has (an item
   with fewer words is one shingle). Windows with a shingle that no document has are gone
   already.
2. Order the shingles of each window by rarity and take the first as its anchor (leftmost of
   equals). Neighbouring windows with one anchor are one *run*: an item-sized segment of at
   most ``2 * WINDOW - SHINGLE`` words.
3. Join the documents' shingles to the anchors: one candidate for an occurrence and a run.
   *Positional and length bounds*: the document must reach far enough to both sides of the
   occurrence for one whole window of the run.
4. Verify: around the occurrence, the document's words are compared with the segment, and
   the stretch of equal words that holds the anchor is hit if a window fits into it.
   (Every window of the run holds the anchor, so it occurs exactly if it lies in there.)

Scale. Shingles are joined by 64-bit hashes, without their text. The small tables (item
shingles, anchors) are staged, so Spark knows their size: below the session's broadcast limit
they are broadcast, above it the joins shuffle and AQE splits hot shingles. Candidates are
gathered by stretches of a document, at most ``STRETCHES`` of them and ``STRETCH`` words or
more in each, so that a long document of common words is many rows of moderate size; only
hits are gathered by document. Texts move once.

Words are hashed by ``lower`` and compared exactly after the rule's A-Z lowering (equal
words have equal ``lower``, and a collision of hashes only adds a candidate).

Edge cases: null text has no words; a null or wordless item has no window; rows that repeat
a ``doc_id`` are judged by their own text; repeated items and repeated item ids count once;
an empty table of either kind gives no hits; other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import discard, staged, text_print

WINDOW = 10
#: Words of a shingle, the join's token. Among common words three in a row are rare already.
SHINGLE = 3
#: Words of a stretch of a document, at least, and stretches of a document, at most.
STRETCH, STRETCHES = 256, 64
#: Fixed value: what separates words, before A-Z are lowered.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def split_words(text: Column) -> Column:
    """Words between separators; the first and last may be empty."""
    return F.split(F.coalesce(text.cast("string"), F.lit("")), SEPARATORS)


def lower_az(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def shingles(words: DataFrame, sizes: list[int], *carried: str) -> DataFrame:
    """``carried`` columns, ``pos`` and ``key`` of every shingle of ``words`` in these sizes."""
    lowered = words.select(*carried, F.transform("words", F.lower).alias("__w"))
    places = [F.col("__w")] + [F.slice("__w", k + 1, F.size("__w")) for k in range(1, max(sizes))]
    zipped = F.arrays_zip(*[p.alias(f"w{k}") for k, p in enumerate(places)])
    rows = lowered.select(*carried, F.posexplode(zipped).alias("pos", "__z"))
    part = lambda k: F.col(f"__z.w{k}")
    keys = [F.when(part(n - 1).isNotNull(), F.xxhash64(*[part(k) for k in range(n)])) for n in sizes]
    key = keys[0] if len(keys) == 1 else F.explode(F.array(*keys))
    return rows.select(*carried, "pos", key.alias("key")).where("key IS NOT NULL")


def runs(items: DataFrame, counts: DataFrame, window: int, sizes: list[int]) -> DataFrame:
    """``key, item_id, segment, at, last, width``: the runs of all items.

    ``at`` is the index of the anchor's first word in the segment; the run's windows start at
    segment indices ``0`` to ``last``.
    """
    ranked = None
    for n in sizes:  # an item has shingles of one size
        own = items.where(F.least(F.size("words"), F.lit(SHINGLE)) == n)
        known = shingles(own, [n], "item_id", "words").join(counts, "key", "left").select("item_id", "words", "pos", "key", F.coalesce("n", F.lit(0)).alias("n"))
        one = known.groupBy("item_id", "words").agg(F.array_sort(F.collect_list(F.struct("pos", "n", "key"))).alias("ranks")).withColumn("size", F.lit(n))
        ranked = one if ranked is None else ranked.unionByName(one)
    width = F.least(F.size("words"), F.lit(window))
    starts = ranked.select("item_id", "words", "ranks", "size", width.alias("width"), F.explode(F.sequence(F.lit(0), F.size("words") - width)).alias("start"))
    inside = F.slice("ranks", F.col("start") + 1, F.col("width") - F.col("size") + 1)
    rarest = F.array_min(F.transform(inside, lambda r: F.struct(r["n"].alias("n"), r["pos"].alias("pos"), r["key"].alias("key"))))
    anchored = starts.withColumn("rarest", rarest).where("rarest.n > 0")
    grouped = anchored.groupBy("item_id", "words", "width", F.col("rarest.pos").alias("pos"), F.col("rarest.key").alias("key")).agg(F.min("start").alias("a"), F.max("start").alias("b"))
    return grouped.select(
        "key",
        "item_id",
        F.expr("slice(words, a + 1, b - a + width)").alias("segment"),
        (F.col("pos") - F.col("a")).alias("at"),
        (F.col("b") - F.col("a")).alias("last"),
        "width",
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
    id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text_column: str = "text",
) -> DataFrame:
    """One row per document row: ``doc_id, print, n_words, n_hit, item_ids, spans``.

    ``item_ids`` are the sorted ids, as strings, of items with an occurring window;
    ``spans`` the hit stretches as (first word, last word, item id), words counted from 0.
    """
    items = staged(
        benchmark.select(F.col(item_column).cast("string").alias("item_id"), F.filter(split_words(lower_az(F.col(item_text_column))), lambda w: w != "").alias("words"))
        .where(F.size("words") > 0).distinct(),
        "leak-items",
    )
    sizes = sorted(r[0] for r in items.select(F.least(F.size("words"), F.lit(SHINGLE))).distinct().collect()) or [SHINGLE]
    vocabulary = staged(shingles(items, sizes, "item_id").select("key").distinct(), "leak-shingles")
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    source = docs.select(F.col(id_column).alias("doc_id"), text_print(F.col(text_column)).alias("print"), text.alias("text"))
    split = split_words(F.col("text"))
    counts = staged(
        shingles(source.select(split.alias("words")), sizes).select("key").join(vocabulary, "key").groupBy("key").agg(F.count("*").alias("n")),
        "leak-counts",
    )
    anchors = staged(runs(items, counts, window, sizes), "leak-anchors")
    discard(vocabulary, counts)

    # Split first, count and explode above it: the text must not travel with each shingle.
    arrays = source.select("doc_id", "print", split.alias("words")).select("doc_id", "print", F.size("words").alias("n"), "words")
    stretch = F.floor(F.col("pos") / F.greatest(F.lit(STRETCH), F.ceil(F.col("n") / F.lit(STRETCHES)))).alias("stretch")
    candidates = (
        shingles(arrays, sizes, "doc_id", "print", "n").join(anchors, "key")
        .where("pos + last >= at AND pos - at + width <= n")
        .groupBy("doc_id", "print", stretch).agg(F.collect_set(F.struct("pos", "at", "last", "width", "item_id", "segment")).alias("candidates"))
    )
    # Candidates and hits grow with the documents: joined by sort-merge at every size.
    found_candidates = staged(candidates, "leak-candidates")
    candidates = found_candidates.hint("merge")

    # Stretch of equal words around the anchor: from the last difference before it to the first after it.
    held = candidates.select(F.col("doc_id").alias("c_id"), F.col("print").alias("c_print"), "candidates")
    found = source.join(held, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("print") == F.col("c_print"))).select(
        "doc_id", "print", "candidates", split_words(lower_az(F.col("text"))).alias("words")
    )
    spans = F.expr("""
        transform(
            transform(candidates, c -> named_struct(
                'shift', c.pos - c.at, 'width', c.width, 'item_id', c.item_id, 'size', size(c.segment), 'at', c.at,
                'differ', filter(sequence(0, size(c.segment) - 1),
                                 k -> NOT coalesce(get(words, c.pos - c.at + k) = get(c.segment, k), false)))),
            c -> named_struct(
                'a', c.shift + coalesce(array_max(filter(c.differ, k -> k < c.at)) + 1, 0),
                'b', c.shift + coalesce(array_min(filter(c.differ, k -> k >= c.at)) - 1, c.size - 1),
                'item_id', c.item_id, 'width', c.width))
    """)
    hits = found.select("doc_id", "print", F.get("words", F.lit(0)).alias("head"), spans.alias("spans"))
    # A row here is a stretch of a document; what is no hit ends here.
    hits = hits.select("doc_id", "print", F.expr("array_distinct(filter(spans, s -> s.b - s.a + 1 >= s.width))").alias("spans"), F.when(F.col("head") == "", 1).otherwise(0).alias("skip"))
    hits = hits.groupBy("doc_id", "print", "skip").agg(F.flatten(F.collect_set(F.when(F.size("spans") > 0, F.col("spans")))).alias("spans"))
    hits = hits.select(
        F.col("doc_id").alias("hit_id"), F.col("print").alias("hit_print"),
        F.size(F.array_distinct(F.flatten(F.expr("transform(spans, s -> sequence(s.a, s.b))")))).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.expr("transform(spans, s -> s.item_id)"))).alias("item_ids"),
        F.expr("array_distinct(transform(spans, s -> named_struct('first', s.a - skip, 'last', s.b - skip, 'item_id', s.item_id)))").alias("spans"),
    )
    # The filter stands above the aggregate: below, it would be pushed into the join with
    # the split words inlined in its lambdas, and split the text again for each of them.
    found_hits = staged(hits.where("n_hit > 0"), "leak-hits")
    hits = found_hits.hint("merge")
    discard(found_candidates, anchors, items)

    size = F.size(split_words(F.col("text")))
    empties = F.when(F.col("text").rlike("^" + SEPARATORS) | (F.col("text") == ""), 1).otherwise(0) + F.when(F.col("text").rlike(SEPARATORS[:-1] + r"\z"), 1).otherwise(0)
    n_words = F.when(F.col("text").rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"), size - empties).otherwise(0)
    counted = source.select("doc_id", "print", n_words.cast("long").alias("n_words"))
    joined = counted.join(hits, counted["doc_id"].eqNullSafe(hits["hit_id"]) & (counted["print"] == hits["hit_print"]), "left")
    return joined.select("doc_id", "print", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), "item_ids", "spans")


def leak_digests(found: DataFrame) -> DataFrame:
    none = F.array().cast("array<string>")
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("item_ids", none), ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )

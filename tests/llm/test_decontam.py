import hashlib
import random
import re

from stellate.llm.decontam import decontaminate, leak_digests
from tests.llm.helpers import WORDS, corpus, frame, prose


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words_of(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = []
    for i, t in docs:
        w, hit, ids = words_of(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if found := windows.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    ids |= found
        joined = ",".join(sorted(map(str, ids)))
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(joined.encode()).hexdigest(), bool(hit)))
    return sorted(out)


ITEMS = [(1, prose(3, 40)), (2, "alpha beta"), (3, None), (4, "É é, É!"), (5, "the the the the the the the the the the the the"), (6, " .. "), (7, prose(900, 10)), (8, prose(901, 9)), (10, prose(3, 25)), (11, "rare0 " + "the " * 9), (1, prose(3, 40))]


def docs_with_leaks():
    item, other = prose(3, 40).split(), prose(900, 10)
    docs = corpus()
    docs += [
        (700, "x " * 20 + " ".join(item[5:15]) + " y"), (701, " ".join(item[5:14])), (702, (" ".join(item[:12])).upper() + "?!"), (703, "a " + other), (704, "alpha beta"),
        (705, "..alpha--Beta.."), (706, prose(901, 9)), (707, "the " * 50), (708, "x the the the the the the the the the y"), (709, "É é É"), (710, "é É é É"),
        (711, " ".join(item[5:15]) + " " + " ".join(item[10:25])), (712, "rare0 " + "the " * 8), (713, "the " * 4 + "rare0 " + "the " * 9),
    ]
    return docs


def test_matches_brute_force(spark):
    docs = docs_with_leaks()
    found = decontaminate(frame(spark, docs), frame(spark, ITEMS, "item_id bigint, text string"))
    assert sorted(map(tuple, leak_digests(found).collect())) == brute(docs, ITEMS)


def test_long_document_of_common_words(spark):
    """Occurrences of common words times items: many candidates, but none in one row."""
    r = random.Random(4)
    text = lambda n: " ".join(r.choice(WORDS[:10]) for _ in range(n))
    items = [(i, text(30)) for i in range(400)]
    docs = [(1, text(40_000)), (2, text(300) + " " + items[7][1] + " " + text(300)), (3, text(20_000) + " " + items[9][1][40:] + " " + text(20_000))]
    found = decontaminate(frame(spark, docs), frame(spark, items, "item_id bigint, text string"))
    assert sorted(map(tuple, leak_digests(found).collect())) == brute(docs, items)


def test_spans_are_words_of_the_document(spark):
    docs = docs_with_leaks()
    rows = decontaminate(frame(spark, docs), frame(spark, ITEMS, "item_id bigint, text string")).where("n_hit > 0").collect()
    items = {str(i): words_of(t) for i, t in ITEMS}
    texts = dict(docs)
    for r in rows:
        words = words_of(texts[r["doc_id"]])
        for s in r["spans"]:
            piece, item = words[s["first"] : s["last"] + 1], items[s["item_id"]]
            assert any(item[k : k + len(piece)] == piece for k in range(len(item)))


def test_empty_tables(spark):
    none = frame(spark, [], "item_id bigint, text string")
    assert decontaminate(frame(spark, []), frame(spark, ITEMS, "item_id bigint, text string")).count() == 0
    rows = leak_digests(decontaminate(frame(spark, [(1, "a b"), (None, None)]), none)).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["contaminated"]) for r in rows) == [("1", 2, False), ("None", 0, False)]


def test_no_python_in_the_plan(spark):
    plan = decontaminate(frame(spark, [(1, "a b")]), frame(spark, ITEMS, "item_id bigint, text string"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)

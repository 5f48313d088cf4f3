"""The manifest against a brute-force version; proofs fold to the root and find changes."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stellate.llm import merkle
from tests.llm.helpers import corpus

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def lower(text):
    return text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def climb(nodes):
    """The top, and for every node its steps ``(left, right)``."""
    steps, of = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(of):
            run = at // 16 * 16
            steps[i].append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + 16])))
        nodes = [sha(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
        of = [i // 16 for i in of]
    return nodes[0], steps


def brute(rows):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[1]].append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    tops = []
    for s in order:
        by_source[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        tops.append(climb([leaf_of(r) for r in by_source[s]]))
    root, upper = climb([t for t, _ in tops]) if tops else (None, [])
    out = []
    for s, (top, steps), over in zip(order, tops, upper, strict=True):
        for r, own in zip(by_source[s], steps, strict=True):
            path = own + over
            at = leaf_of(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                at = leaf_of((*r[:4], lower(r[4])))
            for left, right in path:
                at = sha(left, at, right)
            out.append((r[0], leaf_of(r), top, root, sha(*[x + y for x, y in path]), at, at == root))
    return sorted(out, key=str)


def table(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("pos", "tree", "n", "digest", "proof", "rn", "c0", "leaf"):  # clashing names
        df = df.withColumn(name, F.lit(1))
    return df.repartition(4)


def ours(spark, rows):
    return sorted((tuple(r) for r in merkle.manifest(table(spark, rows)).collect()), key=str)


@pytest.mark.parametrize("stretch", [7])
def test_like_brute_force(spark, stretch, monkeypatch):
    monkeypatch.setattr(merkle, "STRETCH", stretch)
    rows = [(i, None if i % 7 == 0 else "big" if i % 3 else f"s{i % 20}", None if i % 5 == 0 else "en", None if t is None else len(t), t) for i, t in corpus()]
    rows += [(10_000 + i, "big", "de", i, f"Text Nr. {i}") for i in range(4200)]  # more than 16 ** 3
    rows += [(3, "big", "en", 1, "other"), (None, "big", None, None, None), (None, "big", "x", 2, "A"), (None, None, None, None, "B"), (9, "", "en", 0, "empty source")]
    rows += [(1, "é", "x", 1, "One"), (2, "lone", "x", 1, "Two"), (2, "lone2", "x", 1, "Two"), (2, "Z", "x", 1, "Two")]
    rows += [(77, "hot", "en", 4, "same")] * 40
    assert ours(spark, rows) == brute(rows)


@pytest.mark.parametrize("n, sources", [(0, 1), (1, 1), (16, 1), (257, 1), (17, 17)])
def test_sizes(spark, n, sources):
    rows = [(i, f"s{i % sources:03d}", "en", 3, f"Abc{i}") for i in range(n)]
    assert ours(spark, rows) == brute(rows)


def test_changes_are_found(spark):
    rows = [(i, f"s{i % 3}", "en", 5, "Upper" if i % 2 else "lower") for i in range(100)]
    for r in merkle.manifest(table(spark, rows)).collect():
        hit = zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.doc_id % 2
        assert r.verified != bool(hit)

"""Nearest neighbours against brute force in double precision."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stellate.llm import neighbours as N

SCHEMA = "vec_id bigint, embedding array<float>, score double, rank string"


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)


def brute(rows, asked, k):
    rows = sorted({(i, tuple(np.float32(v).astype(float) + 0.0)) for i, v in rows if i is not None and usable(v)})
    out = []
    for q, a in rows:
        if asked(q):
            found = []
            for n, b in rows:
                if n != q and len(a) == len(b):
                    total = 0.0
                    for x, y in zip(a, b, strict=True):
                        total += (x - y) * (x - y)
                    found.append((math.sqrt(total), n))
            out += [(q, r, n, d) for r, (d, n) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def ours(spark, rows, asked, k=10, **bounds):
    df = spark.createDataFrame([(i, v and [x if x is None else float(x) for x in v], 1.0, "x") for i, v in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in N.nearest(df, asked, k, **bounds).collect())


def vectors(n, d, seed=1):
    return np.random.default_rng(seed).normal(size=(n, d)).astype(np.float32).tolist()


@pytest.mark.parametrize("bounds", [{}, {"candidate_bytes": 900, "query_bytes": 300}])
def test_all_shapes_of_rows(spark, bounds):
    rows = list(enumerate(vectors(300, 6)))
    rows += [(400 + i, rows[10][1]) for i in range(150)]  # a hot vector, many ties
    rows += [(600 + i, [x + 1e-4 * i for x in rows[20][1]]) for i in range(40)]  # nearer than the codes can tell
    rows += [(10, rows[10][1]), (20, rows[20][1])]  # repeated rows
    rows += [(30, rows[31][1]), (30, rows[32][1])]  # an id with several vectors
    rows += [(700 + i, v) for i, v in enumerate(vectors(5, 3))]  # another length, fewer than k others
    rows += [(800, [0.0] * 6), (810, None), (820, [1.0, None, 0, 0, 0, 0]), (830, [math.nan] * 6), (840, [math.inf] + [0.0] * 5), (850, []), (None, [1.0] * 6)]
    rows += [(860, [-0.0, 1, 0, 0, 0, 0]), (870, [0.0, 1, 0, 0, 0, 0]), (880, [1e-44] * 6), (890, [3e38] * 6), (900, [-3e38] * 6)]
    assert ours(spark, rows, F.col("vec_id") % 10 == 0, **bounds) == brute(rows, lambda i: i % 10 == 0, 10)


def test_one_neighbour_and_more_than_there_are(spark):
    rows = list(enumerate(vectors(30, 4)))
    for k in (1, 40):
        assert ours(spark, rows, F.col("vec_id") < 5, k) == brute(rows, lambda i: i < 5, k)


def test_empty(spark):
    assert ours(spark, [], F.col("vec_id") % 10 == 0) == []
    assert ours(spark, list(enumerate(vectors(5, 4))), F.col("vec_id") > 10) == []


def test_bounds_hold():
    for scale in (1e-30, 1.0, 1e15):
        a, b = np.array(vectors(40, 70, 2)) * scale, np.array(vectors(60, 70, 3)) * scale
        b[:10] = a[:10]
        b[10:20] = a[10:20] * (1 + 1e-7)
        low, up = N.bounds(N.Quantised(a), N.Quantised(b), slice(0, 40), slice(0, 60))
        true = np.sqrt(((a[:, None] - b[None]) ** 2).sum(2))
        assert (low <= true).all() and (true <= up).all()
        assert (up - low).max() < 0.2 * true.max()


def test_int8_product_is_exact_beyond_float32():
    r = np.random.default_rng(1)
    a, b = r.integers(-127, 128, (3, 5000)).astype(np.int8), np.full((2, 5000), 127, np.int8)
    assert (N.int8_product(a, b) == a.astype(np.int64) @ b.astype(np.int64).T).all()
    a[:] = 127
    assert (N.int8_product(a, b) == 127 * 127 * 5000).all()


def test_survivors_are_few():
    """The bounds leave a small part of the pairs to be recomputed."""
    a, b = (np.array(vectors(n, 64, n)) for n in (50, 5000))
    low, up = N.bounds(N.Quantised(a), N.Quantised(b), slice(0, 50), slice(0, 5000))
    worst = np.partition(up, 9, axis=1)[:, 9]
    assert (low <= worst[:, None]).sum() < 50 * 40

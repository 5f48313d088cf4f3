import math
import zlib
from collections import Counter

import numpy as np

from stellate.llm import lbl
from stellate.llm.lbl import LogBilinear, Units, language_scores
from tests.llm.helpers import corpus, frame


def tokens(text):
    return (text or "").encode().lower().split() + [b"\n"]


def brute(docs):
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in docs}
    counts = Counter(t for i, x in docs if not held[i] for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, x in docs:
        ts = tokens(x)
        out.append((i, held[i], len(ts), sum(counts[t] > 0 for t in ts), n, sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts)))
    return out


def test_counts_and_base_score_match_brute_force(spark):
    docs = corpus()
    rows = language_scores(frame(spark, docs)).collect()
    assert sorted(tuple(r)[:5] for r in rows) == sorted(x[:5] for x in brute(docs))
    base = dict((x[0], x[5]) for x in brute(docs))
    assert all(math.isclose(r["base_score"], base[r["doc_id"]], rel_tol=1e-9) for r in rows)
    assert all(math.isfinite(r["score"]) for r in rows)


def chain_text(seed, n, tongue):
    """Two tongues with their own words, and inside each a strong order of words."""
    r = np.random.default_rng(seed)
    at, out = 0, []
    for _ in range(n):
        at = (at + (1 if r.random() < 0.8 else int(r.integers(0, 20)))) % 20
        out.append(f"{tongue}{at}")
    return " ".join(out)


def test_held_out_score_beats_the_base(spark):
    docs = [(i, chain_text(i, 300, "ab"[i % 2])) for i in range(120)]
    rows = language_scores(frame(spark, docs)).where("held_out").collect()
    assert rows
    gain = sum(r["score"] - r["base_score"] for r in rows) / sum(r["n_tokens"] for r in rows)
    assert gain > 0.25  # of 1.6 for the base


def model_of(n, seed=4):
    return LogBilinear(Units(np.sort(np.random.default_rng(seed).pareto(1.0, n) * 50)[::-1]))


def test_probabilities_are_normalised():
    model = model_of(300)
    n = len(model.units)
    context, y = LogBilinear.contexts(np.array([3, 7, 250, 1], np.int32), n), np.array([3, 7, 250, 1], np.int32)
    model.train(np.tile(context, (50, 1)), np.tile(y, 50), seed=1)
    for row in context:
        every = model.log10(np.tile(row, (n, 1)), np.arange(n))
        assert abs((10**every).sum() - 1) < 1e-4


def test_classes_are_runs_of_like_mass():
    for n in (1, 2, 70, 5000):
        u = model_of(n).units
        assert u.of[0] == 0 and (np.diff(u.of) >= 0).all() and (np.diff(u.of) <= 1).all() and len(u.class_mass) <= max(1, math.isqrt(n))
        assert np.allclose(np.bincount(u.of, u.mass), u.class_mass) and [u.of[a] for a in u.first[:-1]] == list(range(len(u.class_mass)))


def test_scores_are_the_softmax_of_class_and_unit():
    model = model_of(90)
    u, n = model.units, 90
    model.rows *= 20  # scores that overflow unless the greatest is taken off
    y = np.random.default_rng(1).integers(0, n, 200).astype(np.int32)
    context = LogBilinear.contexts(y, n)
    given, inner, classes, weight = (t.astype(np.float64) for t in model.tables())
    for c, k, got in zip(context, y, model.log10(context, y), strict=True):
        q = np.append((given[c] * weight).sum(axis=0), 1)
        kind, span = u.of[k], slice(u.first[u.of[k]], u.first[u.of[k] + 1])
        each = [s[i] - s.max() - np.log(np.exp(s - s.max()).sum()) for s, i in ((classes @ q, kind), (inner[span] @ q, k - span.start))]
        assert math.isclose(got, sum(each) / np.log(10), rel_tol=1e-3, abs_tol=1e-3)


def test_contexts():
    assert LogBilinear.contexts(np.array([5, 6, 7], np.int32), 9).tolist() == [[9] * 4, [5, 9, 9, 9], [6, 5, 9, 9]]


def test_scores_do_not_depend_on_the_layout(spark):
    docs = frame(spark, [(i, chain_text(i, 60, "ab"[i % 2])) for i in range(60)] + [(i % 3, "same text") for i in range(20)])
    each = [sorted((r["doc_id"], round(r["score"], 6)) for r in language_scores(docs.repartition(n)).collect()) for n in (1, 2, 7)]
    assert all(abs(x[1] - y[1]) < 1e-5 and x[0] == y[0] for other in each[1:] for x, y in zip(each[0], other, strict=True))


def test_units_grow_with_the_corpus(spark, monkeypatch):
    sizes = []

    class Seen(Units):
        def __init__(self, mass):
            sizes.append(len(mass))
            super().__init__(mass)

    monkeypatch.setattr(lbl, "Units", Seen)
    words = [f"w{i}" for i in range(400)]
    for n in (20, 200):
        r = np.random.default_rng(n)
        language_scores(frame(spark, [(i, " ".join(r.choice(words, 100, p=1 / np.arange(1, 401) / (1 / np.arange(1, 401)).sum()))) for i in range(n)]))
    assert lbl.BUCKETS < sizes[0] < sizes[1] <= lbl.BUCKETS + 1 + lbl.PER_ROOT * math.sqrt(200 * 101)


def test_only_held_out_and_empty_tables(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    row = language_scores(frame(spark, [(held, "a b"), (None, None)])).collect()
    assert {(r["doc_id"], r["n_tokens"], r["n_known"]) for r in row if r["doc_id"] is not None} <= {(held, 3, 0), (held, 3, 1)}
    only = language_scores(frame(spark, [(held, "a b")])).collect()[0]
    assert (only["train_tokens"], only["n_known"]) == (0, 0) and math.isclose(only["base_score"], 3 * math.log10(0.1 / 0.1))
    assert language_scores(frame(spark, [])).count() == 0


def test_draws_and_scores_take_few_calls(monkeypatch):
    """Draws come from a guide table, as a search of the running mass gives them; tokens of one
    class are scored together, also when there are many."""
    r = np.random.default_rng(3)
    units = lbl.Units(np.sort(r.pareto(1, 900) * 100)[::-1])
    place = np.append(r.random((4, 500)).ravel(), units.before[:-1])
    assert (units.at(place) == np.searchsorted(units.before, place, side="right") - 1).all()

    y = units.at(r.random(1 << 17)).astype(np.int32)
    model, context = lbl.LogBilinear(units), LogBilinear.contexts(y, len(units))
    some = model.log10(context[:100], y[:100])
    calls, plain = [], lbl.log_softmax
    monkeypatch.setattr(lbl, "log_softmax", lambda q, *rest: calls.append(len(q)) or plain(q, *rest))
    assert np.allclose(model.log10(context, y)[:100], some, rtol=0, atol=1e-5)
    assert len(calls) <= 5 * len(units.class_mass)

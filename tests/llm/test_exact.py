import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stellate.llm import exact
from stellate.llm.exact import exact_groups, rice_decode, rice_encode
from tests.llm.helpers import corpus, frame


@given(st.sets(st.integers(0, 1 << 40), min_size=1, max_size=300))
@settings(max_examples=60, deadline=None)
def test_rice_round_trip(values):
    array = np.array(sorted(values), np.int64)
    assert rice_decode(rice_encode(array)).tolist() == array.tolist()


def test_rice_is_compact():
    array = np.sort(np.random.default_rng(1).choice(1 << 40, 10_000, replace=False)).astype(np.int64)
    assert len(rice_encode(array)) < 0.7 * 8 * len(array)


def brute(docs):
    groups = {}
    for i, t in docs:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", "", t or ""), []).append((-len(t or ""), i))
    return groups


def test_groups_match_brute_force(spark):
    docs = corpus()
    groups = brute(docs)
    rows = exact_groups(frame(spark, docs)).collect()
    assert len(rows) == len(docs)
    for r in rows:
        text = next(re.sub(r"[\x20\x09-\x0D]+", "", t or "") for i, t in docs if i == r["doc_id"])
        assert (r["keep_id"], r["group_size"]) == (min(groups[text])[1], len(groups[text]))
    kept = [r["doc_id"] for r in rows if r["kept"]]
    assert sorted(kept) == sorted(min(g)[1] for g in groups.values())  # exactly one of each, repeated rows too


def test_null_ids_and_empty_table(spark):
    rows = exact_groups(frame(spark, [(None, "a b"), (None, "a b"), (3, "ab"), (None, None)])).collect()
    assert sum(r["kept"] for r in rows) == 2
    assert exact_groups(frame(spark, [])).count() == 0


def test_rows_equal_in_id_and_text_are_spread(spark, monkeypatch):
    """A third of all rows without id and text: no chunk gets them all, and one stays."""
    docs = [(i, f"text {i}") for i in range(800)] + [(None, "")] * 400 + [(None, f"other {i % 7}") for i in range(70)]
    sizes, real = [], exact.staged

    def watched(df, name):
        out = real(df, name)
        if name == "exact-marked":
            sizes.extend(r["count"] for r in out.groupBy("chunk").count().collect())
        return out

    monkeypatch.setattr(exact, "staged", watched)
    rows = exact_groups(frame(spark, docs)).collect()
    assert len(rows) == len(docs) and sum(r["kept"] for r in rows) == 800 + 1 + 7
    assert max(sizes) < 3 * len(docs) / exact.LEAST_CHUNKS
    assert {r["group_size"] for r in rows} == {1, 10, 400}


def test_string_ids(spark):
    rows = exact_groups(frame(spark, [("b", "x y"), ("a", "x y"), ("c", "z")], "doc_id string, text string")).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["kept"]) for r in rows) == [("a", "a", True), ("b", "a", False), ("c", "c", True)]


@pytest.mark.parametrize("n", [0, 5])
def test_query_schema(spark, n):
    df = exact_groups(frame(spark, [(i, "same") for i in range(n)], extra=False))
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256", "n_chars", "print"]
    assert df.count() == n

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stellate.operators import merge
from tests.conftest import rows

SCHEMA = "k int, a double, b string"


def _t(spark, data):
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize("strategy", ["shuffle", "broadcast"])
def test_coalesce_rules(spark, strategy):
    # Source NULL over 9 → 9; source 1 over 9 → 1; target-only row unchanged; new key inserted.
    t = _t(spark, [(1, 9.0, "x"), (2, 9.0, "y"), (3, 9.0, "z")])
    s = _t(spark, [(1, None, None), (2, 1.0, None), (4, 4.0, "n")])
    got = rows(merge.upsert(t, s, ["k"], strategy=strategy))
    assert got == [(1, 9.0, "x"), (2, 1.0, "y"), (3, 9.0, "z"), (4, 4.0, "n")]


def test_nan_overwrites(spark):
    # S12
    t = _t(spark, [(1, 9.0, "x")])
    s = _t(spark, [(1, float("nan"), None)])
    assert math.isnan(merge.upsert(t, s, ["k"]).first().a)


def test_insert_then_update_equals_one_merge(spark):
    # INSERT absent, then UPDATE with COALESCE == one merge.
    t = _t(spark, [(1, 9.0, None), (2, None, "y")])
    s = _t(spark, [(1, None, "s"), (3, 3.0, None)])
    two_step = merge.update_existing(merge.insert_absent(t, s, ["k"]), s, ["k"])
    assert rows(two_step) == rows(merge.upsert(t, s, ["k"]))


def test_null_keys_not_merged_but_counted(spark):
    t = _t(spark, [(1, 1.0, "a")])
    s = _t(spark, [(None, 5.0, "n"), (2, 2.0, "b")])
    merged = merge.upsert(t, s, ["k"], with_flags=True)
    assert sorted(r.k for r in merged.collect()) == [1, 2]
    c = merge.merge_counts(merged, s, ["k"]).first()
    assert (c.inserted, c.matched_before, c.updated, c.target_only, c.total_after, c.rejected_null_keys) == (
        1, 0, 1, 1, 2, 1,
    )


def test_counts_on_empty_target_match_reference_style(spark):
    # inserted = updated = total on an empty target.
    t = spark.createDataFrame([], SCHEMA)
    s = _t(spark, [(i, float(i), None) for i in range(10)])
    c = merge.merge_counts(merge.upsert(t, s, ["k"], with_flags=True)).first()
    assert c.inserted == c.updated == c.total_after == 10


def test_rerun_is_idempotent(spark):
    # S15 / E-11: a second run inserts nothing and leaves the same table.
    t = _t(spark, [(1, 9.0, "x")])
    s = _t(spark, [(1, None, "y"), (2, 2.0, None)])
    once = merge.upsert(t, s, ["k"])
    twice = merge.upsert(once, s, ["k"], with_flags=True)
    assert merge.merge_counts(twice).first().inserted == 0
    assert rows(twice.drop(merge.IN_TARGET, merge.IN_SOURCE)) == rows(once)


def test_broadcast_strategy_does_not_shuffle_target(spark):
    t = spark.range(1000).selectExpr("cast(id as int) k", "cast(id as double) a", "cast(null as string) b")
    s = _t(spark, [(1, 5.0, "q"), (5000, 1.0, None)])
    plan = merge.upsert(t, s, ["k"], strategy="broadcast")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_auto_falls_back_to_shuffle_over_limit(spark):
    t = _t(spark, [(1, 1.0, "a")])
    s = _t(spark, [(i, 1.0, None) for i in range(100)])
    assert not merge.source_fits_broadcast(s, limit_bytes=100)
    assert rows(merge.upsert(t, s, ["k"], strategy="auto", broadcast_limit_bytes=100)) == rows(
        merge.upsert(t, s, ["k"], strategy="shuffle")
    )


cell = st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False, width=32))
table_st = st.dictionaries(st.integers(0, 30), st.tuples(cell, st.one_of(st.none(), st.sampled_from("abc"))), max_size=25)


@settings(max_examples=15, deadline=None)
@given(target=table_st, source=table_st, cut=st.integers(0, 30))
def test_merge_properties(spark, target, source, cut):
    t = _t(spark, [(k, a, b) for k, (a, b) in target.items()])
    s = _t(spark, [(k, a, b) for k, (a, b) in source.items()])
    out = {r.k: (r.a, r.b) for r in merge.upsert(t, s, ["k"]).collect()}
    # |merge| = |keys(T) ∪ keys(S)|, no key lost
    assert set(out) == set(target) | set(source)
    for k, (a, b) in out.items():
        ta, tb = target.get(k, (None, None))
        sa, sb = source.get(k, (None, None))
        assert a == (sa if sa is not None else ta) and b == (sb if sb is not None else tb)
        # no non-null target cell becomes NULL
        assert not (ta is not None and a is None) and not (tb is not None and b is None)
    # splitting the source by key into batches gives the same merge
    s1 = s.filter(f"k < {cut}")
    s2 = s.filter(f"k >= {cut}")
    batched = merge.upsert(merge.upsert(t, s1, ["k"]), s2, ["k"])
    assert {r.k: (r.a, r.b) for r in batched.collect()} == out


def test_batches_equal_one_merge_and_log_their_counts(spark):
    t = _t(spark, [(i, float(i), None) for i in range(0, 40, 2)])
    s = _t(spark, [(i, None if i % 3 else -1.0, "s") for i in range(0, 40)])
    got, log = merge.merge_in_batches(t, s, ["k"], 5)
    assert rows(got) == rows(merge.upsert(t, s, ["k"]))
    total = log.groupBy().sum("inserted", "matched_before", "target_only").first()
    assert tuple(total) == (20, 20, 0) and log.count() == 5


def test_orphans_follow_the_session_threshold(spark):
    from stellate.operators import checks

    fact = spark.createDataFrame([("A", 1), ("B", 2), (None, 3)], "e string, v int")
    dim = spark.createDataFrame([("A",)], "e string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        o = checks.orphans(fact, dim, "e")
        assert [r.e for r in o.collect()] == ["B"]
        assert "Broadcast" not in o._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_broadcasts_need_measured_bytes(spark):
    """A wide text source is measured by its bytes, and an asked-for broadcast is checked too."""
    t = _t(spark, [(1, 1.0, "a")])
    s = _t(spark, [(i, 1.0, "x" * 1000) for i in range(100)])
    assert 100_000 < merge.measured_bytes(s) < 120_000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for strategy in ("auto", "broadcast"):
            plan = merge.upsert(t, s, ["k"], strategy=strategy)._jdf.queryExecution().executedPlan().toString()
            assert "Broadcast" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("strategy", ["shuffle", "broadcast"])
def test_source_without_a_column_keeps_target_values(spark, strategy):
    t = _t(spark, [(1, 9.0, "x"), (2, 8.0, "y")])
    s = spark.createDataFrame([(1, 1.0), (3, 3.0)], "k int, a double")
    got = rows(merge.upsert(t, s, ["k"], strategy=strategy))
    assert got == [(1, 1.0, "x"), (2, 8.0, "y"), (3, 3.0, None)]


def test_merge_by_parts_prunes_the_target_scan(spark):
    """The same rows as the full outer join; a Bloom filter of the source's keys at the target."""
    from stellate.plans.queries import runtime_filtered_upsert, upsert_orders

    df = runtime_filtered_upsert(spark, "/root/testdata/sf0.001")
    assert "might_contain" in df._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, upsert_orders(spark, "/root/testdata/sf0.001").collect()))

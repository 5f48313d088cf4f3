from datetime import date

from stellate.operators import dedup
from tests.conftest import rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_most_complete_keeps_fullest_row(spark):
    # 3 vs 5 filled cells → the 5-cell row; the label does not count.
    df = spark.createDataFrame(
        [
            ("A", "2020-01-01", "L", "1", "2", "3", "", ""),
            ("A", "2020-01-01", "", "1", "2", "3", "4", "5"),
        ],
        "k string, d string, lab string, a string, b string, c string, e string, f string",
    )
    out = dedup.most_complete(df, ["k", "d"], exclude=["lab"]).collect()
    assert len(out) == 1 and out[0].f == "5" and out[0].score == 5


def test_tie_break_is_repeatable(spark):
    # Equal scores → the same row whatever the input order and partitioning.
    data = [("A", "x", str(i)) for i in range(50)]
    a = spark.createDataFrame(data, "k string, v string, w string").repartition(7)
    b = spark.createDataFrame(list(reversed(data)), "k string, v string, w string").repartition(3)
    c = spark.createDataFrame(data[25:] + data[:25], "k string, v string, w string").repartition(11)
    ra = dedup.most_complete(a, ["k"]).collect()
    rb = dedup.most_complete(b, ["k"]).collect()
    rc = dedup.most_complete(c, ["k"]).collect()
    assert ra == rb == rc and len(ra) == 1
    # An explicit tie-break column decides exactly.
    assert dedup.most_complete(b, ["k"], tiebreak=["w"]).first().w == "0"


def test_null_keys_group_together(spark):
    # NULL keys form one group in the dedup (PARTITION BY semantics).
    df = spark.createDataFrame([(None, "1"), (None, "2"), ("A", "3")], "k string, v string")
    assert dedup.most_complete(df, ["k"]).count() == 2


def test_partial_window_group_limit_before_shuffle(spark):
    df = spark.createDataFrame([("A", "1")], "k string, v string")
    plan = _plan(dedup.most_complete(df, ["k"]))
    assert "WindowGroupLimit" in plan


def test_latest_per_entity_whole_row_and_chronological(spark):
    # The latest row is the row with the largest DATE, even if its cells are
    # empty; 2020-01-10 is later than 2020-01-09 although '9' > '1' as text.
    df = spark.createDataFrame(
        [
            ("A", date(2020, 1, 9), 7.0),
            ("A", date(2020, 1, 10), None),
            ("B", date(2020, 1, 1), 1.0),
            ("C", None, 2.0),
            (None, date(2020, 1, 1), 3.0),
        ],
        "k string, d date, v double",
    )
    got = rows(dedup.latest_per_entity(df, "k", "d"))
    assert got == [("A", date(2020, 1, 10), None), ("B", date(2020, 1, 1), 1.0)]
    assert rows(dedup.latest_per_entity_join(df, "k", "d")) == got


def test_latest_is_map_side_combined(spark):
    df = spark.createDataFrame([("A", date(2020, 1, 1), 1.0)], "k string, d date, v double")
    plan = _plan(dedup.latest_per_entity(df, "k", "d"))
    assert "partial_max" in plan


def test_any_per_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert sorted(r.k for r in dedup.any_per_key(df, ["k"]).collect()) == [1, 2]


def test_hot_key_dedup_result(spark):
    # One key with a third of all rows: still exactly one row for it, the fullest.
    hot = [("H", str(i) if i == 777 else "", str(i)) for i in range(3000)]
    cold = [(f"k{i}", "", str(i)) for i in range(6000)]
    df = spark.createDataFrame(hot + cold, "k string, a string, id string")
    out = dedup.most_complete(df, ["k"], tiebreak=["id"])
    assert out.count() == 6001
    assert out.filter("k = 'H'").first().a == "777"


def test_result_independent_of_shuffle_partitions_and_order(spark):
    from stellate.plans import views as V

    wide = V.w(spark, "/root/testdata/sf0.001")
    base = None
    for parts, order in [("3", "event_id"), ("17", "entity"), ("8", "m_view")]:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = rows(dedup.most_complete(wide.orderBy(order).repartition(int(parts)), ["entity", "day"]))
        base = base or got
        assert got == base
    spark.conf.set("spark.sql.shuffle.partitions", "8")

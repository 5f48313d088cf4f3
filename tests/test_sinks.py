import os
import shutil
from datetime import date

import pytest
from pyspark.sql import functions as F

from stellate.operators import checks, merge
from stellate.sinks import tables
from stellate.sinks.ledger import ConcurrentWrite, Ledger


def _fact(spark, data):
    return spark.createDataFrame(data, "k string, d date, v double")


def test_merge_into_path_touches_only_source_months(spark, tmp_dir):
    path = f"{tmp_dir}/fact"
    first = _fact(spark, [("A", date(2020, 1, 5), 1.0), ("A", date(2020, 2, 5), 2.0), ("B", date(2020, 3, 1), 3.0)])
    c1 = tables.merge_into_path(spark, first, path, ["k", "d"], "month", tables.month_of("d"))
    assert c1["inserted"] == 3 and c1["updated"] == 3
    # February only: one update with a NULL (keeps 2.0), one insert.
    src = _fact(spark, [("A", date(2020, 2, 5), None), ("B", date(2020, 2, 6), 9.0)])
    c2 = tables.merge_into_path(spark, src, path, ["k", "d"], "month", tables.month_of("d"))
    assert (c2["inserted"], c2["matched_before"], c2["updated"]) == (1, 1, 2)
    got = sorted((r.k, str(r.d), r.v, r.month) for r in spark.read.parquet(path).collect())
    assert got == [
        ("A", "2020-01-05", 1.0, "2020-01"),
        ("A", "2020-02-05", 2.0, "2020-02"),
        ("B", "2020-02-06", 9.0, "2020-02"),
        ("B", "2020-03-01", 3.0, "2020-03"),
    ]
    # Re-running the same source changes nothing (replay safety).
    c3 = tables.merge_into_path(spark, src, path, ["k", "d"], "month", tables.month_of("d"))
    assert c3["inserted"] == 0
    assert sorted((r.k, str(r.d), r.v) for r in spark.read.parquet(path).collect()) == [g[:3] for g in got]


def test_merge_reads_only_the_source_months(spark, tmp_dir, monkeypatch):
    """The plan that ``merge_into_path`` itself writes."""
    path = f"{tmp_dir}/fact2"
    first = _fact(spark, [("A", date(2020, m, 1), float(m)) for m in range(1, 13)])
    tables.merge_into_path(spark, first, path, ["k", "d"], "month", tables.month_of("d"))
    plans, real = [], tables._written

    def watched(df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, *args, **kwargs)

    monkeypatch.setattr(tables, "_written", watched)
    kept = {n: os.stat(f"{path}/{n}").st_mtime_ns for n in os.listdir(path) if n.startswith("month=")}
    tables.merge_into_path(spark, _fact(spark, [("B", date(2020, 2, 3), 1.0)]), path, ["k", "d"], "month", tables.month_of("d"))
    assert "PartitionFilters: [isnotnull(month" in plans[0] and "(2020-02)" in plans[0].replace("= 2020-02", "(2020-02)")
    changed = {n for n, t in kept.items() if os.stat(f"{path}/{n}").st_mtime_ns != t}
    assert changed == {"month=2020-02"}


def test_source_without_a_column_leaves_it_alone(spark, tmp_dir):
    for part in ((), ("month", tables.month_of("d"))):
        path = f"{tmp_dir}/narrow{len(part)}"
        full = spark.createDataFrame([("A", date(2020, 1, 5), 1.0, "w1"), ("B", date(2020, 1, 6), 2.0, "w2")], "k string, d date, v double, w string")
        tables.merge_into_path(spark, full, path, ["k", "d"], *part)
        tables.merge_into_path(spark, _fact(spark, [("A", date(2020, 1, 5), 9.0), ("C", date(2020, 1, 7), 3.0)]), path, ["k", "d"], *part)
        got = sorted((r.k, r.v, r.w) for r in tables.read_target(spark, path).collect())
        assert got == [("A", 9.0, "w1"), ("B", 2.0, "w2"), ("C", 3.0, None)]


def test_source_with_a_new_column_adds_it(spark, tmp_dir):
    path = f"{tmp_dir}/wide"
    tables.merge_into_path(spark, _fact(spark, [("A", date(2020, 1, 5), 1.0), ("B", date(2020, 2, 5), 2.0)]), path, ["k", "d"], "month", tables.month_of("d"))
    new = spark.createDataFrame([("A", date(2020, 1, 5), None, "n")], "k string, d date, v double, extra string")
    tables.merge_into_path(spark, new, path, ["k", "d"], "month", tables.month_of("d"))
    assert sorted((r.k, r.v, r.extra) for r in tables.read_target(spark, path).collect()) == [("A", 1.0, "n"), ("B", 2.0, None)]


class Lost(BaseException):
    """The driver is gone: nothing that it would clean up is cleaned up."""


def _die(*args, **kwargs):
    raise Lost


OLD = [("A", date(2020, 1, 5), 1.0), ("B", date(2020, 1, 6), 2.0), ("C", date(2020, 2, 5), 3.0), ("E", date(2020, 3, 5), 5.0)]
CHANGE = [("A", date(2020, 1, 5), 10.0), ("D", date(2020, 2, 6), 4.0)]
NEW = [("A", 10.0), ("B", 2.0), ("C", 3.0), ("D", 4.0), ("E", 5.0)]


def _seen(spark, path):
    df = tables.read_target(spark, path)
    return None if df is None else sorted((r.k, r.v) for r in df.collect())


def _listing(path):
    root, name = os.path.split(path)
    return sorted(os.path.join(d, f) for top in (path, f"{root}/_ledger/{name}") for d, _, fs in os.walk(top) for f in fs)


@pytest.mark.parametrize("partitioned", [True, False])
@pytest.mark.parametrize("lost_at", ["before_published", "before_switch", "in_switch"])
def test_driver_lost_while_replacing(spark, tmp_dir, monkeypatch, partitioned, lost_at):
    """Whenever the driver goes, no row is lost, reads change nothing, and the next merge goes on."""
    path = f"{tmp_dir}/lost"
    part = ("month", tables.month_of("d")) if partitioned else ()
    tables.merge_into_path(spark, _fact(spark, OLD), path, ["k", "d"], *part)
    if lost_at == "before_published":
        monkeypatch.setattr(Ledger, "publish", _die)
    elif lost_at == "before_switch":
        monkeypatch.setattr(tables, "put_in_place", _die)
    else:  # the old files of a partition are gone, the new ones not yet there

        def half(spark, path, entry):
            shutil.rmtree(f"{path}/month=2020-01" if partitioned else path)
            raise Lost

        monkeypatch.setattr(tables, "put_in_place", half)
    with pytest.raises(Lost):
        tables.merge_into_path(spark, _fact(spark, CHANGE), path, ["k", "d"], *part)
    monkeypatch.undo()
    files = _listing(path)
    assert _seen(spark, path) == (sorted((k, v) for k, _, v in OLD) if lost_at == "before_published" else NEW)
    assert _listing(path) == files
    c = tables.merge_into_path(spark, _fact(spark, CHANGE), path, ["k", "d"], *part)
    assert (c["inserted"], c["matched_before"]) == ((1, 1) if lost_at == "before_published" else (0, 2))
    assert _seen(spark, path) == NEW and tables.row_count(spark, path) == 5
    assert not [f for f in _listing(path) if "rows-" in f or f.endswith(".open")]


@pytest.mark.parametrize("partitioned", [True, False])
def test_driver_lost_in_a_first_write(spark, tmp_dir, monkeypatch, partitioned):
    """Rows written straight into new partitions are taken back and written again."""
    path = f"{tmp_dir}/first"
    part = ("month", tables.month_of("d")) if partitioned else ()
    monkeypatch.setattr(Ledger, "close", _die)
    with pytest.raises(Lost):
        tables.merge_into_path(spark, _fact(spark, OLD), path, ["k", "d"], *part)
    assert _seen(spark, path) is None
    monkeypatch.undo()
    c = tables.merge_into_path(spark, _fact(spark, OLD), path, ["k", "d"], *part)
    assert c["inserted"] == c["total"] == 4 and len(_seen(spark, path)) == 4
    if partitioned:  # the same for months beside others
        more = [("F", date(2021, 1, 1), 1.0)]
        monkeypatch.setattr(Ledger, "close", _die)
        with pytest.raises(Lost):
            tables.merge_into_path(spark, _fact(spark, more), path, ["k", "d"], *part)
        assert len(_seen(spark, path)) == 4
        monkeypatch.undo()
        c = tables.merge_into_path(spark, _fact(spark, more), path, ["k", "d"], *part)
        assert (c["inserted"], c["total"]) == (1, 5) and len(_seen(spark, path)) == 5


@pytest.mark.parametrize("partitioned", [True, False])
def test_reading_between_write_and_switch(spark, tmp_dir, partitioned):
    """A reader at any moment sees all old rows or all new ones, and disturbs no merge."""
    path = f"{tmp_dir}/read"
    part = ("month", tables.month_of("d")) if partitioned else ()
    seen = []
    look = lambda: seen.append(_seen(spark, path))
    tables.merge_into_path(spark, _fact(spark, OLD), path, ["k", "d"], *part, published=look)
    look()
    real = tables._written

    def watched(df, to, *args, **kwargs):
        look()
        real(df, to, *args, **kwargs)
        look()

    tables._written = watched
    try:
        c = tables.merge_into_path(spark, _fact(spark, CHANGE), path, ["k", "d"], *part, published=look)
    finally:
        tables._written = real
    look()
    old = sorted((k, v) for k, _, v in OLD)
    assert seen == [None, old, old, old, NEW, NEW, NEW, NEW] and (c["inserted"], c["total"]) == (1, 5)


def test_missing_staged_rows_are_an_error_before_any_delete(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/gone"
    tables.merge_into_path(spark, _fact(spark, OLD), path, ["k", "d"])
    monkeypatch.setattr(tables, "put_in_place", _die)
    with pytest.raises(Lost):
        tables.merge_into_path(spark, _fact(spark, CHANGE), path, ["k", "d"])
    monkeypatch.undo()
    _, entry = Ledger(spark, path).in_place()
    shutil.rmtree(entry["rows"].removeprefix("file:"))
    with pytest.raises(FileNotFoundError):
        tables.merge_into_path(spark, _fact(spark, CHANGE), path, ["k", "d"])
    assert spark.read.parquet(path).count() == 4


def test_second_writer_is_told(spark, tmp_dir):
    path = f"{tmp_dir}/two"
    tables.merge_into_path(spark, _fact(spark, OLD), path, ["k", "d"])
    first, second = Ledger(spark, path), Ledger(spark, path)
    n = first.number() + 1
    entry = first.last()
    first.publish(n, entry)
    with pytest.raises(ConcurrentWrite):
        second.publish(n, entry)
    first.close(n, entry)
    with pytest.raises(ConcurrentWrite):
        second.publish(n, entry)


def test_failed_write_leaves_the_target_as_it_was(spark, tmp_dir):
    path = f"{tmp_dir}/bad"
    bad = _fact(spark, CHANGE).withColumn("v", F.when(F.col("k") == "D", F.raise_error(F.lit("bad row")).cast("double")).otherwise(F.col("v")))
    for k in range(2):
        with pytest.raises(Exception, match="bad row"):
            tables.merge_into_path(spark, bad, path, ["k", "d"], "month", tables.month_of("d"))
        assert _seen(spark, path) == (sorted((k, v) for k, _, v in OLD) if k else None)
        assert not [f for f in _listing(path) if "rows-" in f or f.endswith(".open")]
        tables.merge_into_path(spark, _fact(spark, OLD), path, ["k", "d"], "month", tables.month_of("d"))


def test_named_batch_counts_once(spark, tmp_dir):
    path = f"{tmp_dir}/named"
    first = tables.merge_into_path(spark, _fact(spark, OLD), path, ["k", "d"], batch="b1")
    again = tables.merge_into_path(spark, _fact(spark, OLD), path, ["k", "d"], batch="b1")
    assert again["replayed"] and not first["replayed"]
    assert all(again[k] == first[k] for k in ("inserted", "matched_before", "updated", "total"))
    assert tables.merge_into_path(spark, _fact(spark, OLD), path, ["k", "d"], batch="b2")["matched_before"] == 4


def test_counts_from_footers(spark, tmp_dir):
    path = f"{tmp_dir}/foot"
    tables.merge_into_path(spark, _fact(spark, OLD), path, ["k", "d"], "month", tables.month_of("d"))
    counts = tables.footer_counts(spark, path, ["month"])
    assert {r.month: r.n_rows for r in counts.collect()} == {"2020-01": 2, "2020-02": 1, "2020-03": 1}
    assert "PushedAggregation: [COUNT(*)]" in counts._jdf.queryExecution().executedPlan().toString()
    assert tables.footer_counts(spark, path).first()[0] == 4


def test_repeated_source_keys_are_refused(spark, tmp_dir):
    src = _fact(spark, [("A", date(2020, 1, 5), 1.0), ("A", date(2020, 1, 5), 2.0)])
    with pytest.raises(checks.ConstraintViolation, match="repeat"):
        tables.merge_into_path(spark, src, f"{tmp_dir}/dup", ["k", "d"], unique_source=False)


def test_unpartitioned_target(spark, tmp_dir):
    path = f"{tmp_dir}/dim"
    d1 = spark.createDataFrame([("A", "x", 1.0)], "k string, lab string, v double")
    tables.merge_into_path(spark, d1, path, ["k"])
    d2 = spark.createDataFrame([("A", None, 2.0), ("B", "y", None)], "k string, lab string, v double")
    c = tables.merge_into_path(spark, d2, path, ["k"])
    assert c["inserted"] == 1 and c["matched_before"] == 1
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [("A", "x", 2.0), ("B", "y", None)]


def test_bucketed_target_merge_shuffles_only_source(spark):
    spark.sql("DROP TABLE IF EXISTS bucketed_target")
    t = spark.range(5000).selectExpr("id AS k", "cast(id AS double) AS v")
    tables.write_bucketed(t, "bucketed_target", ["k"], 8)
    s = spark.range(4990, 5010).selectExpr("id AS k", "cast(NULL AS double) AS v")
    merged = merge.upsert(spark.table("bucketed_target"), s, ["k"], strategy="shuffle")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan
    assert merged.count() == 5010


def test_both_sides_bucketed_merge_has_no_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, lo, hi in [("bk_target", 0, 5000), ("bk_source", 4990, 6000)]:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            df = spark.range(lo, hi).selectExpr("id AS k", "cast(id AS double) AS v")
            tables.write_bucketed(df, name, ["k"], 8)
        merged = merge.upsert(spark.table("bk_target"), spark.table("bk_source"), ["k"], strategy="shuffle")
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan, plan
        assert merged.count() == 6000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_rows_of_partitions_that_exist_are_joined(spark, tmp_dir):
    """A source over old and new months: the new ones' rows are staged with the others, unjoined."""
    from stellate.sinks import tables

    def rows(*days):
        return spark.createDataFrame([(k, d, v) for d in days for k, v in (("a", 1.0), ("b", None))], "k string, d string, v double").selectExpr("k", "to_date(d) AS d", "v")

    path, month = os.path.join(tmp_dir, "t"), tables.month_of("d")
    tables.merge_into_path(spark, rows("2020-01-01", "2020-02-01").selectExpr("k", "d", "9.0D AS v"), path, ["k", "d"], "month", month)
    joined, real = [], tables.merge.upsert
    tables.merge.upsert = lambda t, s, *a, **kw: (joined.append(s.count()), real(t, s, *a, **kw))[1]
    try:
        counts = tables.merge_into_path(spark, rows("2020-02-01", "2020-02-02", "2020-03-01", "2020-04-01"), path, ["k", "d"], "month", month, strategy="shuffle")
    finally:
        tables.merge.upsert = real
    assert joined == [4]  # of eight
    assert (counts["inserted"], counts["matched_before"], counts["total"], counts["rows_written"]) == (6, 2, 10, 8)
    got = sorted(((r.k, str(r.d), r.v) for r in tables.read_target(spark, path).collect()), key=str)
    want = [(k, d, 9.0) for k in "ab" for d in ("2020-01-01",)] + [("a", "2020-02-01", 1.0), ("b", "2020-02-01", 9.0)]
    want += [(k, d, v) for d in ("2020-02-02", "2020-03-01", "2020-04-01") for k, v in (("a", 1.0), ("b", None))]
    assert got == sorted(want, key=str)

import csv
import os
import random

from stellate.plans import health as H
from stellate.plans.load import load_wide_file, read_targets
from stellate.plans import metrics as M


def _csv(path, header, records):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(header)
        for r in records:
            w.writerow([r.get(c, "") for c in header])


def _header():
    cols = list(H.SOURCE_COLUMNS) + ["extra_unknown"]
    random.Random(7).shuffle(cols)  # the real column order is unknown; order must not matter
    return cols


def _row(iso, day, **kw):
    r = {"iso_code": iso, "date": day, "location": f"Land {iso}", "continent": "Europe"}
    r.update(kw)
    return r


def test_health_load_end_to_end(spark, tmp_dir):
    header = _header()
    assert len(H.SOURCE_COLUMNS) == 67
    recs = [
        _row("AAA", "2020-01-01", population="2.5", total_cases="5", new_cases="1"),
        # same key, fuller row → wins the dedup
        _row("AAA", "2020-01-01", population="2.5", total_cases="6", new_cases="2", icu_patients="3"),
        # latest day of AAA; its population is 3.5 → 4 (half to even)
        _row("AAA", "2020-01-10", population="3.5", total_tests="100", tests_units="tests performed"),
        _row("AAA", "2020-01-09", population="9.5"),
        _row("BBB", "2020-01-02", population="10", total_vaccinations="7", excess_mortality="1.5"),
        _row("", "2020-01-02", population="1"),  # NULL entity: counted, never merged
    ]
    p = os.path.join(tmp_dir, "daily.csv")
    _csv(p, header, recs)
    root = os.path.join(tmp_dir, "targets")
    res = load_wide_file(spark, p, H.HEALTH, root, audit=True)
    t = read_targets(spark, res.paths, H.HEALTH)

    dim = {r.cod_iso: r for r in t["locatii"].collect()}
    assert set(dim) == {"AAA", "BBB"}
    assert dim["AAA"].populatie == 4 and dim["AAA"].denumire == "Land AAA"
    assert dim["BBB"].populatie == 10

    cz = {(r.cod_iso, str(r.data)): r for r in t["cazuri_zilnice"].collect()}
    assert len(cz) == 4
    assert cz[("AAA", "2020-01-01")].total_cazuri == 6 and cz[("AAA", "2020-01-01")].cazuri_noi == 2.0
    assert t["testari_zilnice"].filter("cod_iso = 'AAA' AND data = DATE'2020-01-10'").first().unitati_testare == (
        "tests performed"
    )
    assert res.value("stages", "staging", "rows") == 6
    assert res.value("stages", "staging", "null_key_rows") == 1
    assert res.value("stages", "dedup", "rows") == 4
    for f in H.FACTS:
        assert res.value("upserts", f.name, "inserted") == 4
        assert res.value("upserts", f.name, "updated") == 4
        assert res.value("final_counts", f.name, "rows") == 4
        assert res.value("checks", f.name, "orphans") == 0
    assert res.value("copy", "source", "lines") == 6

    before = {name: sorted(map(tuple, df.collect()), key=str) for name, df in t.items()}
    # Second run of the same file: nothing inserted, same tables.
    res2 = load_wide_file(spark, p, H.HEALTH, root)
    assert all(res2.value("upserts", f.name, "inserted") == 0 for f in H.FACTS)
    assert res2.value("upserts", "locatii", "inserted") == 0
    t2 = read_targets(spark, res2.paths, H.HEALTH)
    for name in t2:
        assert before[name] == sorted(map(tuple, t2[name].collect()), key=str)

    # A newer file with empty cells never erases known values (S11); the later day wins
    # the dimension row.
    p2 = os.path.join(tmp_dir, "daily2.csv")
    _csv(p2, header, [_row("AAA", "2020-01-01", new_cases="7"), _row("AAA", "2020-02-01", population="")])
    res3 = load_wide_file(spark, p2, H.HEALTH, root)
    t3 = read_targets(spark, res3.paths, H.HEALTH)
    r = t3["cazuri_zilnice"].filter("cod_iso = 'AAA' AND data = DATE'2020-01-01'").first()
    assert r.total_cazuri == 6 and r.cazuri_noi == 7.0
    assert t3["locatii"].filter("cod_iso = 'AAA'").first().populatie == 4
    assert res3.value("upserts", "cazuri_zilnice", "inserted") == 1

    summary = {r.tbl: r for r in M.load_summary(res3.frame(spark)).collect()}
    assert summary["cazuri_zilnice"].total_after == 5


def test_header_only_file_loads_nothing(spark, tmp_dir):
    p = os.path.join(tmp_dir, "empty.csv")
    _csv(p, _header(), [])
    res = load_wide_file(spark, p, H.HEALTH, os.path.join(tmp_dir, "t"))
    assert res.value("stages", "staging", "rows") == 0
    ret = M.retention(res.frame(spark)).first()
    assert ret.retention_pct == 0.0
    assert all(res.value("final_counts", f.name, "rows") == 0 for f in H.FACTS)


def test_staging_table_kept_or_dropped(spark, tmp_dir):
    p = os.path.join(tmp_dir, "s.csv")
    _csv(p, _header(), [_row("AAA", "2020-01-01", population="1"), _row("AAA", "2020-01-01"), _row("", "2020-01-01")])
    root = os.path.join(tmp_dir, "t")
    load_wide_file(spark, p, H.HEALTH, root, staging_table=("stg_ns", "kept"), keep_staging=True)
    kept = spark.table("stg_ns.kept")  # the raw rows: duplicates, missing keys and all, no added column
    assert kept.count() == 3 and sorted(kept.columns) == sorted(_header())
    res = load_wide_file(spark, p, H.HEALTH, root, staging_table=("stg_ns", "dropped"))
    assert not spark.catalog.tableExists("stg_ns.dropped")
    assert res.value("stages", "drop_staging", "sec") >= 0


def test_not_null_label_strict_and_lenient(spark, tmp_dir):
    import pytest

    from stellate.operators.checks import ConstraintViolation

    p = os.path.join(tmp_dir, "n.csv")
    bad = _row("BBB", "2020-01-01", population="1")
    bad["location"] = ""
    _csv(p, _header(), [_row("AAA", "2020-01-01", population="1"), bad])
    with pytest.raises(ConstraintViolation):
        load_wide_file(spark, p, H.HEALTH, os.path.join(tmp_dir, "strict"))
    res = load_wide_file(spark, p, H.HEALTH, os.path.join(tmp_dir, "lenient"), strict=False)
    assert res.value("checks", "locatii", "null_violations") == 1
    assert res.value("final_counts", "locatii", "rows") == 1
    # the fact row of BBB is then an orphan, and the check reports it
    assert res.value("checks", "cazuri_zilnice", "orphans") == 1


def test_create_targets(spark, tmp_dir):
    from stellate.plans.load import create_targets

    paths = create_targets(spark, H.HEALTH, os.path.join(tmp_dir, "empty"))
    t = read_targets(spark, paths, H.HEALTH)
    assert set(t) == {"locatii", *[f.name for f in H.FACTS]}
    assert all(df.count() == 0 for df in t.values())
    assert t["cazuri_zilnice"].columns[:2] == ["cod_iso", "data"]


def test_full_and_incremental_reference_checks_agree(spark, tmp_dir):
    from stellate.plans.load import load_wide_frame
    from stellate.sources.csv import read_text_csv

    p = os.path.join(tmp_dir, "r.csv")
    bad = _row("BBB", "2020-01-01", population="1")
    bad["location"] = ""
    _csv(p, _header(), [_row("AAA", "2020-01-01", population="1"), bad, _row("AAA", "2020-01-02")])
    staged = read_text_csv(spark, p)
    a = load_wide_frame(spark, staged, H.HEALTH, os.path.join(tmp_dir, "a"), strict=False)
    b = load_wide_frame(spark, staged, H.HEALTH, os.path.join(tmp_dir, "b"), strict=False, check_references="full")
    for f in H.FACTS:
        assert a.value("checks", f.name, "orphans") == b.value("checks", f.name, "orphans") == 1


def test_null_and_bad_dates_and_extra_column(spark, tmp_dir):
    import pytest

    header = _header()
    recs = [
        _row("AAA", "2020-01-01", total_cases="1"),
        # same key and same score from known columns; the unknown extra column tips it
        _row("AAA", "2020-01-01", total_cases="2", extra_unknown="x"),
        _row("AAA", ""),  # NULL date: counted, never merged
    ]
    p = os.path.join(tmp_dir, "dates.csv")
    _csv(p, header, recs)
    res = load_wide_file(spark, p, H.HEALTH, os.path.join(tmp_dir, "t1"))
    assert res.value("stages", "staging", "null_key_rows") == 1
    t = read_targets(spark, res.paths, H.HEALTH)
    assert [r.total_cazuri for r in t["cazuri_zilnice"].collect()] == [2]

    bad = os.path.join(tmp_dir, "bad.csv")
    _csv(bad, header, [_row("AAA", "2020-1-5", total_cases="1"), _row("AAA", "2020-01-05", total_cases="2")])
    with pytest.raises(Exception):
        load_wide_file(spark, bad, H.HEALTH, os.path.join(tmp_dir, "t2"))
    lenient = load_wide_file(spark, bad, H.HEALTH, os.path.join(tmp_dir, "t3"), strict=False)
    assert lenient.value("stages", "staging", "null_key_rows") == 1
    assert lenient.value("final_counts", "cazuri_zilnice", "rows") == 1


def test_real_run_metrics(spark, tmp_dir):
    """The report's frames over a real run, not a recorded one."""
    p = os.path.join(tmp_dir, "m.csv")
    _csv(p, _header(), [_row(f"A{i}", f"2020-0{1 + i % 3}-01", population="1", total_cases=str(i)) for i in range(30)])
    res = load_wide_file(spark, p, H.HEALTH, os.path.join(tmp_dir, "t"))
    m, facts = res.frame(spark), [f.name for f in H.FACTS]
    assert {r.stage for r in M.stage_ranking(m).collect()} == {"create_staging", "copy", "dedup", "drop_staging", "commit"}
    shares = {r.phase: r for r in M.phase_shares(m, facts).collect()}
    assert set(shares) == {"copy", "dedup", "upserts", "commit"} and abs(sum(r.share for r in shares.values()) - 1) < 1e-9
    assert shares["upserts"].sec <= res.value("etl", "run", "sec")  # wall time, not a sum over parallel jobs
    t = M.throughput(m).first()
    assert t.processed == 30 and abs(t.duration_sec - shares["copy"].sec) < 0.5 and t.size_mb == os.path.getsize(p) / 1e6
    assert M.staging_total_sec(m).first()[0] > 0


def test_batched_load_equals_one_load(spark, tmp_dir):
    p = os.path.join(tmp_dir, "b.csv")
    _csv(p, _header(), [_row(f"A{i % 4}", f"2020-0{1 + i % 6}-0{1 + i % 9}", population="1", total_cases=str(i), icu_patients="2") for i in range(40)])
    one = load_wide_file(spark, p, H.HEALTH, os.path.join(tmp_dir, "one"))
    cut = load_wide_file(spark, p, H.HEALTH, os.path.join(tmp_dir, "cut"), batch_rows=10)
    a, b = (read_targets(spark, r.paths, H.HEALTH) for r in (one, cut))
    for name in a:
        assert sorted(map(tuple, a[name].collect()), key=str) == sorted(map(tuple, b[name].collect()), key=str)
    log = cut.batch_log(spark)
    assert log.filter("table = 'cazuri_zilnice'").count() > 1
    sums = {r.table: r for r in M.accumulate_batches(log).collect()}
    assert all(sums[f.name].inserted == one.value("upserts", f.name, "inserted") for f in H.FACTS)


def _tables(spark, res):
    return {n: sorted(map(tuple, df.collect()), key=str) for n, df in read_targets(spark, res.paths, H.HEALTH).items()}


def test_one_large_month_is_cut_into_ranges(spark, tmp_dir):
    """Also when one day has most rows; every batch reads its own files only."""
    from pyspark.sql import functions as F

    from stellate.plans import load

    p = os.path.join(tmp_dir, "b.csv")
    rows = [_row(f"A{i:03d}", "2020-03-05", population="1", total_cases=str(i)) for i in range(120)]
    rows += [_row("A001", f"2020-0{m}-0{d}", population="1", total_cases="9") for m in (1, 2, 3, 4) for d in range(1, 9)]
    _csv(p, _header(), rows)
    one = load_wide_file(spark, p, H.HEALTH, os.path.join(tmp_dir, "one"))
    cut = load_wide_file(spark, p, H.HEALTH, os.path.join(tmp_dir, "cut"), batch_rows=30)
    assert _tables(spark, one) == _tables(spark, cut)
    per = [r.inserted for r in cut.batch_log(spark).filter("table = 'cazuri_zilnice'").orderBy("batch").collect()]
    assert sum(per) == one.value("upserts", "cazuri_zilnice", "inserted") and len(per) >= 6 and max(per) <= 45
    wide = spark.read.csv(p, header=True).fillna("")
    k = load.keyed(wide, H.HEALTH)
    out = load.range_layout(k, H.ENTITY, 30).dealt(load.deduplicate_keyed(k, H.HEALTH), H.ENTITY)
    out.write.partitionBy(load.BATCH).parquet(os.path.join(tmp_dir, "laid"))
    batch = spark.read.schema(out.schema).parquet(os.path.join(tmp_dir, "laid")).filter(F.col(load.BATCH) == 2)
    plan = load.fact_rows(batch, H.FACTS[0])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__batch" in plan
    assert all("__batch=2/" in r.f for r in batch.select(F.col("_metadata.file_path").alias("f")).distinct().collect())


def test_failed_load_goes_on_after_its_last_batch(spark, tmp_dir, monkeypatch):
    import pytest

    from stellate.sinks import tables

    p = os.path.join(tmp_dir, "r.csv")
    _csv(p, _header(), [_row(f"A{i % 4}", f"2020-0{1 + i % 6}-0{1 + i % 9}", population="1", total_cases=str(i)) for i in range(40)])
    whole = load_wide_file(spark, p, H.HEALTH, os.path.join(tmp_dir, "whole"), batch_rows=6)
    root, real, merged = os.path.join(tmp_dir, "broken"), tables.merge_into_path, []

    def failing(spark, source, path, *args, **kwargs):
        if path.endswith("testari_zilnice") and kwargs["batch"].endswith("/2"):
            raise RuntimeError("power cut")
        counts = real(spark, source, path, *args, **kwargs)
        merged.append((kwargs["batch"], counts["replayed"]))
        return counts

    monkeypatch.setattr(tables, "merge_into_path", failing)
    with pytest.raises(RuntimeError, match="power cut"):
        load_wide_file(spark, p, H.HEALTH, root, batch_rows=6, run_id="day1")
    before = {b for b, _ in merged}
    assert {"day1/locatii", "day1/testari_zilnice/0", "day1/testari_zilnice/1"} <= before
    monkeypatch.setattr(tables, "merge_into_path", lambda *a, **k: (c := real(*a, **k), merged.append((k["batch"], c["replayed"])))[0])
    merged.clear()
    res = load_wide_file(spark, p, H.HEALTH, root, batch_rows=6, run_id="day1")
    assert {b for b, replayed in merged if replayed} == before  # none of them is merged again
    assert _tables(spark, res) == _tables(spark, whole)
    for name in whole.paths:
        for m in ("inserted", "updated", "matched_before"):
            assert res.value("upserts", name, m) == whole.value("upserts", name, m)
    assert [r[:4] for r in sorted(res.batches)] == [r[:4] for r in sorted(whole.batches)]
    assert not os.path.exists(os.path.join(root, "_runs", "day1"))


def test_no_staged_folder_is_left(spark, tmp_dir):
    from stellate.session import checkpoint_dir
    from stellate.sinks.files import Files

    staged = f"{checkpoint_dir(spark)}/staged"
    files = Files(spark, staged)
    p = os.path.join(tmp_dir, "c.csv")
    _csv(p, _header(), [_row("AAA", "2020-01-01", population="1")])
    before = set(files.names(staged))
    load_wide_file(spark, p, H.HEALTH, os.path.join(tmp_dir, "t"))
    assert set(files.names(staged)) == before


def test_final_counts_agree_with_a_full_count(spark, tmp_dir):
    from stellate.plans.load import load_wide_frame
    from stellate.sources.csv import read_text_csv

    root = os.path.join(tmp_dir, "t")
    for k, day in enumerate(("2020-01-01", "2020-02-01", "2020-01-01")):
        p = os.path.join(tmp_dir, f"f{k}.csv")
        _csv(p, _header(), [_row(f"A{i}", day, population="1") for i in range(k + 3)])
        kept = load_wide_frame(spark, read_text_csv(spark, p), H.HEALTH, root)
    full = load_wide_frame(spark, read_text_csv(spark, p), H.HEALTH, root, full_counts=True)
    for name in kept.paths:
        assert kept.value("final_counts", name, "rows") == full.value("final_counts", name, "rows")


def test_ranges_of_a_month_are_merged_once(spark, tmp_dir, monkeypatch):
    """Also into a month that the target has: each range still has its own counts."""
    from stellate.sinks import tables

    old, new = os.path.join(tmp_dir, "old.csv"), os.path.join(tmp_dir, "new.csv")
    _csv(old, _header(), [_row(f"A{i:03d}", "2020-03-05", population="1", total_cases="7") for i in range(0, 90, 2)])
    _csv(new, _header(), [_row(f"A{i:03d}", f"2020-03-0{5 + i % 2}", population="1", new_cases=str(i)) for i in range(90)])
    real, calls, loads = tables.merge_into_path, [], {}
    monkeypatch.setattr(tables, "merge_into_path", lambda *a, **k: (calls.append(a[2]), real(*a, **k))[1])
    for name, rows in (("one", None), ("cut", 20)):
        root = os.path.join(tmp_dir, name)
        load_wide_file(spark, old, H.HEALTH, root, batch_rows=rows)
        calls.clear()
        loads[name] = load_wide_file(spark, new, H.HEALTH, root, batch_rows=rows)
        assert len(calls) == 1 + len(H.FACTS)  # the dimension, and one merge of the month for each fact
    assert _tables(spark, loads["one"]) == _tables(spark, loads["cut"])
    for f in H.FACTS:
        log = [b for b in loads["cut"].batches if b[0] == f.name]
        assert len(log) >= 4 and sum(b[2] for b in log) == 45 and sum(b[3] for b in log) == 90
        assert max(b[3] for b in log) < 45
        assert loads["cut"].value("upserts", f.name, "matched_before") == 45


def test_wide_rows_are_staged_packed(spark, tmp_dir, monkeypatch):
    """Every cell comes back, also an empty one and one that holds the packing's own marks."""
    from stellate.operators import dedup
    from stellate.sinks import tables

    staged, real = [], tables.write_staged
    monkeypatch.setattr(tables, "write_staged", lambda df, name, *a, **k: (staged.append((name, df.columns)), real(df, name, *a, **k))[1])
    p, odd = os.path.join(tmp_dir, "p.csv"), "x\x01y\x02z"
    _csv(p, _header(), [_row("AAA", "2020-01-01", population="2", tests_units=odd), _row("AAA", "2020-01-02", total_cases="5")])
    t = read_targets(spark, load_wide_file(spark, p, H.HEALTH, os.path.join(tmp_dir, "t")).paths, H.HEALTH)
    columns = dict(staged)["staging"]
    assert dedup.PACKED in columns and "total_cases" not in columns
    assert {r.unitati_testare for r in t["testari_zilnice"].collect()} == {odd, None}
    assert {r.total_cazuri for r in t["cazuri_zilnice"].collect()} == {5, None}


def test_deduplicated_rows_stay_packed_by_target(spark, tmp_dir, monkeypatch):
    """A target opens its own cells only, as text of its own; a lenient load opens all to count bad ones."""
    from stellate.operators import dedup
    from stellate.plans import load

    written, real = [], load._write_deduplicated
    monkeypatch.setattr(load, "_write_deduplicated", lambda df, *a: (written.append(df.columns), real(df, *a))[1])
    odd = "x\x00\x01\U0010ffffz"
    p = os.path.join(tmp_dir, "p.csv")
    _csv(p, _header(), [_row(f"A{i}", f"2020-0{1 + i}-01", population="2.5", tests_units=odd, total_cases=str(i), icu_patients=" 1e2", hosp_patients="7") for i in range(3)])
    for strict in (True, False):
        found = _tables(spark, load_wide_file(spark, p, H.HEALTH, os.path.join(tmp_dir, f"t{strict}"), strict=strict))
        assert {r[H.TESTARI_ZILNICE.value_names.index("unitati_testare") + 2] for r in found["testari_zilnice"]} == {odd}
        assert sorted(r[2] for r in found["cazuri_zilnice"]) == [0, 1, 2] and {r[3] for r in found["locatii"]} == {2}
        assert {(r[2], r[4]) for r in found["spitalizari_zilnice"]} == {(100.0, 7.0)}
    strict, lenient = written
    assert "total_cases" not in strict and {dedup.group_text(m.name) for m in (H.LOCATII, *H.FACTS)} <= set(strict)
    assert "total_cases" in lenient

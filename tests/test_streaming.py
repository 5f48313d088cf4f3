import os

from pyspark.sql import functions as F

from stellate.operators import merge
from stellate.sinks import tables
from stellate.streaming.upsert import upsert_stream


def _write_batch(spark, folder, name, data):
    spark.createDataFrame(data, "k string, d date, v double").coalesce(1).write.parquet(os.path.join(folder, name))


def test_stream_equals_batch_and_restart_is_noop(spark, tmp_dir):
    from datetime import date

    inbox = os.path.join(tmp_dir, "inbox")
    os.makedirs(inbox)
    target = os.path.join(tmp_dir, "target")
    ckpt = os.path.join(tmp_dir, "ckpt")
    f1 = [("A", date(2020, 1, 1), 1.0), ("B", date(2020, 1, 2), None)]
    f2 = [("B", date(2020, 1, 2), 2.0), ("C", date(2020, 2, 1), 3.0), ("A", date(2020, 1, 1), None)]
    _write_batch(spark, inbox, "f1", f1)
    _write_batch(spark, inbox, "f2", f2)
    schema = "k string, d date, v double"

    def start():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(inbox, "*"))
        log = []
        q = upsert_stream(stream, lambda b: b, target, ["k", "d"], ckpt, "month", lambda: tables.month_of("d"), log=log)
        q.awaitTermination()
        assert q.exception() is None
        return log

    log = start()
    assert len(log) == 2
    got = sorted((r.k, str(r.d), r.v) for r in spark.read.parquet(target).collect())
    # Batch result of the same two files merged in order.
    a = spark.createDataFrame(f1, schema)
    b = spark.createDataFrame(f2, schema)
    want = sorted((r.k, str(r.d), r.v) for r in merge.upsert(merge.upsert(a.limit(0), a, ["k", "d"]), b, ["k", "d"]).collect())
    assert got == want == [("A", "2020-01-01", 1.0), ("B", "2020-01-02", 2.0), ("C", "2020-02-01", 3.0)]
    # Restart on the same checkpoint: nothing is processed twice.
    assert start() == []
    # A new file is picked up on the next run.
    _write_batch(spark, inbox, "f3", [("D", date(2020, 3, 1), 4.0)])
    assert len(start()) == 1
    assert spark.read.parquet(target).filter(F.col("k") == "D").count() == 1


def test_same_key_twice_in_one_batch(spark, tmp_dir):
    from datetime import date

    inbox = os.path.join(tmp_dir, "inbox2")
    os.makedirs(inbox)
    target = os.path.join(tmp_dir, "target2")
    _write_batch(spark, inbox, "a", [("A", date(2020, 1, 1), None)])
    _write_batch(spark, inbox, "b", [("A", date(2020, 1, 1), 5.0)])
    stream = spark.readStream.schema("k string, d date, v double").option("maxFilesPerTrigger", 2).parquet(
        os.path.join(inbox, "*")
    )
    q = upsert_stream(stream, lambda b: b, target, ["k", "d"], os.path.join(tmp_dir, "ck2"), "month", lambda: tables.month_of("d"))
    q.awaitTermination()
    got = [(r.k, r.v) for r in spark.read.parquet(target).collect()]
    assert got == [("A", 5.0)]


def test_failed_and_replayed_batches(spark, tmp_dir, monkeypatch):
    """A micro-batch that fails leaves nothing staged; one that was merged when the driver was
    lost comes again and counts once."""
    from datetime import date

    import pytest

    from stellate.session import checkpoint_dir
    from stellate.sinks.files import Files

    inbox, target, ckpt = (os.path.join(tmp_dir, n) for n in ("inbox3", "target3", "ck3"))
    _write_batch(spark, inbox, "a", [("A", date(2020, 1, 1), 1.0), ("B", date(2020, 1, 2), 2.0)])
    files, staged = Files(spark, tmp_dir), f"{checkpoint_dir(spark)}/staged"
    real = tables.merge_into_path

    def run(log):
        stream = spark.readStream.schema("k string, d date, v double").parquet(os.path.join(inbox, "*"))
        upsert_stream(stream, lambda b: b, target, ["k", "d"], ckpt, "month", lambda: tables.month_of("d"), log=log).awaitTermination()

    def failing(after):
        def merge_then_fail(*args, **kwargs):
            if after:
                real(*args, **kwargs)
            raise RuntimeError("power cut")

        return merge_then_fail

    before = set(files.names(staged))
    for after in (False, True):
        monkeypatch.setattr(tables, "merge_into_path", failing(after))
        with pytest.raises(Exception, match="power cut"):
            run([])
        assert {n for n in files.names(staged) if n.startswith("stream-batch")} <= before
    monkeypatch.undo()
    log = []
    run(log)
    assert [(b, c["inserted"], c["matched_before"], c["replayed"]) for b, c in log] == [(0, 2, 0, True)]
    assert tables.row_count(spark, target) == 2


def test_progress_history(spark, tmp_dir):
    from datetime import date

    from stellate.streaming.progress import progress_history, recorded

    inbox, history = os.path.join(tmp_dir, "inbox4"), os.path.join(tmp_dir, "history")
    for i in range(3):
        _write_batch(spark, inbox, f"f{i}", [("A", date(2020, 1, 1), 1.0)] * (i + 1))
    with recorded(spark, history):
        stream = spark.readStream.schema("k string, d date, v double").option("maxFilesPerTrigger", 1).parquet(os.path.join(inbox, "*"))
        stream.writeStream.format("noop").option("checkpointLocation", os.path.join(tmp_dir, "ck4")).trigger(availableNow=True).start().awaitTermination()
    rows = progress_history(spark, history).orderBy("batch").collect()
    assert sorted(r.rows for r in rows if r.rows) == [1, 2, 3] and all(r.sec >= 0 for r in rows)


def test_wide_file_stream_equals_batch_loads(spark, tmp_dir):
    from tests.test_load import _csv, _header, _row

    from stellate.plans import health as H
    from stellate.plans.load import load_wide_file, read_targets
    from stellate.streaming.upsert import load_wide_stream

    header = _header()
    inbox = os.path.join(tmp_dir, "wide-inbox")
    os.makedirs(inbox)
    day1 = [_row("AAA", "2020-01-01", population="2.5", total_cases="5"), _row("BBB", "2020-01-01", new_cases="1")]
    day2 = [_row("AAA", "2020-01-01", new_cases="7"), _row("AAA", "2020-01-02", population="3.5")]
    _csv(os.path.join(inbox, "d1.csv"), header, day1)
    _csv(os.path.join(inbox, "d2.csv"), header, day2)
    # A file stream takes files in modification-time order; d1 arrived first.
    import time

    now = time.time()
    os.utime(os.path.join(inbox, "d1.csv"), (now - 120, now - 120))
    os.utime(os.path.join(inbox, "d2.csv"), (now - 60, now - 60))

    log = []
    q = load_wide_stream(
        spark, inbox, H.HEALTH, os.path.join(tmp_dir, "stream-targets"), os.path.join(tmp_dir, "wck"), header, log=log
    )
    q.awaitTermination()
    assert q.exception() is None and len(log) == 2

    batch_root = os.path.join(tmp_dir, "batch-targets")
    load_wide_file(spark, os.path.join(inbox, "d1.csv"), H.HEALTH, batch_root)
    res = load_wide_file(spark, os.path.join(inbox, "d2.csv"), H.HEALTH, batch_root)
    want = read_targets(spark, res.paths, H.HEALTH)
    got = read_targets(spark, log[-1][1].paths, H.HEALTH)
    for name in want:
        assert sorted(map(tuple, got[name].collect()), key=str) == sorted(map(tuple, want[name].collect()), key=str)
    cz = got["cazuri_zilnice"].filter("cod_iso = 'AAA' AND data = DATE'2020-01-01'").first()
    assert cz.total_cazuri == 5 and cz.cazuri_noi == 7.0
    assert got["locatii"].filter("cod_iso = 'AAA'").first().populatie == 4

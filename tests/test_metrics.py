import pytest

from stellate.plans import metrics as M

FACTS = ["cazuri_zilnice", "testari_zilnice", "vaccinari_zilnice", "spitalizari_zilnice", "mortalitate_exces_zilnica"]

RUN = [
    ("stages", "create_staging", "sec", 0.71),
    ("stages", "copy", "sec", 19.67),
    ("stages", "dedup", "sec", 8.38),
    ("stages", "drop_staging", "sec", 0.27),
    ("stages", "commit", "sec", 0.04),
    ("stages", "staging", "rows", 429435),
    ("stages", "dedup", "rows", 421665),
    ("copy", "source", "rows", 429435),
    ("copy", "source", "lines", 429435),
    ("copy", "source", "sec", 19.63),
    ("copy", "source", "bytes", 98.39e6),
    ("upserts", "locatii", "sec", 0.69),
    ("upserts", "locatii", "inserted", 255),
    ("upserts", "locatii", "updated", 255),
    ("upserts", "cazuri_zilnice", "sec", 101.82),
    ("upserts", "testari_zilnice", "sec", 76.64),
    ("upserts", "vaccinari_zilnice", "sec", 75.85),
    ("upserts", "spitalizari_zilnice", "sec", 59.95),
    ("upserts", "mortalitate_exces_zilnica", "sec", 58.41),
    ("final_counts", "locatii", "rows", 255),
    ("final_counts", "cazuri_zilnice", "rows", 421665),
]


@pytest.fixture()
def m(spark):
    return M.metrics_frame(spark, RUN)


def test_throughput(m):
    r = M.throughput(m).first()
    assert round(r.rows_per_sec) == round(429435 / 19.63) and round(r.mb_per_sec, 2) == 5.01


def test_retention(m):
    assert round(M.retention(m).first().retention_pct, 1) == 98.2


def test_stage_ranking(m):
    assert [r.stage for r in M.stage_ranking(m).collect()] == ["copy", "dedup", "create_staging", "drop_staging", "commit"]


def test_upserts_and_phases(m):
    assert round(M.upsert_total_sec(m, FACTS).first()[0], 2) == 372.67
    shares = {r.phase: r for r in M.phase_shares(m, FACTS).collect()}
    assert set(shares) == {"copy", "dedup", "upserts", "commit"}
    assert abs(sum(r.share for r in shares.values()) - 1.0) < 1e-9


def test_staging_total_excludes_upserts(m):
    assert round(M.staging_total_sec(m).first()[0], 2) == 29.07


def test_load_summary(m):
    s = {r.tbl: r for r in M.load_summary(m).collect()}
    assert s["locatii"].inserted == 255 and s["locatii"].total_after == 255
    assert s["cazuri_zilnice"].total_after == 421665


def test_accumulate_batches(spark):
    log = spark.createDataFrame([("t", 10, 10, 1.0), ("t", 5, 5, 0.5), ("u", 1, 1, 0.1)], "table string, inserted long, updated long, sec double")
    got = {r.table: (r.inserted, r.updated) for r in M.accumulate_batches(log).collect()}
    assert got == {"t": (15, 15), "u": (1, 1)}


def test_zero_duration_gives_zero_rate(spark):
    m = M.metrics_frame(spark, [("copy", "source", "rows", 10), ("copy", "source", "bytes", 1), ("copy", "source", "sec", 0), ("copy", "source", "lines", 10)])
    assert M.throughput(m).first().rows_per_sec == 0.0


def test_append_history(spark, m, tmp_dir):
    path = f"{tmp_dir}/history"
    M.append_history(m, path, "run-1")
    M.append_history(m, path, "run-2")
    h = spark.read.parquet(path)
    assert h.count() == 2 * len(RUN)
    assert sorted(r.run_id for r in h.select("run_id").distinct().collect()) == ["run-1", "run-2"]

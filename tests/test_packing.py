from pyspark.sql import functions as F

from stellate.functions import packing
from stellate.operators import dedup

CELLS = [None, "", "a", "\x00", "\x01", "\x02", "\x03", "\x02\x05\x03", "a\x00", "a\x01b", "ab", "\U0010ffff", "é"]


def test_packed_cells_come_back_and_sort_as_the_cells(spark):
    rows = [(a, b) for a in CELLS for b in CELLS]
    df = spark.createDataFrame(rows, "a string, b string").withColumn("p", packing.packed(["a", "b"]))
    parts = df.withColumn("parts", packing.opened(F.col("p")))
    back = parts.select("a", "b", *[packing.cell(F.col("parts"), i).alias(f"x{i}") for i in range(2)])
    assert back.where("a <=> x0 and b <=> x1").count() == len(rows)
    by_cells = df.orderBy(F.col("a").asc_nulls_last(), F.col("b").asc_nulls_last()).select("a", "b").collect()
    assert df.orderBy("p").select("a", "b").collect() == by_cells


def _wide(spark, order=1):
    names = [f"c{i:02d}" for i in range(dedup.PACK_FROM)]
    full = [str(i) for i in range(len(names))]
    rows = [
        ("A", "x", *full[:-1], None),  # one cell less
        ("A", "y", *full[:-1], "9"),
        ("A", "z", *full[:-1], "10"),  # as text before 9
        ("B", "x", None, *full[1:]),  # a tie: a NULL sorts last
        ("B", "y", *full[:-1], ""),
        (None, "n", *["\x01"] * len(names)),
    ]
    return spark.createDataFrame(rows[::order], ", ".join(f"{c} string" for c in ("k", "label", *names)))


def test_wide_rows_travel_packed_with_the_same_choice(spark):
    for order in (1, -1):
        kept = dedup.most_complete(_wide(spark, order), ["k"], exclude=["label"])
        assert kept.columns == [*_wide(spark).columns, dedup.SCORE]
        assert {r["k"]: r["label"] for r in kept.collect()} == {"A": "z", "B": "y", None: "n"}
        assert kept.where("k is null").first()["c00"] == "\x01"
        assert kept.where("k = 'B'").first()["c15"] == ""
    plan = dedup.most_complete(_wide(spark), ["k"], exclude=["label"])._jdf.queryExecution().executedPlan().toString()
    exchange = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in exchange and dedup.PACKED in exchange.splitlines()[1]  # the packed text is what is sorted


def test_latest_row_computes_its_input_once(spark):
    df = spark.createDataFrame([("A", "2020-01-01", None), ("A", "2020-01-02", "1"), ("A", "2020-01-02", None), ("B", None, "2"), (None, "2020-01-01", "3")], "k string, d string, v string")
    latest = dedup.latest_per_entity(df, "k", "d")
    assert latest._jdf.queryExecution().executedPlan().toString().count("Scan ") == 1
    assert [tuple(r) for r in latest.collect()] == [("A", "2020-01-02", "1")]


def test_wide_session_keeps_settings(spark):
    from stellate.session import METHOD_BYTES, WIDE_TASK_BYTES, wide_session

    own = wide_session(spark)
    assert own.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    assert own.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
    assert int(own.conf.get("spark.sql.codegen.hugeMethodLimit")) == METHOD_BYTES
    assert int(own.conf.get("spark.sql.files.maxPartitionBytes")) == WIDE_TASK_BYTES


def test_groups_of_cells_are_opened_on_their_own(spark):
    names = [f"c{i:02d}" for i in range(dedup.PACK_FROM)]
    rows = [(str(i), *[CELLS[(i + j) % len(CELLS)] for j in range(len(names))]) for i in range(len(CELLS))]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ("k", *names)))
    wide, groups = dedup.packing_of(df, ["k"]), {"one": ["c07", "c02", "c11"], "two": ["c02"], "none": []}
    kept = dedup.most_complete_packed(wide.packed(df), wide, ["k"], groups=groups)
    assert "c07" not in kept.columns and dedup.group_text("none") not in kept.columns
    for name, cells in groups.items():
        found = dedup.open_group(kept, name, cells).select("k", *cells)
        assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, df.select("k", *cells).collect()), key=str)

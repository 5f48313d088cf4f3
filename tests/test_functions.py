import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stellate.functions import expressions as X
from stellate.operators import mapping


def test_missing_to_null_and_present(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "c string")
    out = df.select(X.missing_to_null("c").alias("v"), X.is_present("c").alias("p")).collect()
    assert [(r.v, r.p) for r in out] == [("a", True), (None, False), (None, False)]


def test_round_half_even(spark):
    # ROUND(double)::bigint rounds half to even; F.round would give 3 and 4 → 3, 4.
    df = spark.createDataFrame([("2.5",), ("3.5",), ("-2.5",), ("0.5",), ("1.49",)], "p string")
    got = [r[0] for r in df.select(X.text_to_rounded_bigint("p")).collect()]
    assert got == [2, 4, -2, 0, 1]


def test_strict_bigint_rejects_decimal_text(spark):
    # S4: '5.0' is not a bigint; strict mode raises, lenient gives NULL.
    df = spark.createDataFrame([("5.0",)], "x string")
    with pytest.raises(PySparkException):
        df.select(X.to_bigint("x")).collect()
    assert df.select(X.to_bigint("x", strict=False)).first()[0] is None


def test_strict_double_rejects_garbage(spark):
    df = spark.createDataFrame([("abc",)], "x string")
    with pytest.raises(PySparkException):
        df.select(X.to_double("x")).collect()
    assert df.select(X.to_double("x", strict=False)).first()[0] is None


def test_strict_date_format(spark):
    # S18: '2020-1-5' is rejected by the strict pattern instead of folding into 2020-01-05.
    ok = spark.createDataFrame([("2020-01-05",)], "d string").select(X.to_date("d")).first()[0]
    assert str(ok) == "2020-01-05"
    with pytest.raises(PySparkException):
        spark.createDataFrame([("2020-1-5",)], "d string").select(X.to_date("d")).collect()


def test_completeness_score_counts_present_cells(spark):
    df = spark.createDataFrame([("1", "", None, "x"), ("", "", "", "")], "a string, b string, c string, d string")
    got = [r[0] for r in df.select(X.completeness_score(["a", "b", "c", "d"])).collect()]
    assert got == [2, 0]


def test_wide_score_64_terms(spark):
    cols = [f"c{i}" for i in range(64)]
    df = spark.createDataFrame([tuple(str(i) if i % 3 else "" for i in range(64))], ",".join(f"{c} string" for c in cols))
    assert df.select(X.completeness_score(cols)).first()[0] == sum(1 for i in range(64) if i % 3)


def test_qident_odd_names(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, `c d` int")
    assert df.select(X.col("a.b"), X.col("c d")).first() == (1, 2)
    assert X.qident("x`y") == "`x``y`"


def test_nan_is_not_null(spark):
    # NaN is a value, so it wins a COALESCE.
    v = spark.range(1).select(F.coalesce(F.lit(float("nan")), F.lit(1.0))).first()[0]
    assert math.isnan(v)


def test_quarantine_splits_bad_rows(spark):
    tm = mapping.table("t", [("k", "k", "text")], [("n", "n", "bigint")])
    df = spark.createDataFrame([("a", "5"), ("b", "5.0"), ("c", ""), ("d", "abc")], "k string, n string")
    good, bad = mapping.quarantine(df, tm)
    assert sorted(r.k for r in good.collect()) == ["a", "c"]
    assert sorted(r.k for r in bad.collect()) == ["b", "d"]


def test_lenient_date_gives_null(spark):
    df = spark.createDataFrame([("2020-1-5",), ("2020-01-05",), ("x",)], "d string")
    got = [r[0] for r in df.select(X.to_date("d", strict=False)).collect()]
    assert got[0] is None and str(got[1]) == "2020-01-05" and got[2] is None


def test_score_counts_typed_columns(spark):
    df = spark.createDataFrame([(5, None, "x"), (None, 0.0, "")], "a bigint, b double, c string")
    assert [r[0] for r in df.select(X.completeness_score(["a", "b", "c"])).collect()] == [2, 1]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("kind,bad", [
    ("double", "abc"), ("double", "1d"), ("double", "2f"), ("double", "0x10"), ("double", "1,5"), ("bigint", "5.0"), ("bigint", "abc"),
    ("bigint", "99999999999999999999"), ("bigint_round", "nan"), ("bigint_round", "1e30"), ("date", "2020-1-5"), ("date", "junk"), ("date", "2020-02-30"),
])
def test_strict_casts_do_not_depend_on_the_session(spark, ansi, kind, bad):
    from stellate.operators.mapping import convert

    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(bad,)], "x string")
        with pytest.raises(Exception, match="not a"):
            df.select(convert("x", kind)).collect()
        assert df.select(convert("x", kind, strict=False)).first()[0] is None
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_good_cells_convert_alike(spark, ansi):
    from stellate.operators.mapping import convert

    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(" 1.5e2 ", "-7", "2.5", "2020-01-05", "NaN"), ("", "", None, "", "-inf")], "a string, b string, c string, d string, e string")
        rows = df.select(convert("a", "double"), convert("b", "bigint"), convert("c", "bigint_round"), convert("d", "date"), convert("e", "double")).collect()
        assert [str(v) for v in rows[0]] == ["150.0", "-7", "2", "2020-01-05", "nan"]
        assert list(rows[1])[:4] == [None] * 4 and rows[1][4] == float("-inf")
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_plain_rows_read_numbers_as_a_search_does(spark):
    """One search of a row in place of one of each cell: the same values, also of odd text."""
    texts = "1 -1 +1 1.5 1. .5 . - + e 1e5 1E-5 1.e5 .e5 1e 1e+ 1-2 --1 1.2.3 1e400 -0 007 9223372036854775807 9223372036854775808 5.0 1_0".split()
    texts += ["", None, " 1 ", "\t2", "1d", "1f", "0x10", "0x1p3", "inf", "NaN", "Infinity", "1,5", "١", "\x001"]
    df = spark.createDataFrame([(t,) for t in texts], "a string").withColumn("p", X.plain_numbers(["a"]))
    for read in (X.to_double, X.to_bigint, X.text_to_rounded_bigint):
        both = df.select("a", "p", read("a", False).cast("string").alias("searched"), read("a", False, F.col("p")).cast("string").alias("quick")).collect()
        assert [r for r in both if r.searched != r.quick] == []
        assert {r.p for r in both} == {True, False}

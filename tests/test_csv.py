import os

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from stellate.sources import csv as C


def _write(d, name, text):
    p = os.path.join(d, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


def test_header_trimmed_values_not(spark, tmp_dir):
    # S1
    p = _write(tmp_dir, "a.csv", " iso_code , date \n X , 2020-01-01\n")
    df = C.read_text_csv(spark, p, required=["iso_code", "date"])
    assert df.columns == ["iso_code", "date"]
    r = df.first()
    assert r.iso_code == " X " and r.date == " 2020-01-01"


def test_empty_and_quoted_empty_are_missing(spark, tmp_dir):
    # Unquoted empty → NULL; quoted empty → '' or NULL; both missing after NULLIF.
    from stellate.functions.expressions import missing_to_null

    p = _write(tmp_dir, "b.csv", 'a,b,c\nA,,""\n')
    df = C.read_text_csv(spark, p)
    r = df.select(*[missing_to_null(c).alias(c) for c in df.columns]).first()
    assert (r.a, r.b, r.c) == ("A", None, None)
    kept = C.read_text_csv(spark, p, keep_quoted_empty=True).first()
    assert kept.b is None and kept.c == ""


def test_ragged_rows_fail(spark, tmp_dir):
    # FAILFAST rejects a short row and a long row.
    short = _write(tmp_dir, "s.csv", "a,b,c\n1,2\n")
    long = _write(tmp_dir, "l.csv", "a,b,c\n1,2,3,4\n")
    for p in (short, long):
        with pytest.raises((PySparkException, Py4JJavaError)):
            C.read_text_csv(spark, p).collect()


def test_quoted_newline_multiline(spark, tmp_dir):
    # One row with multiLine; the physical line count differs from the row count.
    p = _write(tmp_dir, "m.csv", 'a,b\n1,"x\ny"\n2,z\n')
    df = C.read_text_csv(spark, p, multiline=True)
    assert df.count() == 2 and df.filter("a = '1'").first().b == "x\ny"
    audit = C.load_audit(spark, p, df)
    assert audit["lines"] == 3 and audit["rows"] == 2 and not audit["lines_match_rows"]
    assert audit["bytes"] == os.path.getsize(p)


def test_missing_required_and_duplicate_columns(spark, tmp_dir):
    p = _write(tmp_dir, "r.csv", "iso_code,x\nA,1\n")
    with pytest.raises(C.SourceError, match="required"):
        C.read_text_csv(spark, p, required=["iso_code", "date"])
    d = _write(tmp_dir, "d.csv", "a, a\n1,2\n")
    with pytest.raises(C.SourceError, match="duplicate"):
        C.read_text_csv(spark, d)


def test_missing_file(spark, tmp_dir):
    with pytest.raises(C.SourceError, match="not found"):
        C.read_text_csv(spark, os.path.join(tmp_dir, "nope.csv"))


def test_header_only_file(spark, tmp_dir):
    p = _write(tmp_dir, "e.csv", "iso_code,date\n")
    df = C.read_text_csv(spark, p, required=["iso_code", "date"])
    assert df.count() == 0 and df.columns == ["iso_code", "date"]
    assert C.line_count(spark, p) == 0


def test_exact_duplicate_names_are_refused(spark, tmp_dir):
    p = _write(tmp_dir, "x.csv", "iso_code,date,x,x\nA,2020-01-01,1,2\n")
    with pytest.raises(C.SourceError, match="duplicate"):
        C.read_text_csv(spark, p)


def test_folder_of_files_in_different_orders(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "many")
    os.makedirs(folder)
    _write(folder, "1.csv", "iso_code,date,x,y\nA,2020-01-01,1,2\n")
    _write(folder, "2.csv", "date, iso_code,y,x\n2020-01-02,B,4,3\n")
    _write(folder, "3.csv", "")
    got = sorted(tuple(r) for r in C.read_text_csv(spark, folder, required=["iso_code"]).select("iso_code", "date", "x", "y").collect())
    assert got == [("A", "2020-01-01", "1", "2"), ("B", "2020-01-02", "3", "4")]
    _write(folder, "4.csv", "iso_code,date,x,z\nC,2020-01-03,5,6\n")
    with pytest.raises(C.SourceError, match="not in all files"):
        C.read_text_csv(spark, folder)


def test_compressed_file_header(spark, tmp_dir):
    import gzip

    with gzip.open(os.path.join(tmp_dir, "z.csv.gz"), "wt") as f:
        f.write("a,b\n1,2\n")
    assert [tuple(r) for r in C.read_text_csv(spark, os.path.join(tmp_dir, "z.csv.gz")).collect()] == [("1", "2")]


def test_first_lines_of_many_files_need_few_tasks(spark, tmp_dir, monkeypatch):
    for i in range(300):
        os.makedirs(os.path.join(tmp_dir, f"part={i}"))
        _write(tmp_dir, f"part={i}/a.csv", "﻿a,b\r\n1,2\r\n" if i % 2 else f"a,b{i}\n1,2\n")
    _write(tmp_dir, "empty.csv", "")
    _write(tmp_dir, "blank.csv", "\nx\n")
    df = C.first_lines(spark, tmp_dir)
    assert df.rdd.getNumPartitions() < 100  # 302 before: one for each file
    want = sorted(["a,b"] * 150 + [f"a,b{i}" for i in range(0, 300, 2)] + [""])
    assert sorted(r["line"] for r in df.collect()) == want
    monkeypatch.setattr(C, "SMALL_FILE", 10)  # most are large now: read up to their first rows
    assert sorted(r["line"] for r in C.first_lines(spark, tmp_dir).collect()) == want


def test_a_large_tree_is_listed_some_folders_at_a_time(spark, tmp_dir, monkeypatch):
    """The driver never holds all files' listing; the lines are those of one scan."""
    for i in range(12):
        folder = os.path.join(tmp_dir, f"_users={i}" if i % 2 else f"users={i}")
        for j in range(5):
            os.makedirs(os.path.join(folder, f"part={j}"))
            _write(folder, f"part={j}/a.csv", f"a,b{i}x{j}\n1,2\n")
    os.makedirs(os.path.join(tmp_dir, "_hidden"))
    _write(tmp_dir, "_hidden/a.csv", "no\n")
    _write(tmp_dir, "loose.csv", "c,d\n")
    want = sorted((r["file"], r["line"]) for r in C.first_lines(spark, tmp_dir).collect())
    assert len(want) == 61
    real, groups = C._lines, []
    monkeypatch.setattr(C, "_lines", lambda a, b, path, e: (groups.append(path), real(a, b, path, e))[1])
    monkeypatch.setattr(C, "LISTED", 14)
    assert sorted((r["file"], r["line"]) for r in C.first_lines(spark, tmp_dir).collect()) == want
    assert len(groups) == 6 and max(map(len, groups)) <= 3

"""Sheets of several files, each with a header of its own."""

import datetime

import pytest

from spanfolio.sources import sheets


def written(folder, **files):
    for name, lines in files.items():
        (folder / f"{name}.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


def rows(df):
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


def test_columns_go_by_the_header_of_their_file(spark, tmp_path):
    path = written(
        tmp_path,
        a=["dt,A,B", "2020-01-01,1,2"],
        b=["dt,B,A", "2020-01-02,20,10"],
        c=["day,C,A", "2020-01-03,300,x", "2020-01-04,,100"],
        d=["dt,A,B", "2020-01-05,5,6"],
    )
    assert sheets.header(spark, path) == ["A", "B", "C"]
    assert len(sheets.by_header(spark, path)) == 3
    got = sheets.read_wide_csv(spark, path)
    assert got.columns == ["dt", "A", "B", "C"]
    assert rows(got) == [
        ("2020-01-01", 1.0, 2.0, None),
        ("2020-01-02", 10.0, 20.0, None),
        ("2020-01-03", None, None, 300.0),
        ("2020-01-04", 100.0, None, None),
        ("2020-01-05", 5.0, 6.0, None),
    ]
    assert rows(sheets.read_wide_csv(spark, path, ["C", "B"]))[1] == ("2020-01-02", None, 20.0)
    with pytest.raises(ValueError, match="Z"):
        sheets.read_wide_csv(spark, path, ["Z"])


def test_one_file_and_a_header_alone(spark, tmp_path):
    path = written(tmp_path, a=["dt,A", "2020-01-01,1"])
    assert sheets.read_wide_csv(spark, path + "/a.csv").collect() == [(datetime.date(2020, 1, 1), 1.0)]
    written(tmp_path, b=["dt,B"])
    assert sheets.read_wide_csv(spark, path).columns == ["dt", "A", "B"]
    assert sheets.read_wide_csv(spark, path).count() == 1


def test_large_files_are_split_and_keep_their_header(spark, tmp_path):
    day = datetime.date(2000, 1, 1)
    lines = [f"{day + datetime.timedelta(i)},{i},{-i}" for i in range(3000)]
    path = written(tmp_path, a=["dt,A,B", *lines], b=["dt,B,A", *lines])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        got = sheets.read_wide_csv(spark, path).selectExpr("sum(A)", "sum(B)", "count(*)").first()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert tuple(got) == (0.0, 0.0, 6000)

"""Sheets, alignment, returns and edge cases of panels."""

import datetime as dt
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from spanfolio.operators import panel as P
from spanfolio.operators import risk as K
from spanfolio.sources import sheets
from spanfolio.sources.workspace import CHECKPOINT_CONF, materialise, new_path, workspace

D = [dt.date(2021, 1, d) for d in range(1, 8)]
SCHEMA = "universe string, dt date, asset string, price double"
NAN = float("nan")


def prices(spark, rows):
    return spark.createDataFrame([("U", *r) for r in rows], SCHEMA)


def values(df, column):
    return {(r.asset, r.dt): r[column] for r in df.collect()}


def test_csv_with_text_gaps_and_nan(spark):
    path = new_path(spark, "csv")
    lines = ["date,A,B", "2021-01-01,1.5,2", "2021-01-02,n/a,3", "2021-01-03,,4", "2021-01-04,NaN,5", "2021-01-05,6,7"]
    spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.text(path)
    wide = sheets.read_wide_csv(spark, path, ["A", "B"])
    assert wide.count() == 5
    kept = sheets.drop_incomplete(wide).orderBy("dt").collect()
    assert [(r.dt.day, r.A, r.B) for r in kept] == [(1, 1.5, 2.0), (5, 6.0, 7.0)]
    assert sheets.to_long(wide).count() == 7
    assert sheets.drop_leading(wide).columns == ["A", "B"]
    assert sheets.name_by_position(wide, ["d", "x", "y", "z"]).columns == ["d", "x", "y"]


def test_only_complete_dates_stay_and_are_numbered(spark):
    p = prices(spark, [(D[0], "A", 1.0), (D[0], "B", 1.0), (D[1], "A", 2.0), (D[2], "A", 3.0), (D[2], "B", NAN),
                       (D[3], "A", 4.0), (D[3], "B", 2.0), (D[4], "A", None), (D[4], "B", 1.0)])
    got = P.aligned(p).orderBy("dt", "asset").collect()
    assert [(r.dt.day, r.ix, r.asset, r.n_assets) for r in got] == [
        (1, 0, "A", 2), (1, 0, "B", 2), (4, 1, "A", 2), (4, 1, "B", 2)]
    r = values(P.simple_returns(P.aligned(p)), "r")
    assert r == {("A", D[3]): 3.0, ("B", D[3]): 1.0}
    ln = values(P.log_returns(P.aligned(p)), "r")
    assert ln[("A", D[3])] == pytest.approx(math.log(4))


def test_given_dates_are_used(spark):
    p = prices(spark, [(D[0], "A", 1.0), (D[1], "A", 2.0), (D[2], "A", 3.0)])
    dates = P.calendar(P.complete_dates(p)).where(F.col("dt") > D[0])
    assert {r.ix for r in P.aligned(p, dates=dates).collect()} == {1, 2}
    assert [r.ix for r in P.return_dates(dates).orderBy("ix").collect()] == [0, 1]


def test_no_date_is_complete(spark):
    p = prices(spark, [(D[0], "A", 1.0), (D[1], "B", 1.0)])
    assert P.aligned(p).count() == 0


def test_padding_fills_null_and_nan(spark):
    p = prices(spark, [(D[0], "A", 2.0), (D[1], "A", None), (D[2], "A", NAN), (D[3], "A", 3.0)])
    r = values(P.simple_returns(p, pad=True), "r")
    assert r == {("A", D[1]): 0.0, ("A", D[2]): 0.0, ("A", D[3]): 0.5}


def test_grid_adds_missing_rows(spark):
    p = prices(spark, [(D[0], "A", 1.0), (D[1], "B", 2.0)])
    got = values(P.fill_grid(p), "price")
    assert got == {("A", D[0]): 1.0, ("A", D[1]): None, ("B", D[0]): None, ("B", D[1]): 2.0}


def test_price_zero_gives_no_return(spark):
    p = prices(spark, [(D[0], "A", 0.0), (D[1], "A", 1.0), (D[2], "A", 2.0)])
    assert values(P.simple_returns(p), "r") == {("A", D[2]): 1.0}


def test_standardise(spark):
    rows = [("U", D[i], i, "A", float(v)) for i, v in enumerate([1, 2, 3])]
    rows += [("U", D[i], i, "B", 5.0) for i in range(3)]
    r = spark.createDataFrame(rows, "universe string, dt date, ix long, asset string, r double")
    z = values(P.standardise(r), "r")
    assert [z[("A", D[i])] for i in range(3)] == pytest.approx([-1.0, 0.0, 1.0])
    assert z[("B", D[0])] is None
    past = values(P.standardise(r, by="past"), "r")
    assert past[("A", D[1])] == pytest.approx(0.5 / math.sqrt(0.5))
    with pytest.raises(ValueError):
        P.standardise(r, by="future")


def test_benchmark_must_be_gone(spark):
    p = prices(spark, [(D[0], "A", 1.0), (D[0], "SPX", 1.0)])
    assert P.assert_absent(P.exclude_asset(p, "SPX"), "SPX").count() == 1
    with pytest.raises(PySparkException):
        P.assert_absent(p, "SPX").collect()


def test_grid_and_skip(spark):
    cal = P.calendar(spark.createDataFrame([("U", d) for d in D], "universe string, dt date"))
    assert [r.ix for r in P.evaluation_grid(cal, 1, 6, 2).orderBy("ix").collect()] == [1, 3, 5]
    assert P.skip_rows(cal, 5).count() == 2


def test_tail_risk_with_ties_and_one_row(spark):
    rows = [("U", "A", float(v)) for v in (-3, -3, 0, 1, 2, 2, 2, 5, 6, 9, 9)] + [("U", "B", 4.0)]
    r = spark.createDataFrame(rows, "universe string, asset string, r double")
    got = {x.asset: x for x in K.tail_risk(r, ["universe", "asset"], 0.1).collect()}
    assert (got["A"].var_q, got["A"].cvar_q) == (-3.0, -3.0)
    assert (got["B"].variance, got["B"].var_q, got["B"].cvar_q) == (None, 4.0, 4.0)
    for x in got.values():
        assert x.cvar_q <= x.var_q
    near = {x.asset: x for x in K.tail_risk(r, ["universe", "asset"], 0.1, approximate=True).collect()}
    assert near["A"].var_q == -3.0


def test_extremes_break_ties_by_name(spark):
    rows = [("U", "B", 2.0, -1.0, -2.0), ("U", "A", 2.0, -1.0, -1.5), ("U", "C", 1.0, -0.5, -3.0)]
    report = spark.createDataFrame(rows, "universe string, asset string, variance double, var_q double, cvar_q double")
    assert tuple(K.extremes(report).first())[1:] == ("A", "A", "C")


def test_shrinkage_uses_the_mean_of_means(spark):
    rows = [("U", "A", 1.0), ("U", "A", 3.0), ("U", "B", 6.0)]
    r = spark.createDataFrame(rows, "universe string, asset string, r double")
    got = {x.asset: x.shrunk for x in K.shrink_mean(K.asset_mean(r), 0.9).collect()}
    assert got == pytest.approx({"A": 0.9 * 2 + 0.1 * 4, "B": 0.9 * 6 + 0.1 * 4})


def test_written_tables_go_to_the_named_folder(spark):
    named = spark.conf.get(CHECKPOINT_CONF, None)
    folder = workspace(spark)
    assert folder == (named or spark.sparkContext.getCheckpointDir()) == workspace(spark)
    df = materialise(spark.range(10).withColumn("v", F.col("id") * 2), "t")
    assert df.count() == 10
    assert folder.split(":")[-1].rstrip("/") in df.inputFiles()[0]


def test_a_cluster_must_name_the_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError):
        workspace(Session())

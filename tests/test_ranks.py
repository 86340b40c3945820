"""Exact elements of groups, found through sketches and counts, against sorted arrays."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanfolio.operators import ranks as K
from spanfolio.operators import risk


def table(spark, groups):
    rows = [(k, float(v)) for k, values in groups.items() for v in values]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, "universe string, r double").repartition(5)


def groups(seed):
    r = np.random.default_rng(seed)
    return {
        "hot": np.round(r.normal(size=20_000), 3),  # almost all rows, with ties
        "wide": r.normal(size=3000) * 10.0 ** r.integers(-300, 300, 3000),
        "one value": np.full(2500, 7.0),
        "two": r.choice([1.0, 2.0], 2100),
        "small": r.normal(size=17),
        "single": np.array([3.5]),
    }


@pytest.mark.parametrize("p", [0.003, 0.1, 0.5, 0.9, 0.95, 1.0])
def test_elements_of_hot_and_small_groups(spark, p):
    data = groups(1)
    last = lambda n: F.ceil(F.lit(p) * n)
    found = K.elements(table(spark, data), ["universe"], "r", {"x": last}, small=300, accuracy=2000)
    got = {row.universe: (row.n, row.x) for row in found.collect()}
    assert got == {k: (len(v), float(np.sort(v)[math.ceil(p * len(v)) - 1])) for k, v in data.items()}


def test_no_window_over_a_whole_group(spark):
    rows = spark.range(300_000).selectExpr("'only' AS universe", "cast(hash(id) as double) AS r")
    found = K.ranges(rows, ["universe"], "r", lambda n: F.ceil(n * 0.9), lambda n: F.ceil(n * 0.9), small=2000).first()
    assert found.n == 300_000 and found.inside <= 2000 and found.below < 270_000 <= found.below + found.inside
    got = K.elements(rows, ["universe"], "r", {"x": lambda n: F.ceil(n * 0.9)}, small=2000).first()
    assert got.x == rows.orderBy("r").offset(269_999).first().r


def test_tail_risk_and_ceiling_rule_by_ranges(spark, monkeypatch):
    data = groups(2)
    del data["wide"], data["single"]
    rows = table(spark, data)
    whole = {r.universe: r for r in risk.tail_risk(rows, ["universe"], 0.1).collect()}
    losses = rows.selectExpr("universe", "-r AS loss")
    ceiling = {r.universe: r for r in risk.ceiling_risk(losses, ["universe"], 0.9).collect()}
    monkeypatch.setattr(K.elements, "__defaults__", (300, 2000, None))
    for name, x in data.items():
        ranged = risk.tail_risk(rows.where(F.col("universe") == name), ["universe"], 0.1).first()
        for row in (whole[name], ranged):
            assert row.var_q == pytest.approx(np.quantile(x, 0.1), rel=1e-12)
            assert row.cvar_q == pytest.approx(x[x <= row.var_q].mean(), rel=1e-9)
        k = math.ceil(0.9 * len(x)) - 1
        loss = np.sort(-x)
        for row in (ceiling[name], risk.ceiling_risk(losses.where(F.col("universe") == name), ["universe"], 0.9).first()):
            assert (row.n, row.ceiling_var) == (len(x), loss[k])
            assert row.ceiling_cvar == pytest.approx(loss[k:].sum() / (0.1 * len(x)), rel=1e-9)


def test_empty_null_and_nan(spark):
    empty = spark.createDataFrame([], "universe string, r double")
    assert K.elements(empty, ["universe"], "r", {"x": lambda n: n}).count() == 0
    rows = spark.createDataFrame([("a", None), ("a", 1.0), ("a", float("nan")), ("b", None)], "universe string, r double")
    got = K.elements(rows, ["universe"], "r", {"x": lambda n: n - 1}).collect()
    assert [(r.universe, r.n, r.x) for r in got] == [("a", 2, 1.0)]

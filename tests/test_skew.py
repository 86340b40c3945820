"""A third of all rows on one part, supplier and customer: whole results, without broadcasts."""

import os

import pytest
from oracle import DATA, TABLES, compare, connect

from spanfolio.plans import registry
from spanfolio.sources import tables as T

NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.files.maxPartitionBytes": "256KB",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    con = connect(f"{DATA}/sf0.01")
    hot = {
        "lineitem": "* REPLACE (CASE WHEN l_orderkey % 3 = 0 THEN 7 ELSE l_partkey END AS l_partkey, "
        "CASE WHEN l_orderkey % 3 = 0 THEN 5 ELSE l_suppkey END AS l_suppkey)",
        "orders": "* REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 11 ELSE o_custkey END AS o_custkey)",
    }
    for t in TABLES:
        con.execute(
            f"COPY (SELECT {hot.get(t, '*')} FROM {t}) TO '{os.path.join(folder, t)}.parquet' "
            "(FORMAT parquet, ROW_GROUP_SIZE 4096)"
        )
    return folder


@pytest.fixture()
def large_tables(spark):
    """Settings under which even the test tables count as too large to broadcast."""
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize(
    "name",
    ["panel_pivot", "covariance_by_universe", "rolling_cov", "asset_risk_report", "luck_screen", "swaption_book",
     "min_variance", "bond_book"],
)
def test_same_as_sql_on_skewed_tables(spark, skewed, large_tables, name):
    rows, faults = compare(
        spark, connect(skewed), registry.queries()[name], registry.oracle_sql()[name], skewed
    )
    assert not faults
    assert rows > 0


def test_hot_part_is_split(spark, skewed, large_tables):
    df = T.price_panel(spark, skewed, T.TYPES_DAY)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin(skew=true)" in final

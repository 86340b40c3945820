"""Shape of the plans, and that the entry module works as the driver uses it."""

import os
import subprocess
import sys

import pytest
from oracle import DATA, ROOT

from spanfolio.operators import panel as P
from spanfolio.plans import registry
from spanfolio.sources import tables as T

SF = f"{DATA}/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_import_needs_no_session():
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT, timeout=120)


def test_flagship_on_the_smallest_tables(spark):
    import __spark_entry__

    row = __spark_entry__.entry(spark).collect()
    assert len(row) == 1 and row[0].n > 100


def test_panel_scan_reads_only_what_it_needs(spark):
    text = plan(T.price_panel(spark, SF, T.TYPES_DAY))
    assert "l_discount" not in text and "p_name" not in text and "l_returnflag" not in text
    assert "partial_avg" in text


def test_no_broadcast_when_a_side_is_too_large(spark):
    """Nothing is hinted: beyond the threshold the join sorts and merges instead."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        text = plan(T.price_panel(spark, SF, T.TYPES_DAY))
        assert "SortMergeJoin" in text and "Broadcast" not in text
        assert P.aligned(T.price_panel(spark, SF, T.TYPES_WEEK)).count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", ["shrinkage_mean", "rolling_cov", "portfolio_stats", "two_fund_frontier",
                                  "swaption_book", "bond_book", "luck_screen_best_of", "ar_shift", "backtest"])
def test_no_cross_join(spark, shared_panels, name):
    text = plan(registry.queries()[name](spark, f"{DATA}/sf0.01"))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["spectrum", "absorption_series", "tangency", "autoencoder_fit"])
def test_matrix_functions_run_once(spark, shared_panels, name, monkeypatch):
    """Even without written tables in between, no function appears twice along a plan."""
    from spanfolio.plans import portfolio_queries, spectrum_queries

    for module in (portfolio_queries, spectrum_queries):
        monkeypatch.setattr(module, "materialise", lambda df, label="": df)
    df = registry.queries()[name](spark, f"{DATA}/sf0.01")
    if "status" in df.columns:
        df = df.where("status = 'ok'")
    text = plan(df)
    found = [text.count(f"ArrowEvalPython [{f}(") for f in ("spectra", "solve_batch", "fit", "kernel")]
    if name == "autoencoder_fit":  # trains in the group of a refresh, its only grouped function
        found.append(text.count("FlatMapGroupsInArrow"))
    assert max(found) == 1


def test_library_has_no_hints_or_local_checkpoints():
    for folder, inner, files in os.walk(os.path.join(ROOT, "spanfolio")):
        if "llm" in inner:  # its bounded broadcasts and results have tests of their own
            inner.remove("llm")
        for f in files:
            if f.endswith(".py"):
                text = open(os.path.join(folder, f)).read()
                for word in ("localCheckpoint", "F.broadcast(", "crossJoin", ".toPandas(", ".collect()"):
                    assert word not in text, (f, word)

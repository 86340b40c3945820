"""Every query with an SQL form gives the result of that SQL."""

import pytest
from oracle import DATA, compare, connect

from spanfolio.plans import registry

SF = f"{DATA}/sf0.01"
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, con, shared_panels, name):
    rows, faults = compare(spark, con, QUERIES[name], ORACLES[name], SF)
    assert not faults
    assert rows > 0


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLES.keys()))
def test_runs_without_sql_form(spark, shared_panels, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_statuses_other_than_ok_occur(con):
    """The targets are chosen so that unsolvable keys are compared too."""
    for name, status in (("long_only", "infeasible"), ("target_vol", "below_minimum")):
        found = con.execute(
            f"SELECT count(*) FROM ({ORACLES[name]}) WHERE status = '{status}'"
        ).fetchall()
        assert found[0][0] > 0

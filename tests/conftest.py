import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from oracle import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session()
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def shared_panels():
    """Let queries share the panels they all start from; each is still built by the same code."""
    from spanfolio.plans import common, panel_queries, portfolio_queries, risk_queries, spectrum_queries

    def cached(build):
        made = {}

        def once(spark, sf_dir, spec):
            key = (sf_dir, spec)
            if key not in made:
                made[key] = build(spark, sf_dir, spec)
            return made[key]

        return once

    for name in ("prices_of", "panel_of"):
        shared = cached(getattr(common, name))
        for module in (common, panel_queries, portfolio_queries, risk_queries, spectrum_queries):
            if hasattr(module, name):
                setattr(module, name, shared)

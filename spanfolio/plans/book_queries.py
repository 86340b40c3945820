"""Curves, lattices and books of contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanfolio.operators import rates as L
from spanfolio.plans import sql as S
from spanfolio.plans.common import show
from spanfolio.sources import tables as T
from spanfolio.sources.tables import BASE_SPOT
from spanfolio.sources.workspace import materialise


def curve_discounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = T.curves(spark, sf_dir).select(
        "curve_id", F.posexplode(L.discount_prices(F.col("spot"))).alias("p", "price")
    )
    tenor = (F.col("p") + 1).cast("long").alias("tenor")
    return show(prices.select("curve_id", tenor, "price"), ["curve_id", "tenor"], price=8)


def _levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted curves, written once so that a wide plan does not fit them again."""
    return materialise(L.calibrate(T.curves(spark, sf_dir)), "levels")


def calibrate_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = _levels(spark, sf_dir).select(
        "curve_id", "status", F.posexplode("level").alias("p", "level")
    )
    step = F.col("p").cast("long").alias("step")
    return show(levels.select("curve_id", "status", step, "level"), ["curve_id", "status", "step"], level=9)


def lattice_zcb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each fitted curve reprices its own discount bonds by backward induction."""
    priced = (
        _levels(spark, sf_dir)
        .withColumn("maturity", F.explode(F.sequence(F.lit(1), F.size("level"))))
        .withColumn("price", L.zero_coupon("level", "maturity"))
        .select("curve_id", F.col("maturity").cast("long").alias("maturity"), "price")
    )
    return show(priced, ["curve_id", "maturity"], price=8)


def rate_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = _levels(spark, sf_dir)
    nodes = L.explode_nodes(levels, L.lattice_nodes(F.col("level")), ["curve_id"], "rate")
    return show(nodes, ["curve_id", "i", "j"], rate=9)


def _priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priced positions. Orders and customers are joined once: curves come from the contracts that are kept."""
    contracts = materialise(T.contracts(spark, sf_dir), "contracts")
    levels = materialise(L.calibrate(T.curves_of(contracts)), "levels")
    return L.price_swaps(contracts, levels, T.strike_of(F.col("strike_step")))


def swap_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Swap value by desk, exercise date and state of that date."""
    book = L.swap_values(materialise(_priced(spark, sf_dir), "priced"))
    return show(book, ["desk", "exercise", "state"], value=1, unpriced=2)


def swaption_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Swaption value by desk and curve."""
    book = L.swaption_values(_priced(spark, sf_dir))
    return show(book, ["desk", "curve_id"], notional=2, value=3, unpriced=2)


def _maturities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct maturities of the bonds with what they hold."""
    return T.bonds(spark, sf_dir).groupBy("maturity").agg(F.count(F.lit(1)).alias("n_bonds"))


def rate_lattice_updown(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = L.explode_nodes(
        _maturities(spark, sf_dir), L.up_down_nodes(F.col("maturity")),
        ["maturity", "n_bonds"], "rate",
    )
    return show(nodes, ["maturity", "n_bonds", "i", "j"], rate=9)


def hazard_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = L.explode_nodes(
        _maturities(spark, sf_dir), L.up_down_nodes(F.col("maturity") - 1),
        ["maturity", "n_bonds"], "rate",
    )
    grid = nodes.withColumn("hazard", L.hazard(F.col("i"), F.col("j")))
    return show(grid, ["maturity", "n_bonds", "i", "j"], hazard=9)


def bond_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show(L.bond_values(T.bonds(spark, sf_dir)), ["issuer"], face=2, value=3)


QUERIES = {
    f.__name__: f
    for f in (
        curve_discounts, calibrate_curves, lattice_zcb, rate_lattice, swap_book, swaption_book,
        rate_lattice_updown, hazard_grid, bond_book,
    )
}

_SPOTS = "[" + ", ".join(str(s) for s in BASE_SPOT) + "]::DOUBLE[]"
_LEVELS = S.levels()
_DISCOUNT = f"100 / (1 + (({_SPOTS})[t] + 0.001::DOUBLE * sh)) ** t"
_RATE = "0.05 * 1.1::DOUBLE ** j * 0.9::DOUBLE ** (i - j)"
_HAZARD = "0.01 * 1.01::DOUBLE ** (j - i / 2.0)"
_SIZES = "sizes AS (SELECT 1 + p_size % 10 AS maturity, count(*) AS n_bonds FROM part GROUP BY 1)"


def _nodes(last: str) -> str:
    return (
        f"(SELECT *, unnest(range(0, i + 1)) AS j FROM "
        f"(SELECT *, unnest(range(0, {last} + 1)) AS i FROM sizes))"
    )


ORACLES = {
    "curve_discounts": S.with_(_LEVELS[0])
    + f"SELECT curve_id, t AS tenor, {S.rnd(_DISCOUNT, 8)} AS price "
    "FROM (SELECT *, unnest(range(1, 11)) AS t FROM cv)",
    "calibrate_curves": S.with_(*_LEVELS, recursive=True)
    + f"SELECT curve_id, 'ok' AS status, i AS step, {S.rnd('lv[i + 1]', 9)} AS level "
    "FROM (SELECT *, unnest(range(0, 10)) AS i FROM cv JOIN cal_levels USING (sh))",
    "lattice_zcb": S.with_(_LEVELS[0])
    + f"SELECT curve_id, t AS maturity, {S.rnd(_DISCOUNT, 8)} AS price "
    "FROM (SELECT *, unnest(range(1, 11)) AS t FROM cv)",
    "rate_lattice": S.with_(*_LEVELS, recursive=True)
    + f"SELECT curve_id, i, j, {S.rnd('lv[i + 1] * exp(0.1 * j)', 9)} AS rate FROM "
    "(SELECT *, unnest(range(0, i + 1)) AS j FROM "
    "(SELECT *, unnest(range(0, 10)) AS i FROM cv JOIN cal_levels USING (sh)))",
    "swap_book": S.with_(*_LEVELS, *S.terms(), recursive=True)
    + f"SELECT desk, exercise, state, {S.rnd('sum(notional * v)', 1)} AS value, 0.0::DOUBLE AS unpriced FROM "
    "(SELECT desk, exercise, notional, unnest(states) AS v, unnest(range(0, len(states))) AS state "
    "FROM held JOIN cv USING (curve_id) JOIN unit USING (sh, strike_step, exercise)) GROUP BY ALL",
    "swaption_book": S.with_(*_LEVELS, *S.terms(), recursive=True)
    + f"SELECT desk, curve_id, {S.rnd('sum(notional)', 2)} AS notional, "
    f"{S.rnd('sum(notional * value)', 3)} AS value, 0.0::DOUBLE AS unpriced "
    "FROM held JOIN cv USING (curve_id) JOIN unit USING (sh, strike_step, exercise) GROUP BY ALL",
    "rate_lattice_updown": S.with_(_SIZES)
    + f"SELECT maturity::BIGINT AS maturity, n_bonds, i, j, {S.rnd(_RATE, 9)} AS rate FROM {_nodes('maturity')}",
    "hazard_grid": S.with_(_SIZES)
    + f"SELECT maturity::BIGINT AS maturity, n_bonds, i, j, {S.rnd(_HAZARD, 9)} AS hazard FROM {_nodes('maturity - 1')}",
    "bond_book": f"""WITH held AS (
    SELECT p_brand AS issuer, p_size % 6 AS recovery_step, 1 + p_size % 10 AS maturity,
           sum(p_retailprice) AS face FROM part GROUP BY ALL),
unit AS (
    SELECT recovery_step, maturity, list_reduce(
        list_transform(range(maturity - 1, -1, -1), lambda i: [i::DOUBLE]),
        lambda v, x: list_transform(range(0, x[1]::BIGINT + 1), lambda j:
            ((1 - {_HAZARD.replace('i / 2.0', 'x[1] / 2.0')}) * 0.5 * (v[j + 1] + v[j + 2])
             + {_HAZARD.replace('i / 2.0', 'x[1] / 2.0')} * 0.1::DOUBLE * recovery_step)
            / (1 + {_RATE.replace('(i - j)', '(x[1] - j)')})),
        list_transform(range(maturity + 1), lambda z: 1.0::DOUBLE))[1] AS u
    FROM (SELECT DISTINCT recovery_step, maturity FROM held))
SELECT issuer, {S.rnd('sum(face)', 2)} AS face, {S.rnd('sum(face * u)', 3)} AS value
FROM held JOIN unit USING (recovery_step, maturity) GROUP BY issuer""",
}

"""Books of rate and credit contracts over many curves.

Lattices are array expressions: a list of values per time step, folded backward.
Prices are proportional to the notional or face, so positions are summed per
distinct terms before anything is priced; the number of lattices then depends on
curves and terms, not on contracts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from spanfolio.functions.arrow import once

# Growth of the short rate per state and face of the discount bonds.
STATE_GROWTH = 0.1
FACE = 100.0
BRACKET = (1e-6, 1.0)

# up/down lattice and default model.
R0 = 0.05
UP = 1.1
DOWN = 0.9
HAZARD_A = 0.01
HAZARD_B = 1.01


def discount_prices(spot: Column, face: float = FACE) -> Column:
    """Price of ``face`` paid at tenor 1, 2, ... from annual spot rates."""
    return F.transform(spot, lambda s, t: F.lit(face) / F.pow(1 + s, t + 1))


def _calibrator(growth: float):
    @pandas_udf("status string, level array<double>")
    def levels(spot: pd.Series) -> pd.DataFrame:
        status = np.full(len(spot), "ok", dtype=object)
        found: list = [None] * len(spot)
        length = spot.map(len).to_numpy()
        for n in np.unique(length):
            at = np.flatnonzero(length == n)
            rates = np.stack([np.asarray(spot.iloc[i], float) for i in at])
            good = np.ones(len(at), bool)
            level = np.empty_like(rates)
            state = np.ones((len(at), 1))
            for i in range(n):
                growth_of = np.exp(growth * np.arange(i + 1))
                price = (1 + rates[:, i]) ** -(i + 1.0)

                def excess(a):
                    return (state / (1 + a[:, None] * growth_of)).sum(axis=1) - price

                low, high = (np.full(len(at), v) for v in BRACKET)
                good &= excess(low) * excess(high) <= 0
                for _ in range(64):
                    middle = 0.5 * (low + high)
                    above = excess(middle) > 0
                    low = np.where(above, middle, low)
                    high = np.where(above, high, middle)
                level[:, i] = 0.5 * (low + high)
                paid = 0.5 * state / (1 + level[:, i : i + 1] * growth_of)
                state = np.pad(paid, ((0, 0), (0, 1))) + np.pad(paid, ((0, 0), (1, 0)))
            status[at[~good]] = "no_bracket"
            for row, i in enumerate(at):
                found[i] = level[row] if good[row] else None
        return pd.DataFrame({"status": status, "level": found})

    return once(levels)


def calibrate(curves: DataFrame, growth: float = STATE_GROWTH) -> DataFrame:
    """Add ``status`` and ``level``: rates ``level[i] * exp(growth * j)`` that reprice the curve.

    Curves are solved side by side in Arrow batches, one bisection per time step
    on prices of the states reached so far.
    """
    fitted = curves.withColumn("c", _calibrator(growth)("spot"))
    return fitted.select(*curves.columns, "c.status", "c.level")


def lattice_nodes(level: Column, growth: float = STATE_GROWTH) -> Column:
    """Rates by time step: element ``i`` is the list over states ``j = 0..i``."""
    return F.transform(
        level,
        lambda a, i: F.transform(F.sequence(F.lit(0), i), lambda j: a * F.exp(growth * j)),
    )


def up_down_nodes(steps: Column, r0: float = R0, up: float = UP, down: float = DOWN) -> Column:
    """``r0 * up**j * down**(i - j)`` by time step ``i = 0..steps`` and state."""
    return F.transform(
        F.sequence(F.lit(0), steps.cast("int")),
        lambda i: F.transform(
            F.sequence(F.lit(0), i),
            lambda j: F.lit(r0) * F.pow(F.lit(up), j) * F.pow(F.lit(down), i - j),
        ),
    )


def hazard(i: Column, j: Column, a: float = HAZARD_A, b: float = HAZARD_B) -> Column:
    """Chance of default in the step from node ``(i, j)``."""
    return F.lit(a) * F.pow(F.lit(b), j - i / F.lit(2.0))


def explode_nodes(df: DataFrame, nodes: Column, keys: list[str], value: str) -> DataFrame:
    """``(keys, i, j, value)`` from a list of lists."""
    steps = df.select(*keys, F.posexplode(nodes).alias("i", "states"))
    states = steps.select(*keys, F.col("i").cast("long"), F.posexplode("states").alias("j", value))
    return states.select(*keys, "i", F.col("j").cast("long").alias("j"), value)


def zero_coupon(level: str, maturity: str, growth: float = STATE_GROWTH, face: float = FACE) -> Column:
    """Price at time 0 of ``face`` paid at ``maturity`` on the lattice of ``level``."""
    return F.expr(
        f"""aggregate(sequence({maturity} - 1, 0, -1), array_repeat({face}D, {maturity} + 1),
            (v, i) -> transform(sequence(0, i), j ->
                0.5D * (v[j] + v[j + 1]) / (1D + {level}[i] * exp({growth}D * j))))[0]"""
    )


def _legs(level: str, paid: str, growth: float) -> str:
    """Value at every node of a leg that pays ``paid`` per period in arrears, list by time step."""
    rate = f"{level}[i] * exp({growth}D * j)"
    return f"""slice(aggregate(sequence(size({level}) - 1, 0, -1), array(array_repeat(0D, size({level}) + 1)),
        (v, i) -> concat(array(transform(sequence(0, i), j ->
            (0.5D * (v[0][j] + v[0][j + 1]) + {paid.format(rate=rate)}) / (1D + {rate}))), v)),
        1, size({level}))"""


def _state_prices(level: str, growth: float) -> str:
    """Value today of 1 paid in each state of each time step."""

    def half(j: str) -> str:
        return f"0.5D * q[i][{j}] / (1D + {level}[i] * exp({growth}D * ({j})))"

    return f"""slice(aggregate(sequence(0, size({level}) - 1), array(array(1D)),
        (q, i) -> concat(q, array(transform(sequence(0, i + 1), j ->
            IF(j <= i, {half('j')}, 0D) + IF(j >= 1, {half('j - 1')}, 0D))))),
        1, size({level}))"""


def swap_lattices(levels: DataFrame, growth: float = STATE_GROWTH) -> DataFrame:
    """``(curve_id, exercise, floating, annuity, state_price)``, lists over the states of a date.

    The legs run from the exercise date to the last tenor. A swap is linear in
    its strike, so one lattice serves every strike of a curve and date.
    """
    lists = levels.where("status = 'ok'").select(
        "curve_id",
        F.expr(_legs("level", "{rate}", growth)).alias("floating"),
        F.expr(_legs("level", "1D", growth)).alias("annuity"),
        F.expr(_state_prices("level", growth)).alias("state_price"),
    )
    nodes = F.posexplode(F.arrays_zip("floating", "annuity", "state_price")).alias("exercise", "x")
    return lists.select("curve_id", nodes).select(
        "curve_id", F.col("exercise").cast("long").alias("exercise"), "x.*"
    )


def swap_states(strike: str) -> Column:
    """Value per unit notional of a payer swap at each state of its exercise date."""
    return F.expr(f"zip_with(floating, annuity, (f, a) -> f - {strike} * a)")


def swaption_value(states: str) -> Column:
    """Value at time 0 of the right to enter the swap at its one exercise date."""
    return F.expr(
        f"aggregate(zip_with({states}, state_price, (s, q) -> greatest(s, 0D) * q), 0D, (t, v) -> t + v)"
    )


def defaultable_bond(
    recovery: str,
    maturity: str,
    r0: float = R0,
    up: float = UP,
    down: float = DOWN,
    a: float = HAZARD_A,
    b: float = HAZARD_B,
) -> Column:
    """Price per unit face of a zero-coupon bond that pays ``recovery`` of face on default."""
    rate = f"({r0}D * pow({up}D, j) * pow({down}D, i - j))"
    chance = f"({a}D * pow({b}D, j - i / 2D))"
    return F.expr(
        f"""aggregate(sequence({maturity} - 1, 0, -1), array_repeat(1D, {maturity} + 1),
            (v, i) -> transform(sequence(0, i), j ->
                ((1D - {chance}) * 0.5D * (v[j] + v[j + 1]) + {chance} * {recovery}) / (1D + {rate})))[0]"""
    )


def positions(contracts: DataFrame, terms: list[str], amount: str) -> DataFrame:
    """Amounts summed over contracts with the same terms; combines map-side."""
    return contracts.groupBy(*terms).agg(F.sum(amount).alias(amount))


def price_swaps(contracts: DataFrame, levels: DataFrame, strike: Column) -> DataFrame:
    """Positions with ``states`` (swap at exercise) and ``unit`` (swaption now), per unit notional.

    ``levels`` is :func:`calibrate` output. Positions on a curve that could not
    be fitted carry nulls and their notional as ``unpriced``; see :func:`swap_values`.
    """
    held = positions(contracts, ["curve_id", "desk", "strike_step", "exercise"], "notional")
    return (
        held.join(swap_lattices(levels), ["curve_id", "exercise"], "left")
        .withColumn("strike", strike)
        .withColumn("states", swap_states("strike"))
        .withColumn("unit", swaption_value("states"))
        .withColumn("unpriced", F.when(F.col("unit").isNull(), F.col("notional")).otherwise(F.lit(0.0)))
        .drop("floating", "annuity", "state_price")
    )


def swap_values(priced: DataFrame) -> DataFrame:
    """Swap value by desk, exercise and state, and the notional of the desk and date that has no price.

    Where no position of a desk and date has a price there is one row with a null state.
    """
    states = priced.select("desk", "exercise", "notional", "unpriced", F.posexplode_outer("states").alias("s", "v"))
    value = states.where("s IS NOT NULL").groupBy("desk", "exercise", F.col("s").cast("long").alias("state")).agg(
        F.sum(F.col("notional") * F.col("v")).alias("value")
    )
    without = priced.groupBy("desk", "exercise").agg(F.sum("unpriced").alias("unpriced"))
    return without.join(value, ["desk", "exercise"], "left").select("desk", "exercise", "state", "value", "unpriced")


def swaption_values(priced: DataFrame) -> DataFrame:
    """Notional, swaption value and notional without a price by desk and curve."""
    return priced.groupBy("desk", "curve_id").agg(
        F.sum("notional").alias("notional"),
        F.sum(F.col("notional") * F.col("unit")).alias("value"),
        F.sum("unpriced").alias("unpriced"),
    )


def bond_values(bonds: DataFrame) -> DataFrame:
    """Face and value per issuer; each distinct recovery and maturity is one lattice."""
    held = positions(bonds, ["issuer", "recovery_step", "maturity"], "face")
    unit = (
        held.withColumn("recovery", F.lit(0.1) * F.col("recovery_step"))
        .withColumn("m", F.col("maturity").cast("int"))
        .withColumn("unit", defaultable_bond("recovery", "m"))
    )
    return unit.groupBy("issuer").agg(
        F.sum("face").alias("face"), F.sum(F.col("face") * F.col("unit")).alias("value")
    )

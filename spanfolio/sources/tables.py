"""Panels and books derived from the star-schema tables.

Every panel is long, ``(universe, dt DATE, asset, price)``, one row per key. A
universe is an independent set of assets with its own calendar; a job over one
universe uses the constant universe ``ALL``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanfolio.sources.workspace import materialise

#: Universe name when the whole table is one universe.
ONE_UNIVERSE = "ALL"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def period_start(when: Column, grain: str) -> Column:
    """First date of the day, week (from Monday) or month of a timestamp without zone.

    Works on the date; truncating the timestamp would convert every row between zones.
    """
    day = when.cast("date")
    return day if grain == "day" else F.trunc(day, grain)


@dataclass(frozen=True)
class PanelSpec:
    """Which columns of ``lineitem`` and ``part`` name the universe and the asset."""

    grain: str
    asset: str
    universe: str | None = None

    @property
    def needs_part(self) -> bool:
        return any(c and c.startswith("p_") for c in (self.asset, self.universe))


TYPES_DAY = PanelSpec("day", "p_type")
TYPES_WEEK = PanelSpec("week", "p_type")
BRANDS_WEEK = PanelSpec("week", "p_brand")
BRANDS_DAY = PanelSpec("day", "p_brand")
FLAGS_DAY = PanelSpec("day", "l_returnflag")
BRAND_FLAGS_MONTH = PanelSpec("month", "l_returnflag", "p_brand")


def price_panel(spark: SparkSession, sf_dir: str, spec: PanelSpec) -> DataFrame:
    """Average unit price per universe, date and asset.

    The join side keeps only the columns used. Spark broadcasts ``part`` when
    its size is under the session's threshold and otherwise sort-merges with
    adaptive splitting of hot part keys; the average is combined map-side, so
    the second shuffle carries one row per key and task.
    """
    lines = read_table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_returnflag", "l_shipdate", "l_extendedprice", "l_quantity"
    )
    if spec.needs_part:
        used = {"p_partkey", spec.asset, spec.universe} - {None, "l_returnflag"}
        part = read_table(spark, sf_dir, "part").select(*sorted(used))
        lines = lines.join(part, lines["l_partkey"] == part["p_partkey"])
    universe = F.col(spec.universe) if spec.universe else F.lit(ONE_UNIVERSE)
    return lines.groupBy(
        universe.alias("universe"),
        period_start(F.col("l_shipdate"), spec.grain).alias("dt"),
        F.col(spec.asset).alias("asset"),
    ).agg(F.avg(F.col("l_extendedprice") / F.nullif("l_quantity", F.lit(0.0))).alias("price"))


def with_benchmark(prices: DataFrame, name: str = "MKT") -> DataFrame:
    """Append the equal-weight average price per date as one more asset."""
    market = prices.groupBy("universe", "dt").agg(F.avg("price").alias("price"))
    return prices.unionByName(market.select("universe", "dt", F.lit(name).alias("asset"), "price"))


def track_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(entity, grp, n, wins)``: in how many months a supplier beat the average one.

    The benchmark is the month's mean revenue, which combines map-side, rather
    than a median, which would need all suppliers of a month in one place. Both
    tables are written: revenue is read twice, and the few months are then known
    to be few.
    """
    revenue = materialise(
        read_table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", period_start(F.col("l_shipdate"), "month").alias("month"))
        .agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue")),
        "revenue",
    )
    market = materialise(revenue.groupBy("month").agg(F.avg("revenue").alias("market")), "market")
    records = (
        revenue.join(market, "month")
        .groupBy("l_suppkey")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.when(F.col("revenue") > F.col("market"), 1).otherwise(0)).alias("wins"),
        )
    )
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return records.join(supplier, records["l_suppkey"] == supplier["s_suppkey"]).select(
        F.col("l_suppkey").alias("entity"), F.col("s_nationkey").cast("long").alias("grp"), "n", "wins"
    )


# Annual spot rates for tenors 1 to 10.
BASE_SPOT = [0.0300, 0.0310, 0.0320, 0.0330, 0.0340, 0.0350, 0.0355, 0.0360, 0.0365, 0.0370]


def _curve_id() -> Column:
    """One curve per customer nation and order month."""
    months = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    return (F.col("c_nationkey").cast("long") * 100000 + months).alias("curve_id")


def _orders_with_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"
    )
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"])


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Swaption contracts: ``(contract_id, curve_id, desk, notional, strike_step, exercise)``.

    The strike is 3 percent plus 10 bp per step; see :func:`strike_of`. The step
    is an integer so that it can be a grouping and join key.
    """
    step = F.col("o_orderkey") % 20
    return _orders_with_customer(spark, sf_dir).select(
        F.col("o_orderkey").alias("contract_id"),
        _curve_id(),
        F.col("c_mktsegment").alias("desk"),
        F.col("o_totalprice").alias("notional"),
        step.alias("strike_step"),
        (1 + F.col("o_orderkey") % 8).alias("exercise"),
    )


def strike_of(step: Column) -> Column:
    return F.lit(0.03) + F.lit(0.001) * step


def curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(curve_id, spot ARRAY<DOUBLE>)``: the base curve shifted by -100 to +100 bp.

    The shift in steps of 10 bp is taken from the number of orders of that
    nation and month, so the scenario set grows with the tables.
    """
    return curves_of(_orders_with_customer(spark, sf_dir).select(_curve_id()))


def curves_of(contracts: DataFrame) -> DataFrame:
    """:func:`curves` from contracts (one for each order) that are there already."""
    counted = contracts.groupBy("curve_id").agg(F.count(F.lit(1)).alias("n_orders"))
    shift = F.lit(0.001) * (F.col("n_orders") % 21 - 10)
    return counted.select(
        "curve_id", F.array(*[F.lit(s) + shift for s in BASE_SPOT]).alias("spot")
    )


def bonds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(bond_id, issuer, face, recovery_step, maturity)``; recovery is a tenth of the step."""
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("bond_id"),
        F.col("p_brand").alias("issuer"),
        F.col("p_retailprice").alias("face"),
        (F.col("p_size") % 6).alias("recovery_step"),
        (1 + F.col("p_size") % 10).alias("maturity"),
    )

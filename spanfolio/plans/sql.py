"""Fragments of the SQL that the queries are checked against."""

from __future__ import annotations

from spanfolio.sources.tables import BASE_SPOT, PanelSpec


def rnd(expr: str, digits: int) -> str:
    return f"(round_even({expr}, {digits}) + 0.0)"


def with_(*ctes: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes) + "\n"


def prices(spec: PanelSpec, name: str = "prices") -> str:
    universe = spec.universe or "'ALL'"
    source = "lineitem JOIN part ON l_partkey = p_partkey" if spec.needs_part else "lineitem"
    return f"""{name} AS (
    SELECT {universe} AS universe, CAST(date_trunc('{spec.grain}', l_shipdate) AS DATE) AS dt,
           {spec.asset} AS asset, avg(l_extendedprice / nullif(l_quantity, 0)) AS price
    FROM {source} GROUP BY ALL)"""


def aligned(source: str = "prices", name: str = "px") -> str:
    return f"""{name} AS (
    SELECT p.universe, p.dt, c.ix, p.asset, p.price
    FROM {source} p JOIN (
        SELECT d.universe, d.dt, row_number() OVER (PARTITION BY d.universe ORDER BY d.dt) - 1 AS ix
        FROM (SELECT universe, dt, count(*) AS n FROM {source} GROUP BY ALL) d
        JOIN (SELECT universe, count(DISTINCT asset) AS n_assets FROM {source} GROUP BY ALL) s
          ON d.universe = s.universe AND d.n = s.n_assets) c
      ON p.universe = c.universe AND p.dt = c.dt)"""


def returns(source: str = "px", name: str = "rets") -> str:
    return f"""{name} AS (
    SELECT * FROM (
        SELECT universe, dt, ix - 1 AS ix, asset,
               price / lag(price) OVER (PARTITION BY universe, asset ORDER BY dt) - 1 AS r
        FROM {source}) WHERE r IS NOT NULL)"""


def padded(source: str = "prices") -> list[str]:
    """Returns on the full grid of dates and assets, each gap with the price before; ``ix`` counts all dates from 0."""
    return [
        f"""grid AS (
    SELECT a.universe, d.dt, d.ix, a.asset, p.price FROM (SELECT DISTINCT universe, asset FROM {source}) a
    JOIN (SELECT universe, dt, row_number() OVER (PARTITION BY universe ORDER BY dt) - 1 AS ix
          FROM (SELECT DISTINCT universe, dt FROM {source})) d USING (universe)
    LEFT JOIN {source} p ON p.universe = a.universe AND p.dt = d.dt AND p.asset = a.asset)""",
        """padded AS (
    SELECT universe, dt, ix, asset, last_value(price IGNORE NULLS) OVER (PARTITION BY universe, asset
           ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price FROM grid)""",
        """padded_rets AS (
    SELECT * FROM (SELECT universe, dt, ix, asset,
           price / lag(price) OVER (PARTITION BY universe, asset ORDER BY dt) - 1 AS r FROM padded)
    WHERE r IS NOT NULL)""",
    ]


def standardised(source: str = "rets", name: str = "zr") -> str:
    return f"""{name} AS (
    SELECT universe, dt, ix, asset,
           (r - avg(r) OVER (PARTITION BY universe, asset))
             / stddev_samp(r) OVER (PARTITION BY universe, asset) AS r
    FROM {source})"""


def base(spec: PanelSpec, standard: bool = False) -> list[str]:
    ctes = [prices(spec), aligned(), returns()]
    return ctes + [standardised()] if standard else ctes


def dates(source: str, name: str = "cal") -> str:
    return f"{name} AS (SELECT DISTINCT universe, dt, ix FROM {source})"


def schedule(start: int, step: int, stop: int | None = None, name: str = "sched") -> str:
    upper = "" if stop is None else f" AND ix < {stop}"
    return f"""{name} AS (
    SELECT * FROM cal WHERE ix >= {start} AND (ix - {start}) % {step} = 0{upper})"""


def window_cov(source: str, lookback: int | None, name: str = "wcov", value: str = "r") -> str:
    """Covariance straight from the raw rows of each scheduled window."""
    lower = "" if lookback is None else f" AND a.ix >= s.ix - {lookback}"
    a, b = (value.replace("$", f"{t}.") if "$" in value else f"{t}.{value}" for t in "ab")
    return f"""{name} AS (
    SELECT s.universe, s.dt, s.ix, a.asset AS ai, b.asset AS aj, count(*) AS n,
           covar_samp({a}, {b}) AS cov
    FROM sched s
    JOIN {source} a ON a.universe = s.universe AND a.ix < s.ix{lower}
    JOIN {source} b ON b.universe = a.universe AND b.ix = a.ix AND a.asset <= b.asset
    GROUP BY ALL)"""


def sample_cov(source: str = "rets", name: str = "cov") -> str:
    return f"""{name} AS (
    SELECT a.universe, a.asset AS ai, b.asset AS aj, count(*) AS n, covar_samp(a.r, b.r) AS cov
    FROM {source} a JOIN {source} b
      ON a.universe = b.universe AND a.ix = b.ix AND a.asset <= b.asset
    GROUP BY ALL)"""


def means(source: str = "rets", name: str = "mu") -> str:
    return f"{name} AS (SELECT universe, asset, avg(r) AS mu FROM {source} GROUP BY ALL)"


FLAGS = ("A", "N", "R")


def three_by_three(source: str, keys: str, name: str = "m3", where: str = "TRUE") -> str:
    """Entries s11..s33 of the covariance of the three flags, one row per key."""
    cells = ", ".join(
        f"max(cov) FILTER (WHERE ai = '{FLAGS[i]}' AND aj = '{FLAGS[j]}') AS s{i + 1}{j + 1}"
        for i in range(3)
        for j in range(i, 3)
    )
    return f"{name} AS (SELECT {keys}, {cells} FROM {source} WHERE {where} GROUP BY {keys})"


def eigen_three(source: str, keys: str, name: str = "eig") -> str:
    """Eigenvalues l1 >= l2 >= l3 of a symmetric 3 x 3 matrix by the trigonometric formula."""
    return f"""{name} AS (
    SELECT {keys}, q + 2 * p * cos(phi) AS l1,
           3 * q - (q + 2 * p * cos(phi)) - (q + 2 * p * cos(phi + 2 * pi() / 3)) AS l2,
           q + 2 * p * cos(phi + 2 * pi() / 3) AS l3
    FROM (SELECT *, acos(greatest(-1.0, least(1.0,
              ((s11 - q) * ((s22 - q) * (s33 - q) - s23 * s23)
               - s12 * (s12 * (s33 - q) - s23 * s13)
               + s13 * (s12 * s23 - (s22 - q) * s13)) / (2 * p * p * p)))) / 3 AS phi
          FROM (SELECT *, sqrt(((s11 - q) ** 2 + (s22 - q) ** 2 + (s33 - q) ** 2
                    + 2 * (s12 ** 2 + s13 ** 2 + s23 ** 2)) / 6) AS p
                FROM (SELECT *, (s11 + s22 + s33) / 3 AS q FROM {source}))))"""


def solves_three(keys: str = "universe", name: str = "sol") -> str:
    """``inv(S) 1`` (x1..x3) and ``inv(S) mu`` (y1..y3) by cofactors, with A, B, C."""
    return f"""{name} AS (
    SELECT *, x1 + x2 + x3 AS a, y1 + y2 + y3 AS b, y1 * m1 + y2 * m2 + y3 * m3 AS c
    FROM (SELECT *, (i11 + i12 + i13) / det AS x1, (i12 + i22 + i23) / det AS x2,
                 (i13 + i23 + i33) / det AS x3,
                 (i11 * m1 + i12 * m2 + i13 * m3) / det AS y1,
                 (i12 * m1 + i22 * m2 + i23 * m3) / det AS y2,
                 (i13 * m1 + i23 * m2 + i33 * m3) / det AS y3
          FROM (SELECT *, s11 * i11 + s12 * i12 + s13 * i13 AS det
                FROM (SELECT m3.*, mm.m1, mm.m2, mm.m3, mm.avg_mu,
                             s22 * s33 - s23 * s23 AS i11, s13 * s23 - s12 * s33 AS i12,
                             s12 * s23 - s13 * s22 AS i13, s11 * s33 - s13 * s13 AS i22,
                             s12 * s13 - s11 * s23 AS i23, s11 * s22 - s12 * s12 AS i33
                      FROM m3 JOIN (
                          SELECT universe, avg(mu) AS avg_mu,
                                 max(mu) FILTER (WHERE asset = 'A') AS m1,
                                 max(mu) FILTER (WHERE asset = 'N') AS m2,
                                 max(mu) FILTER (WHERE asset = 'R') AS m3
                          FROM mu GROUP BY universe) mm USING (universe)))))"""


def levels(name: str = "cal_levels") -> list[str]:
    """Curves, and short-rate levels per distinct shift found by bisection."""
    spots = ", ".join(str(s) for s in BASE_SPOT)
    price = "list_sum(list_transform(q, lambda x, j: x / (1 + {a} * exp(0.1 * (j - 1)))))"
    mid = "((v.lo + v.hi) / 2)"
    return [
        """cv AS (
    SELECT c_nationkey::BIGINT * 100000 + year(o_orderdate) * 12 + month(o_orderdate) AS curve_id,
           count(*) % 21 - 10 AS sh
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)""",
        f"""fit(sh, i, q, lv) AS (
    SELECT DISTINCT sh, 0::BIGINT, [1.0::DOUBLE], []::DOUBLE[] FROM cv
    UNION ALL
    SELECT sh, i + 1,
           list_transform(range(0, i + 2), lambda j:
               (CASE WHEN j <= i THEN 0.5 * q[j + 1] / (1 + a * exp(0.1 * j)) ELSE 0.0 END)
               + (CASE WHEN j >= 1 THEN 0.5 * q[j] / (1 + a * exp(0.1 * (j - 1))) ELSE 0.0 END)),
           list_append(lv, a)
    FROM (SELECT *, (hit.lo + hit.hi) / 2 AS a
          FROM (SELECT *, list_reduce(
                    list_transform(range(64), lambda z: {{'lo': 0.0::DOUBLE, 'hi': 0.0::DOUBLE}}),
                    lambda v, z: CASE WHEN {price.format(a=mid)} > target
                        THEN {{'lo': {mid}, 'hi': v.hi}} ELSE {{'lo': v.lo, 'hi': {mid}}} END,
                    {{'lo': 1e-6::DOUBLE, 'hi': 1.0::DOUBLE}}) AS hit
                FROM (SELECT *, (1 + ([{spots}]::DOUBLE[])[i + 1] + 0.001::DOUBLE * sh)
                             ** (-(i + 1)::DOUBLE) AS target
                      FROM fit WHERE i < 10))))""",
        f"{name} AS (SELECT sh, lv FROM fit WHERE i = 10)",
    ]


def terms() -> list[str]:
    """Positions by curve, desk and terms, and swap states and swaption value per terms."""
    rate = "lv[x[1]::BIGINT + 1] * exp(0.1 * j)"
    return [
        """held AS (
    SELECT c_nationkey::BIGINT * 100000 + year(o_orderdate) * 12 + month(o_orderdate) AS curve_id,
           c_nationkey::BIGINT AS nation, c_mktsegment AS desk, o_orderkey % 20 AS strike_step,
           1 + o_orderkey % 8 AS exercise, sum(o_totalprice) AS notional
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)""",
        f"""unit AS (
    SELECT sh, strike_step, exercise, states, (list_reduce(
               list_transform(range(exercise - 1, -1, -1), lambda i: [i::DOUBLE]),
               lambda v, x: list_transform(range(0, x[1]::BIGINT + 1), lambda j:
                   0.5 * (v[j + 1] + v[j + 2]) / (1 + {rate})),
               list_transform(states, lambda s: greatest(s, 0.0))))[1] AS value
    FROM (SELECT sh, strike_step, exercise, lv, list_reduce(
               list_transform(range(9, exercise - 1, -1), lambda i: [i::DOUBLE]),
               lambda v, x: list_transform(range(0, x[1]::BIGINT + 1), lambda j:
                   (0.5 * (v[j + 1] + v[j + 2]) + {rate} - (0.03 + 0.001::DOUBLE * strike_step))
                   / (1 + {rate})),
               list_transform(range(11), lambda z: 0.0::DOUBLE)) AS states
          FROM (SELECT DISTINCT sh, strike_step, exercise, lv
                FROM held JOIN cv USING (curve_id) JOIN cal_levels USING (sh))))""",
    ]

"""Shared pieces of the oracle SQL: the feeds as common table expressions and the formulas as text."""

from __future__ import annotations

from zonewise import dims
from zonewise.functions.air import slope


def num(value: float) -> str:
    """A double literal (a plain decimal literal would be a DECIMAL)."""
    text = repr(float(value))
    return text if "e" in text else f"{text}e0"


def zone(i: str) -> str:
    return (f"substr('MNBKQNBXSI', CAST(2 * ((({i}) % 30) // 6) + 1 AS INTEGER), 2)"
            f" || '-0' || CAST(({i}) % 6 + 1 AS VARCHAR)")


def case(value: str, mapping: dict, default: str) -> str:
    arms = " ".join(
        f"WHEN '{k}' THEN {num(v) if isinstance(v, float) else v if isinstance(v, int) else repr(v)}"
        for k, v in mapping.items()
    )
    return f"CASE {value} {arms} ELSE {default} END"


def index(conc: str, table: list[tuple], beyond: str = "500e0") -> str:
    arms = " ".join(
        f"WHEN {conc} BETWEEN {num(lo)} AND {num(hi)} THEN "
        f"{num(slope(lo, hi, ilo, ihi))} * ({conc} - {num(lo)}) + {num(ilo)}"
        for lo, hi, ilo, ihi in table
    )
    return f"CASE {arms} ELSE {beyond} END"


def combined_index(pm25: str, no2: str) -> str:
    return f"greatest({index(pm25, dims.PM25_BREAKPOINTS)}, {index(no2, dims.NO2_BREAKPOINTS)})"


def units(expr: str, digits: int = 2) -> str:
    return f"CAST(({expr}) * {num(10 ** digits)} AS BIGINT)"


def mean(expr: str) -> str:
    """The mean of all bits: whole parts and two stretches of 26 binary places are added up as integers."""
    x, part = f"CAST({expr} AS DOUBLE)", "67108864e0"
    rest = f"(({x} - floor({x})) * {part})"
    added = lambda v: f"CAST(sum(CAST(floor({v}) AS BIGINT)) AS DOUBLE)"
    low = added(f"(({rest} - floor({rest})) * {part})")
    return f"(({added(x)} + ({added(rest)} + {low} / {part}) / {part}) / CAST(nullif(count({x}), 0) AS DOUBLE))"


def _spread(expr: str) -> str:
    u = f"CAST({units(expr, 6)} AS HUGEINT)"
    return f"CAST(count({expr}) * sum({u} * {u}) - sum({u}) * sum({u}) AS DOUBLE)"


def stddev_pop(expr: str) -> str:
    n = f"CAST(count({expr}) AS DOUBLE)"
    return f"(sqrt({_spread(expr)} / nullif({n} * {n}, 0e0)) / 1e6)"


def stddev_samp(expr: str) -> str:
    n = f"CAST(count({expr}) AS DOUBLE)"
    return f"(sqrt({_spread(expr)} / nullif({n} * ({n} - 1e0), 0e0)) / 1e6)"


def zone_ord(column: str) -> str:
    start = case(f"substr({column}, 1, 2)", {b: 6 * i for i, b in enumerate(dims.BOROUGHS)}, "NULL")
    return f"(({start}) + CAST(substr({column}, 4, 2) AS INTEGER) - 1)"


def borough(column: str) -> str:
    return case(f"substr({column}, 1, 2)", dims.BOROUGH_NAMES, "''")


def density(column: str) -> str:
    return f"({case(f'substr({column}, 1, 2)', dims.BOROUGH_DENSITY, '0.5e0')})"


def score(speed: str, aqi: str) -> str:
    return f"(least(1e0, {speed} / 40e0) * 0.5e0 + least(1e0, {aqi} / 100e0) * 0.5e0)"


def event_class(speed: str, aqi: str, low: float = dims.BASELINE_SPEED * 0.85, high: float = 38.0) -> str:
    c, p = f"{speed} < {num(low)}", f"{aqi} > {num(high)}"
    return (f"CASE WHEN {c} AND {p} THEN 'COMPOUND_EVENT' WHEN {c} THEN 'CONGESTION_EVENT' "
            f"WHEN {p} THEN 'POLLUTION_ALERT' ELSE 'NORMAL' END")


def status(hours: str) -> str:
    return f"CASE WHEN {hours} > 3e0 THEN 'CRITICAL' WHEN {hours} > 1.5e0 THEN 'WARNING' ELSE 'SAFE' END"


def weight(column: str) -> str:
    return f"({case(column, dims.CLUSTER_WEIGHTS, '1e0')})"


DAY = "strftime(ts, '%Y-%m-%d')"

FEEDS = f"""
ev AS (
  SELECT event_id, ts, user_id, event_type, value, props, {DAY} AS day,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k
  FROM events),
traffic AS (
  SELECT event_id, 'SEG-' || CAST(event_id AS VARCHAR) AS segment_id, {zone('user_id')} AS zone_id,
         value AS speed_kmh, ts, day, user_id, k
  FROM ev WHERE event_type IN ('click', 'view')),
pollution AS (
  SELECT event_id, 'ST-' || CAST(user_id AS VARCHAR) AS station_id, {zone('user_id')} AS zone_id, value AS pm25,
         CAST(k AS DOUBLE) AS no2, {combined_index('value', 'CAST(k AS DOUBLE)')} AS aqi, ts, day, event_type, user_id
  FROM ev WHERE event_type IN ('error', 'purchase')),
worker AS (
  SELECT event_id, 'W-' || lpad(CAST(user_id % 50 + 1 AS VARCHAR), 2, '0') AS worker_id, {zone('event_id')} AS zone_id,
         ts, day, k
  FROM ev WHERE event_type = 'signup'),
weather AS (
  SELECT event_id, value - 10e0 AS temperature, CAST(k AS DOUBLE) AS humidity, value / 2e0 AS windspeed, ts, day
  FROM ev)"""


def state(by: str = "") -> str:
    """Fused and scored zone means; `by` is an extra grouping column such as "day"."""
    extra = f", {by}" if by else ""
    join_key = f"zone_id{extra}"
    return f"""
t_mean AS (SELECT zone_id{extra}, {mean('speed_kmh')} AS avg_speed FROM traffic GROUP BY {join_key}),
p_mean AS (SELECT zone_id{extra}, {mean('aqi')} AS avg_aqi, {mean('pm25')} AS avg_pm25, {mean('no2')} AS avg_no2
           FROM pollution GROUP BY {join_key}),
fused AS (SELECT {join_key}, coalesce(avg_speed, 40e0) AS avg_speed, coalesce(avg_aqi, 50e0) AS avg_aqi,
                 coalesce(avg_pm25, 10e0) AS avg_pm25, coalesce(avg_no2, 20e0) AS avg_no2
          FROM t_mean FULL OUTER JOIN p_mean USING ({join_key})),
scored AS (SELECT *, {score('avg_speed', 'avg_aqi')} AS zone_score, {event_class('avg_speed', 'avg_aqi')} AS event_type
           FROM fused)"""


ZONES = f"""
zones AS (SELECT {zone('i')} AS zone_id, CAST(i AS INTEGER) AS zone_ord FROM range(30) r(i))"""


def query(body: str, *ctes: str) -> str:
    return "WITH " + ",".join([FEEDS, *ctes]) + "\n" + body

"""Short-term air quality per zone: the last readings as an array, and an autoregressive forecast."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewise.operators.ordered import trailing_values

HISTORY = 12
LAGS = 3
#: Below these shares of what they could be at most, a determinant counts as zero: rounding leaves about 1e-16.
_FLAT_3, _FLAT_2 = 1e-12, 1e-13


def with_history(
    readings: DataFrame, order: Column, keys: list[str] | None = None, aqi: str = "aqi", length: int = HISTORY,
) -> DataFrame:
    """Add the zone's last readings, oldest first, as `history`."""
    return trailing_values(readings, keys or ["zone_id"], order, F.col(aqi), length, "history")


def _let(values: dict[str, Column], body: Callable[[Column], Column]) -> Column:
    """`body` of some named values, each of which is computed once."""
    return F.element_at(F.transform(F.array(F.struct(*[c.alias(n) for n, c in values.items()])), body), 1)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def _products(columns: dict[str, Column], target: Column) -> dict[str, Column]:
    """The products of three columns with each other and with the target: the normal equations."""
    names = list(columns)
    out = {f"a{i}{j}": _dot(columns[names[i]], columns[names[j]]) for i in range(3) for j in range(i, 3)}
    return out | {f"b{i}": _dot(columns[n], target) for i, n in enumerate(names)}


def _of(m: Column, i: int, j: int) -> Column:
    return m[f"a{min(i, j)}{max(i, j)}"]


def _minor(m: Column, i: int, j: int) -> Column:
    """The cofactor of a symmetric matrix of three rows."""
    r, c = [k for k in range(3) if k != i], [k for k in range(3) if k != j]
    value = _of(m, r[0], c[0]) * _of(m, r[1], c[1]) - _of(m, r[0], c[1]) * _of(m, r[1], c[0])
    return value if (i + j) % 2 == 0 else -value


def _determinant(m: Column) -> Column:
    return sum((_of(m, 0, j) * _minor(m, 0, j) for j in (1, 2)), _of(m, 0, 0) * _minor(m, 0, 0))


def autoregressive_step(history: Column) -> Column:
    """The next value of an array of four or more by least squares on its three earlier values, without intercept; of
    several best fits that with the smallest weights.

    The three lags are replaced by the first of them and the differences after it, each divided by its size, which keeps
    nearly equal values apart, and the normal equations are written out by rank: with full rank by cofactors, with
    rank two from the two columns that differ most, less the share of the weights along which the fit doesn't change, with
    rank one from the lags themselves.
    """
    rows = F.size(history) - LAGS
    lags = [F.slice(history, F.lit(k + 1), rows) for k in range(LAGS)]
    differ = lambda a, b: F.zip_with(a, b, lambda x, y: y - x)
    last = [F.element_at(history, k - LAGS) for k in range(LAGS)]
    ahead = [last[0], last[1] - last[0], last[2] - last[1]]
    total = lambda terms: sum(terms[1:], terms[0])

    def scaled(s: Column) -> Column:
        """The products of columns of size one; a column of zeros stays."""
        size = [F.when(_of(s, k, k) > 0, F.sqrt(_of(s, k, k))).otherwise(1.0) for k in range(3)]
        return F.struct(*[(_of(s, i, j) / (size[i] * size[j])).alias(f"a{i}{j}") for i in range(3) for j in range(i, 3)],
                        *[(s[f"b{i}"] / size[i]).alias(f"b{i}") for i in range(3)], *[size[i].alias(f"s{i}") for i in range(3)])

    def full(m: Column) -> Column:
        return total([ahead[i] / m[f"s{i}"] * total([_minor(m, i, j) * m[f"b{j}"] for j in range(3)]) for i in range(3)]) / _determinant(m)

    def pair(m: Column, i: int, j: int) -> Column:
        """How far two columns are from being parallel."""
        return _of(m, i, i) * _of(m, j, j) - _of(m, i, j) * _of(m, i, j)

    def weights(g: list[Column]) -> list[Column]:
        """Of the lags, from those of the first lag and the differences."""
        return [g[0] - g[1], g[1] - g[2], g[2]]

    def two(m: Column, i: int, j: int, k: int) -> Column:
        fit, free = [F.lit(0.0)] * 3, [F.lit(0.0)] * 3
        for x, y in ((i, j), (j, i)):
            fit[x] = (m[f"b{x}"] * _of(m, y, y) - _of(m, x, y) * m[f"b{y}"]) / pair(m, i, j) / m[f"s{x}"]
            free[x] = (_of(m, x, k) * _of(m, y, y) - _of(m, x, y) * _of(m, y, k)) / pair(m, i, j) / m[f"s{x}"]
        free[k] = F.lit(-1.0) / m[f"s{k}"]
        return _let({f"w{x}": w for x, w in enumerate(weights(fit))} | {f"v{x}": v for x, v in enumerate(weights(free))}, lambda y: total(
            [(y[f"w{x}"] - y[f"v{x}"] * total([y[f"v{z}"] * y[f"w{z}"] for z in range(3)]) / total([y[f"v{z}"] * y[f"v{z}"] for z in range(3)]))
             * last[x] for x in range(3)]))

    def solved(s: Column) -> Column:
        m, plain = s["m"], s["plain"]
        trace = total([_of(plain, k, k) for k in range(3)])
        pairs = [(0, 1, 2), (0, 2, 1), (1, 2, 0)]
        best = F.greatest(*[pair(m, i, j) for i, j, _ in pairs])
        out = F.when(trace <= 0, F.lit(0.0)).when((rows >= LAGS) & (_determinant(m) > F.lit(_FLAT_3)), full(m))
        for i, j, k in pairs:
            out = out.when((rows >= 2) & (best > F.lit(_FLAT_2)) & (pair(m, i, j) == best), two(m, i, j, k))
        return out.otherwise(total([plain[f"b{k}"] / trace * last[k] for k in range(3)]))

    changes = {"l": lags[0], "d": differ(lags[0], lags[1]), "e": differ(lags[1], lags[2])}
    target = F.slice(history, F.lit(LAGS + 1), rows)
    return _let({
        "plain": F.struct(*[c.alias(k) for k, c in _products(dict(zip("xyz", lags)), target).items()]),
        "steps": F.struct(*[c.alias(k) for k, c in _products(changes, target).items()]),
    }, lambda s: _let({"m": scaled(s["steps"]), "plain": s["plain"]}, solved))


def forecast_aqi(history: Column) -> Column:
    """Forecast clamped to 0..500; with fewer than 4 readings, or where there is no finite forecast, the current value."""
    history = history.cast("array<double>")
    current = F.try_element_at(history, F.lit(-1))
    step = F.when(F.size(history) > LAGS, autoregressive_step(history))
    sound = step.isNotNull() & ~F.isnan(step) & (F.abs(step) < float("inf"))
    return F.when(sound, F.greatest(F.lit(0.0), F.least(F.lit(500.0), step))).otherwise(current)

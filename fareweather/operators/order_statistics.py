"""Exact medians and percentiles by radix descent, without a global order.

A double becomes a 64-bit integer that sorts as the value does: its sign, exponent
and mantissa, found by exact arithmetic (powers of two), so all of it stays in
generated code. The place of a rank is then found digit by digit: one level sums the
weight of each value of the next 12 bits, keeps the one in which the rank falls, and
goes on below it. A level has at most 4096 groups a rank, whatever the values look like,
and each task sends at most that many sums. The descent ends early where a group holds
one value only, mostly after two or three levels of six.

All measures and ranks share the passes. Weights are added up exactly, fractions to 12
decimals, so the result does not depend on the order of rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegralType

from fareweather.functions.numeric import _COARSE, _FINE, _LIMB, _cut

_DIGIT = 12
_MANTISSA = 52
#: Right shifts of the key at each level: sign and exponent first.
_SHIFTS = (52, 40, 28, 16, 4, 0)
_ONE = _FINE  # a weight of one, in the units of the sums


def order_key(x: str) -> str:
    """SQL of a BIGINT that orders doubles as their values; zero has one key.

    Not-a-number is above all values. ``x`` is SQL of a double, used several times.
    """
    size = f"abs({x})"
    # log2 may be off by one beside a power of two; dividing by the power is exact.
    guess = f"CAST(greatest(floor(log2({size})), -1022) AS INT)"
    scaled = f"({size} / pow(2D, {guess}))"
    exponent = f"({guess} + CASE WHEN {scaled} >= 2 THEN 1 WHEN {scaled} < 1 AND {guess} > -1022 THEN -1 ELSE 0 END)"
    unit = f"({size} / pow(2D, {exponent}))"
    normal = f"(shiftleft(CAST({exponent} + 1023 AS BIGINT), {_MANTISSA}) + CAST(({unit} - 1) * {1 << _MANTISSA}D AS BIGINT))"
    tiny = f"CAST({size} * pow(2D, 537) * pow(2D, 537) AS BIGINT)"
    bits = (
        f"CASE WHEN {size} = 0 THEN 0L WHEN {size} = double('Infinity') THEN {2047 << _MANTISSA}L "
        f"WHEN {size} < {2.0 ** -1022!r}D THEN {tiny} ELSE {normal} END"
    )
    return f"CASE WHEN isnan({x}) THEN {(1 << 63) - 1}L WHEN {x} < 0 THEN -({bits}) ELSE {bits} END"


@dataclass
class _Search:
    """One rank of one measure: the group it fell into so far."""

    measure: str
    goal: int
    place: int
    before: int = 0
    prefix: int | None = None
    low: float = -math.inf
    high: float = math.inf
    value: float | None = None


def _weights(df: DataFrame, weight: str | None) -> dict[str, str]:
    """SQL of sums that hold the whole weight exactly."""
    if weight is None:
        return {"whole": "count(1)"}
    if isinstance(df.schema[weight].dataType, IntegralType):
        return {"whole": f"sum(CAST(`{weight}` AS BIGINT))"}
    return {k: f"sum({v})" for k, v in _cut(f"`{weight}`").items()}


def _units(row) -> int:
    """The weight that the sums of a row stand for, in units of 10^-12."""
    if "whole" in row:
        return (row["whole"] or 0) * _ONE
    units = ((row["high"] or 0) << _LIMB) + (row["low"] or 0)
    return units * (_FINE // _COARSE) + (row["rest"] or 0) + int((row["apart"] or 0.0)) * _ONE


def values_at(
    df: DataFrame,
    measures: Mapping[str, str],
    goals: Callable[[str, int], Iterable[int]],
    weight: str | None = None,
) -> dict[str, list[float]]:
    """Of each measure the values at which the running weight, in value order, reaches
    the goals.

    ``measures`` names columns; ``goals`` gets a measure and its whole weight in units
    of 10^-12 and returns goals in the same units. Rows without a value, or with a weight
    that is not positive, do not count. A measure without rows is left out.
    """
    named = ", ".join(f"struct('{name}' AS measure, CAST(`{column}` AS DOUBLE) AS value)" for name, column in measures.items())
    columns = [f"inline(array({named}))"] + ([f"`{weight}`"] if weight else [])
    points = (df.where(F.col(weight) > 0) if weight else df).selectExpr(*columns).where("value IS NOT NULL")
    keyed = points.withColumn("key", F.expr(order_key("value")))
    sums = [F.expr(sql).alias(name) for name, sql in _weights(df, weight).items()]
    sums += [F.min("value").alias("least"), F.max("value").alias("most")]

    open_: list[_Search] | None = None
    found: list[_Search] = []
    for level, shift in enumerate(_SHIFTS):
        own = keyed
        if open_ is not None:
            # A few ranges, one a rank; they reach the scan of a sorted table.
            wanted = [f"measure = '{s.measure}' AND value BETWEEN {_sql(s.low)} AND {_sql(s.high)}" for s in open_]
            own = keyed.where(" OR ".join(dict.fromkeys(f"({w})" for w in wanted)))
        rows = own.groupBy("measure", F.shiftright("key", shift).alias("digit")).agg(*sums).collect()
        groups: dict[str, list] = {}
        for row in sorted((r.asDict() for r in rows), key=lambda r: r["digit"]):
            groups.setdefault(row["measure"], []).append(row)
        if open_ is None:
            open_ = [
                _Search(name, goal, place)
                for name, own_groups in groups.items()
                for place, goal in enumerate(goals(name, sum(_units(r) for r in own_groups)))
            ]
        left = []
        for s in open_:
            for row in groups[s.measure]:
                # Below the group chosen last: of another rank's range, or counted.
                if s.prefix is not None and row["digit"] >> (_SHIFTS[level - 1] - shift) != s.prefix:
                    continue
                s.before += _units(row)
                if s.before >= s.goal:
                    s.before -= _units(row)
                    s.prefix, s.low, s.high = row["digit"], row["least"], row["most"]
                    break
            if s.low == s.high or math.isnan(s.low) or shift == 0:
                s.value = s.low
                found.append(s)
            else:
                left.append(s)
        open_ = left
        if not open_:
            break
    out: dict[str, list[float]] = {}
    for s in sorted(found, key=lambda s: s.place):
        out.setdefault(s.measure, []).append(s.value)
    return out


def _sql(x: float) -> str:
    return f"double('{x!r}')"


def weighted_medians(df: DataFrame, measures: Mapping[str, str], weight: str) -> dict[str, float]:
    """Lower weighted medians: the first value at which half of all weight is reached."""
    got = values_at(df, measures, lambda _, total: [-(-total // 2)], weight)
    return {name: values[0] for name, values in got.items()}


def percentiles(df: DataFrame, columns: Iterable[str], at: Iterable[float]) -> dict[str, list[float]]:
    """Exact percentiles between neighbouring ranks, as the aggregate ``percentile``.

    A column without values is left out.
    """
    at, places = list(at), {}

    def goals(name: str, total: int) -> list[int]:
        last = total // _ONE - 1
        places[name] = [(last * p, math.floor(last * p), math.ceil(last * p)) for p in at]
        return [(rank + 1) * _ONE for _, low, high in places[name] for rank in (low, high)]

    out = {}
    for name, values in values_at(df, {c: c for c in columns}, goals).items():
        ends = []
        for (position, low, high), a, b in zip(places[name], values[::2], values[1::2]):
            ends.append(a if low == high or a == b else (high - position) * a + (position - low) * b)
        out[name] = ends
    return out

"""Rounding, exact sums and ratios as plain column expressions.

Two choices matter for speed at scale. Rounding goes through ``rint`` instead of
``round``, whose double path builds a decimal object per value. Sums of money,
distances and ratios run over 64-bit integers instead of doubles or decimals: a value
is cut into units of 10^-4, these into a high and a low limb of 20 bits, and what is
left into units of 10^-12. Integer addition does not depend on the order of the rows,
so a rerun task gives the same last digit; an overflow raises instead of wrapping.
A weighted sum multiplies each limb by the whole part of the weight and adds the limbs
of the product with its fraction, so it needs the same five sums. With values up to
10^9 a sum holds 2^39 rows or as much weight, with values up to 10^11 2^33. What no
limb can hold (not-a-number, infinities, sizes from 10^11) is summed apart, as doubles.

Where an argument is a string it is SQL, mostly the name of a column; the whole
aggregate is then built by one call of the parser instead of dozens of column objects,
each of which costs the driver a call into the JVM.
"""

from __future__ import annotations

from functools import cache

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, functions as F


def round_half(x: Column | str, digits: int) -> Column:
    """Round half away from zero on the scaled double; never gives -0.0."""
    if isinstance(x, str):
        size = f"abs({x} * {10**digits}D)"
        away = f"(rint({size}) + IF({size} - rint({size}) = 0.5D, 1D, 0D))"
        return _expr(f"signum({x}) * {away} / {10**digits}D + 0D")
    scale = F.lit(float(10**digits))
    size = F.abs(x * scale)
    whole = F.rint(size)
    away = whole + F.when(size - whole == 0.5, 1.0).otherwise(0.0)
    return F.signum(x) * away / scale + F.lit(0.0)


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Columns rounded half away from zero. After an aggregation this keeps the
    aggregates small: rounding names its argument several times."""
    return df.withColumns({name: round_half(name, digits) for name in names})


def round_even(x: Column, digits: int) -> Column:
    """Round half to even, as numeric Python libraries do."""
    scale = F.lit(float(10**digits))
    return F.rint(x * scale) / scale


_COARSE, _FINE, _LARGE, _LIMB = 10_000, 1_000_000_000_000, 100_000_000_000, 20
#: The sums that hold a total; ``count`` tells whether there is a value at all.
LIMBS = ("high", "low", "rest", "apart", "count")


def _cut(x: str) -> dict[str, str]:
    """SQL of the parts of a value: limbs of its units, its rest, or itself apart."""
    x = f"CAST({x} AS DOUBLE)"
    plain = f"IF(abs({x}) < {_LARGE}, {x}, NULL)"
    units = f"rint({plain} * {_COARSE}D)"
    return {
        "high": f"shiftright(CAST({units} AS BIGINT), {_LIMB})",
        "low": f"(CAST({units} AS BIGINT) & {(1 << _LIMB) - 1})",
        "rest": f"CAST(rint(({plain} - {units} / {_COARSE}D) * {_FINE}D) AS BIGINT)",
        "apart": f"IF(abs({x}) < {_LARGE}, NULL, {x})",
    }


def _weighted_cut(x: str, weight: str, whole: bool) -> dict[str, str]:
    """SQL of the parts of ``x * weight``, exact for the whole part of the weight."""
    parts = _cut(x)
    if whole:
        return {k: f"{part} * {weight}" for k, part in parts.items()}
    weight = f"CAST({weight} AS DOUBLE)"
    left = f"({weight} - floor({weight}))"
    more = _cut(f"{x} * {left}")
    both = {k: f"{parts[k]} * CAST(floor({weight}) AS BIGINT) + IF({left} > 0, {more[k]}, 0)" for k in ("high", "low", "rest")}
    return {**both, "apart": f"{parts['apart']} * {weight}"}


def _total(parts: dict[str, str]) -> str:
    """SQL of the double that sums of parts stand for."""
    high, low, rest = [f"coalesce({parts[k]}, 0)" for k in ("high", "low", "rest")]
    total = f"({high} * {1 << _LIMB}D + {low}) / {_COARSE}D + {rest} / {_FINE}D + coalesce({parts['apart']}, 0D)"
    return f"IF({parts['count']} > 0, {total}, NULL)"


def _summed(parts: dict[str, str], counted: str, where: str = "") -> str:
    """SQL of the total of parts, of the rows in ``where`` if that is given."""
    only = f" FILTER (WHERE {where})" if where else ""
    return _total({k: f"sum({v}){only}" for k, v in parts.items()} | {"count": f"count({counted}){only}"})


@cache
def _parsed(text: str, jvm: int) -> Column:
    return F.expr(text)


def _expr(text: str) -> Column:
    """An expression, parsed once for each JVM; columns are values and can be used again."""
    return _parsed(text, id(SparkContext._gateway))


def _columns(x: Column) -> dict[str, Column]:
    """As :func:`_cut`, for a value that is no SQL text."""
    x = x.cast("double")
    plain = F.when(F.abs(x) < _LARGE, x)
    units = F.rint(plain * float(_COARSE))
    whole = units.cast("bigint")
    return {
        "high": F.shiftright(whole, _LIMB),
        "low": whole.bitwiseAND((1 << _LIMB) - 1),
        "rest": F.rint((plain - units / float(_COARSE)) * float(_FINE)).cast("bigint"),
        "apart": F.when(~(F.abs(x) < _LARGE), x),
    }


def _total_column(parts: dict[str, Column], count: Column) -> Column:
    high, low, rest = [F.coalesce(parts[k], F.lit(0)) for k in ("high", "low", "rest")]
    units = high.cast("double") * float(1 << _LIMB) + low.cast("double")
    total = units / float(_COARSE) + rest / float(_FINE) + F.coalesce(parts["apart"], F.lit(0.0))
    return F.when(count > 0, total)


def exact_sum(x: Column | str) -> Column:
    """Sum to 12 decimals, whatever the order; null without a value."""
    if isinstance(x, str):
        return _expr(_summed(_cut(x), x))
    return _total_column({k: F.sum(v) for k, v in _columns(x).items()}, F.count(x))


def exact_avg(x: Column | str) -> Column:
    if isinstance(x, str):
        return _expr(f"try_divide({_summed(_cut(x), x)}, count({x}))")
    return F.try_divide(exact_sum(x), F.count(x))


def sum_state(name: str) -> list[Column]:
    """Aggregates that hold an exact sum of a column and can be summed on."""
    parts = [_expr(f"sum({part})").alias(f"{name}_{k}") for k, part in _cut(name).items()]
    return [*parts, F.count(name).alias(f"{name}_count")]


def _state(name: str) -> str:
    return _total({k: f"sum({name}_{k})" for k in LIMBS})


def state_sum(name: str) -> Column:
    """As :func:`exact_sum` of the column whose :func:`sum_state` is given, to the bit."""
    return _expr(_state(name))


def state_avg(name: str) -> Column:
    return _expr(f"try_divide({_state(name)}, sum({name}_count))")


def sum2(x: Column | str) -> Column:
    return round_half(exact_sum(x), 2)


def avg2(x: Column | str) -> Column:
    return round_half(exact_avg(x), 2)


def _weighted_sum(x: Column, weight: Column) -> Column:
    """As the text form, for arguments that are no SQL text."""
    weight = weight.cast("double")
    value = F.when(weight.isNotNull(), x.cast("double"))
    whole, left = F.floor(weight).cast("bigint"), weight - F.floor(weight)
    parts, more = _columns(value), _columns(value * left)
    both = {k: F.sum(parts[k] * whole + F.when(left > 0, more[k]).otherwise(0)) for k in ("high", "low", "rest")}
    return _total_column({**both, "apart": F.sum(parts["apart"] * weight)}, F.count(value))


def _mean_of_text(x: str, weight: str, whole: bool, where: str = "") -> Column:
    only = f" FILTER (WHERE {where})" if where else ""
    top = _summed(_weighted_cut(x, weight, whole), f"IF({weight} IS NULL, NULL, {x})", where)
    below = f"CAST(sum({weight}){only} AS DOUBLE)" if whole else _summed(_cut(weight), weight, where)
    return _expr(f"try_divide({top}, {below})")


def weighted_mean(x: Column | str, weight: Column | str, whole: bool = False) -> Column:
    """``sum(x*w)/sum(w)``: a null ``x`` leaves the numerator only.

    ``whole``: the weight, as SQL text, is of an integer type.
    """
    if isinstance(x, str) and isinstance(weight, str):
        return _mean_of_text(x, weight, whole)
    x, weight = [F.expr(c) if isinstance(c, str) else c for c in (x, weight)]
    return F.try_divide(_weighted_sum(x, weight), exact_sum(weight))


def strict_weighted_mean(x: Column | str, weight: Column | str, whole: bool = False) -> Column:
    """Weighted mean whose both sums skip rows without a number or a weight > 0."""
    if isinstance(x, str) and isinstance(weight, str):
        number = _usable(x, weight)
        return _mean_of_text(x, weight, whole, number if whole else f"{number} AND NOT isnan(CAST({weight} AS DOUBLE))")
    x, weight = [(F.expr(c) if isinstance(c, str) else c).cast("double") for c in (x, weight)]
    usable = x.isNotNull() & ~F.isnan(x) & (weight > 0) & ~F.isnan(weight)
    return weighted_mean(F.when(usable, x), F.when(usable, weight))


def _usable(x: str, weight: str) -> str:
    return f"{x} IS NOT NULL AND NOT isnan(CAST({x} AS DOUBLE)) AND {weight} > 0"


def weighted_state(name: str, weight: str) -> list[Column]:
    """Aggregates that hold a strict weighted mean of a column, with a weight of an
    integer type, and can be summed on."""
    only = f" FILTER (WHERE {_usable(name, weight)})"
    parts = {**_weighted_cut(name, weight, True), "weight": weight}
    sums = [_expr(f"sum({part}){only}").alias(f"{name}_by_{k}") for k, part in parts.items()]
    return [*sums, _expr(f"count({name}){only}").alias(f"{name}_by_count")]


def weighted_state_mean(name: str) -> Column:
    """As :func:`strict_weighted_mean` of the column whose :func:`weighted_state` is
    given, to the bit."""
    total = _total({k: f"sum({name}_by_{k})" for k in LIMBS})
    return _expr(f"try_divide({total}, CAST(sum({name}_by_weight) AS DOUBLE))")


def lift_pct(x: Column, base: Column) -> Column:
    """Percentage above the baseline, two decimals, null on a zero baseline."""
    return round_half(F.try_divide(x - base, base) * 100.0, 2)


def delta(x: Column, base: Column) -> Column:
    return round_half(x - base, 2)


def finite(x: Column) -> Column:
    """Infinite and not-a-number values as null."""
    x = x.cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)

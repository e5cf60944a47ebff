import math
import random
import struct

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from fareweather.functions.local import local_rows
from fareweather.operators import order_statistics
from tests.test_explore import CASES, median_by_hand

HARD = [
    0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, -1.7976931348623157e308,
    1.0, math.nextafter(1.0, 0), math.nextafter(1.0, 2), 2.0, math.nextafter(2.0, 0), -2.0, 0.1, 1e300, 1e-300, float("inf"), float("-inf"),
]


def bits(x):
    if x == 0:
        return 0
    whole = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return whole if x > 0 else -whole


def keys(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    return [r["k"] for r in df.select("i", F.expr(order_statistics.order_key("x")).alias("k")).orderBy("i").collect()]


def test_keys_are_the_bits_of_the_value(spark):
    draw = random.Random(3)
    powers = [s * 2.0**e for e in range(-1074, 1024, 7) for s in (1, -1)]
    beside = [math.nextafter(p, d) for p in powers for d in (0, math.inf)]
    values = [*HARD, *powers, *beside, *[draw.uniform(-1, 1) * 10.0 ** draw.randrange(-300, 300) for _ in range(500)]]
    assert keys(spark, values) == [bits(v) for v in values]
    assert keys(spark, [float("nan"), None]) == [(1 << 63) - 1, None]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.floats(allow_nan=False), min_size=1, max_size=60))
def test_keys_sort_as_values(spark, values):
    got = keys(spark, values)
    assert [v for _, v in sorted(zip(got, values))] == sorted(values)


@pytest.mark.parametrize("kind", ["long", "double"])
def test_medians_of_several_measures(spark, kind):
    rows = [(a, b, w) for (a, w), (b, _) in zip(CASES["random"], CASES["skewed"])] + [(v, None, 1) for v in HARD] + [(None, 3.0, 2), (1.0, 1.0, None), (2.0, 2.0, 0)]
    df = spark.createDataFrame([(a, b, w if w is None else (float(w) if kind == "double" else w)) for a, b, w in rows], f"a double, b double, w {kind}")
    got = order_statistics.weighted_medians(df.repartition(5), {"x": "a", "y": "b", "z": "a"}, "w")
    assert got == {
        "x": median_by_hand([(a, w) for a, _, w in rows]), "y": median_by_hand([(b, w) for _, b, w in rows]), "z": got["x"],
    }


def test_fractional_weights_are_added_exactly(spark):
    # Ten tenths are exactly half of two, whatever the order of the rows.
    df = spark.createDataFrame([(1.0, 0.1)] * 10 + [(2.0, 1.0)], "v double, w double")
    assert order_statistics.weighted_medians(df.repartition(7), {"m": "v"}, "w") == {"m": 1.0}
    large = spark.createDataFrame([(1.0, 3e9), (2.0, 3e9), (3.0, 0.5)], "v double, w double")
    assert order_statistics.weighted_medians(large, {"m": "v"}, "w") == {"m": 2.0}


def test_a_million_values_in_a_sliver_beside_an_outlier(spark):
    df = spark.range(1_000_000).select((F.lit(1.0) + F.col("id") * 2.0**-52).alias("v"), F.lit(1).alias("w"))
    both = df.union(spark.createDataFrame([(1e300, 1)], "v double, w int"))
    assert order_statistics.weighted_medians(both, {"m": "v"}, "w") == {"m": 1.0 + 500_000 * 2.0**-52}


def test_percentiles_equal_the_aggregate(spark):
    df = spark.range(1_000_000).select(
        F.randn(3).alias("a"), (F.rand(4) * 10).cast("int").cast("double").alias("b"), F.when(F.rand(5) < 0.3, F.rand(6)).alias("c"), F.lit(None).cast("double").alias("d")
    ).persist()
    at = [0.0, 0.01, 0.5, 0.99, 1.0]
    want = df.agg(*[F.percentile(c, at).alias(c) for c in "abc"]).first().asDict()
    assert order_statistics.percentiles(df, "abcd", at) == want
    df.unpersist()
    one = spark.createDataFrame([(7.5,)], "a double")
    assert order_statistics.percentiles(one, ["a"], at) == {"a": [7.5] * 5}


def test_nothing_to_rank(spark):
    df = spark.createDataFrame([(None, 1), (2.0, 0)], "v double, w int")
    assert order_statistics.weighted_medians(df, {"m": "v"}, "w") == {}
    empty = local_rows(spark, {"measure": "STRING", "v": "DOUBLE"}, [])
    assert empty.count() == 0 and empty.dtypes == [("measure", "string"), ("v", "double")]
    some = local_rows(spark, {"m": "STRING", "v": "DOUBLE"}, [("it's", 0.1), ("b", float("inf")), ("c", None)])
    assert [tuple(r) for r in some.collect()] == [("it's", 0.1), ("b", math.inf), ("c", None)]

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from parcelwise.functions.numeric import exact_avg, exact_sum, money_sum


def one(spark, values, column):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
    return df.agg(column).first()[0]


def test_small_values_are_not_cut(spark):
    assert one(spark, [3e-7, 4e-7], exact_avg("x")) == 3.5e-7


def test_a_large_value_leaves_the_total_exact(spark):
    assert one(spark, [1e14, 0.1, 0.2, -1e14], exact_sum("x")) == pytest.approx(0.1 + 0.2, abs=1e-16)
    assert one(spark, [1e14, 2.25], money_sum("x")) == 100000000000002.25


def test_sums_equal_exact_fractions_in_any_order(spark):
    rng = random.Random(1)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-6, 9) for _ in range(2000)]
    exact = float(sum(Fraction(v) for v in values))
    for _ in range(2):
        rng.shuffle(values)
        assert one(spark, values, exact_sum("x")) == pytest.approx(exact, rel=1e-15)


def test_values_that_are_no_numbers_decide_the_sum(spark):
    assert one(spark, [1.0, float("inf")], exact_sum("x")) == float("inf")
    assert one(spark, [1.0, None], exact_sum("x")) == 1.0
    assert one(spark, [None], exact_sum("x")) is None
    assert one(spark, [None], exact_avg("x")) is None


@pytest.mark.parametrize("x", [1e-30, 1.2345678901234567e-12, 5e-324, 123456.00000012345, 1e14 + 0.3, -7.1e-25])
def test_the_sum_of_one_value_is_that_value(spark, x):
    assert one(spark, [x], exact_sum("x")) == x


def test_tiny_values_are_added(spark):
    assert one(spark, [1e-30, 3e-30], exact_avg("x")) == 2e-30
    assert one(spark, [1e14, 1e-30, -1e14], exact_sum("x")) == 1e-30
    assert one(spark, [1e-12, 1e-30], exact_sum("x")) == 1e-12 + 1e-30

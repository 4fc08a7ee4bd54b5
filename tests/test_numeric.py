from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesmarts.functions.numeric import (
    half_up_ratio,
    line_revenue_cents,
    percent,
    published,
    to_cents,
    total_cents,
)

LAX = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@pytest.mark.parametrize(
    "price, quantity, discount, cents",
    [
        (17.45, 1, 0.1, 1571),  # 15.705, half-up
        (18.0, 12, 0.0, 21600),
        (18.0, 12, 0.05, 20520),
        (19.0, 7, 0.2, 10640),
        (19.0, 7, 1.0, 0),
        (1.005, 1, 0.0, 101),  # rounded by its decimal text, not its binary value
        (0.01, 1, 0.5, 1),
        (17.45, -1, 0.1, -1571),
    ],
)
def test_line_revenue(spark, price, quantity, discount, cents):
    df = spark.createDataFrame([(price, quantity, discount)], "p double, q bigint, d double")
    ordinary, large = line_revenue_cents(to_cents(F.col("p")), F.col("q"), to_cents(F.col("d")))
    got = df.select(ordinary.alias("o"), large.alias("l")).first()
    assert got.l is None and got.o == cents


@pytest.mark.parametrize("price, quantity", [("1e10", 3), ("1e13", 7), ("9.99", 3 * 2**31), ("1e13", 2**33), ("-1e13", 2**33)])
def test_large_lines_are_exact(spark, price, quantity):
    df = spark.createDataFrame([(price, quantity, "0.15")], "p string, q bigint, d string")
    ordinary, large = line_revenue_cents(to_cents(F.col("p")), F.col("q"), to_cents(F.col("d")))
    got = df.select(ordinary.alias("o"), large.alias("l")).first()
    exact = Decimal(price) * quantity * 85
    want = int(exact.quantize(Decimal(1), ROUND_HALF_UP))
    assert got.o is None and got.l == want


def test_totals_take_ordinary_and_large_lines(spark):
    df = spark.createDataFrame([(1, "12.34", 2), (1, "1e13", 2**33), (2, "0.50", 1), (3, "x", 1)], "k int, p string, q bigint")
    parts = line_revenue_cents(to_cents(F.col("p")), F.col("q"), F.lit(0).cast("bigint"))
    rows = df.withColumns({"o": parts[0], "l": parts[1]}).groupBy("k").agg(total_cents(F.col("o"), F.col("l")).alias("t")).collect()
    assert {r.k: r.t for r in rows} == {1: 2468 + 10**15 * 2**33, 2: 50, 3: None}


@pytest.mark.parametrize("bad", ["", "abc", "NaN", "1e17", "99999999999999999.99"])
def test_to_cents_rejects(spark, bad):
    assert spark.createDataFrame([(bad,)], "p string").select(to_cents(F.col("p"))).first()[0] is None


@LAX
@given(st.lists(st.floats(-1e8, 1e8, allow_nan=False), min_size=1, max_size=200))
def test_to_cents_equals_decimal_text(spark, values):
    got = spark.createDataFrame([(v,) for v in values], "v double").select(to_cents(F.col("v")))
    want = [
        int(Decimal(repr(v)).quantize(Decimal("0.01"), ROUND_HALF_UP).scaleb(2)) for v in values
    ]
    assert [r[0] for r in got.collect()] == want


@LAX
@given(
    st.lists(
        st.tuples(st.integers(-(10**13), 10**13), st.integers(1, 10**7)), min_size=1, max_size=200
    )
)
def test_ratio_equals_exact_half_up(spark, pairs):
    df = spark.createDataFrame(
        [(Decimal(a).scaleb(-2), b) for a, b in pairs], "a decimal(18,2), b bigint"
    )
    got = df.select(half_up_ratio(F.col("a"), F.col("b"), 2)).collect()
    for (cents, n), row in zip(pairs, got):
        sign = -1 if cents < 0 else 1
        want = sign * ((2 * abs(cents) + n) // (2 * n))
        assert row[0] == Decimal(want).scaleb(-2)


def test_percent_of_zero_is_null(spark):
    assert spark.range(1).select(percent(F.lit(1), F.lit(0))).first()[0] is None
    assert spark.range(1).select(percent(F.lit(None).cast("int"), F.lit(3))).first()[0] is None


def test_published_turns_decimals_into_doubles(spark):
    df = spark.createDataFrame([(Decimal("1.10"), 3, "x")], "a decimal(18,2), b int, c string")
    assert [f.dataType.simpleString() for f in published(df).schema] == ["double", "int", "string"]
    assert tuple(published(df).first()) == (1.1, 3, "x")


@pytest.mark.parametrize("text", [
    "90071992547409.93", "900719925474099.31", "9007199254740993.01", "70368744177664.01", "17592186044416.995", "9999999999999.995",
    "9999999999999999.99", "-90071992547409.93", "12345678901234.565", "0.00499999999999999999999", "0.005", "1.005", "17.455",
])
def test_cents_are_exact_at_any_size(spark, text):
    want = int((Decimal(text) * 100).quantize(Decimal(1), "ROUND_HALF_UP"))
    df = spark.createDataFrame([(text, Decimal(text).quantize(Decimal("0.001"), "ROUND_HALF_UP"))], "t string, d decimal(22,3)")
    got = df.select(to_cents(F.col("t")).alias("t"), to_cents(F.col("d").cast("decimal(18,2)")).alias("d")).first()
    assert got.t == want
    assert got.d == int((Decimal(text).quantize(Decimal("0.001"), "ROUND_HALF_UP") * 100).quantize(Decimal(1), "ROUND_HALF_UP"))


def test_cents_of_doubles_are_those_of_their_digits(spark):
    rnd = random.Random(3)
    values = [rnd.randrange(10**k) / 100 for k in range(3, 17) for _ in range(40)] + [rnd.random() * 10**k for k in range(14) for _ in range(20)]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    got = [r.c for r in df.select(to_cents(F.col("x")).alias("c")).collect()]
    assert got == [int((Decimal(repr(x)) * 100).quantize(Decimal(1), "ROUND_HALF_UP")) for x in values]

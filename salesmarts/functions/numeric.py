"""Exact money arithmetic.

Amounts are whole cents in bigint while they are multiplied and summed, so a total does not
depend on the order in which partitions are added, and decimals in the tables. Integer sums
run in generated code without an object per row, which decimal sums of this width do not.
``published`` turns decimals into doubles, the type the marts are exchanged in.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRICE = "decimal(18,2)"
DISCOUNT = "decimal(18,2)"
AMOUNT = "decimal(38,2)"
CENTS = "decimal(38,0)"


def to_cents(c: Column, kind: str = PRICE) -> Column:
    """A number or numeric text in whole hundredths, half-up; null if not of ``kind``.

    Below 10^13 doubles lie less than half a hundredth apart, so a value whose double is the
    closest one to some number of hundredths is that number, rounded. Any other value, and any
    larger one, goes through its decimal digits, which alone round it right.
    """
    x = c.try_cast("double")
    nearest = F.rint(x * 100)
    whole_digits = int(kind.split("(")[1].split(",")[0]) - 2
    plain = (nearest / 100 == x) & (F.abs(x) < 10.0 ** min(13, whole_digits))
    return F.when(plain, nearest.cast("bigint")).otherwise((c.try_cast(kind) * 100).cast("bigint"))


def from_cents(c: Column, kind: str = AMOUNT) -> Column:
    return (c.cast("decimal(36,0)") * F.lit(Decimal("0.01"))).cast(kind)


def line_revenue_cents(price_cents: Column, quantity: Column, discount_cents: Column) -> tuple[Column, Column]:
    """unit_price x quantity x (1 - discount) in cents, rounded half away from zero.

    Two columns, one of them null: a bigint for ordinary lines, below 10^9 cents, and an exact
    decimal for all others. Both parts are summed apart (``total_cents``), so neither a large
    line nor many ordinary ones overflow, and ordinary ones are summed as integers. Beyond 38
    digits a line is null.
    """
    factor = F.lit(100) - discount_cents
    plain = (F.abs(price_cents) < 10**8) & (F.abs(quantity) < 10**5) & (F.abs(factor) <= 10**3)
    product = F.when(plain, price_cents) * F.when(plain, quantity) * F.when(plain, factor)
    cents = F.call_function("div", F.when(product < 0, product - 50).otherwise(product + 50), F.lit(100))
    ordinary = F.when(F.abs(cents) < 10**9, cents)
    exact = F.try_multiply(price_cents.cast("decimal(19,0)"), quantity.cast("decimal(19,0)"))
    whole = F.try_multiply(exact.try_cast("decimal(38,0)"), factor.try_cast("decimal(20,0)")).try_cast("decimal(38,0)")
    large = F.round(whole * F.lit(Decimal("0.01")), 0).try_cast(CENTS)
    return ordinary, F.when(ordinary.isNull(), large)


def total_cents(ordinary: Column, large: Column) -> Column:
    """The sum of both parts of ``line_revenue_cents``; null if every line is."""
    parts = F.sum(ordinary).cast(CENTS), F.sum(large).cast(CENTS)
    none = F.lit(0).cast(CENTS)
    return F.when(
        parts[0].isNotNull() | parts[1].isNotNull(), F.coalesce(parts[0], none) + F.coalesce(parts[1], none)
    ).cast(CENTS)


def half_up_ratio(part: Column, whole: Column, digits: int) -> Column:
    """part / whole rounded half away from zero to ``digits`` places, null on a zero whole.

    A rounded quotient would be rounded twice (once by the division). Integer division of
    (2 * part * 10^digits + whole) by 2 * whole rounds once.
    """
    exact = "decimal(32,2)"
    top = F.abs(part.cast(exact)) * F.lit(2 * 10**digits).cast("decimal(6,0)")
    base = F.abs(whole.cast(exact))
    units = F.call_function("div", top + base, F.nullif(base * 2, F.lit(0).cast(exact)))
    ratio = (units.cast("decimal(19,0)") * F.lit(Decimal(1).scaleb(-digits))).cast(
        f"decimal(22,{digits})"
    )
    return F.when((part < 0) != (whole < 0), -ratio).otherwise(ratio)


def percent(part: Column, whole: Column) -> Column:
    """part as a percentage of whole, to one place."""
    return half_up_ratio(part * 100, whole, 1)


def published(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles; all others untouched."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )

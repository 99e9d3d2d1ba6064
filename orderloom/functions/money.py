"""Totals of money.

Raw files give money as double. Adding doubles depends on the order in which
tasks finish, and adding decimals is slow: beyond 18 digits each addition goes
through big numbers. So a double is added up in whole ten-thousandths, and what is
left of it in whole ten-billionths; what even these leave is added as it is.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNIT_DECIMALS = 4
FINE_DECIMALS = 10

# Units are added in three parts of 21 bits, so that the sum of each stays within a
# long for 2 ** 42 rows. Doubles from here on have no place for four decimals.
_PART_BITS = 21
_LARGEST = 9e14

# A double is the nearest one of a decimal number, and a sum of two is off by an ulp
# or two; a rest below this share of the amount stands for nothing.
_NOISE = 2.0**-50


def exact_total(amount: Column) -> Column:
    """Sum of a double column as double: exact in its decimal digits up to the
    tenth, further ones added as doubles.

    NULLs are skipped and only NULLs give NULL. Values whose units are beyond a
    long (9e14 and more), infinity and NaN are added as doubles.
    """
    ordinary = F.abs(amount) < _LARGEST
    rounded = F.rint(amount * 10**UNIT_DECIMALS)
    units = F.when(ordinary, rounded.cast("long"))
    mask = F.lit((1 << _PART_BITS) - 1).cast("long")
    parts = [
        F.shiftright(units, 2 * _PART_BITS),
        F.shiftright(units, _PART_BITS).bitwiseAND(mask),
        units.bitwiseAND(mask),
    ]
    whole = None
    for part in parts:
        added = F.sum(part).cast("decimal(20,0)")
        whole = added if whole is None else (whole * F.lit(1 << _PART_BITS).cast("decimal(7,0)") + added).cast("decimal(32,0)")

    rest = F.when(ordinary, amount - rounded / 10**UNIT_DECIMALS)
    fine = F.rint(rest * 10**FINE_DECIMALS)
    left = rest - fine / 10**FINE_DECIMALS
    left = F.sum(F.when(F.abs(left) > F.abs(amount) * _NOISE, left))
    small = F.sum(F.when(F.abs(rest) > F.abs(amount) * _NOISE, fine).cast("long")).cast("decimal(20,0)")

    def scaled(number: Column, decimals: int) -> Column:
        return (number * F.lit(Decimal(1).scaleb(-decimals))).cast(f"decimal(36,{FINE_DECIMALS})")

    total_units = scaled(whole, UNIT_DECIMALS)
    exact = F.coalesce(total_units + scaled(small, FINE_DECIMALS), total_units).cast("double")
    exact = F.coalesce(exact + left, exact)
    beyond = F.sum(F.when(~ordinary, amount))
    return F.coalesce(exact + beyond, exact, beyond)


def total(df: DataFrame, amount: Column) -> Column:
    """Sum of a money expression over ``df``: exact for doubles, and as declared
    for decimals and integers, which Spark adds exactly."""
    kind = df.select(amount.alias("amount")).schema["amount"].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return exact_total(amount)
    return F.sum(amount)

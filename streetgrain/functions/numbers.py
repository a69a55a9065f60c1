"""Coordinate text: seven decimals, twelve significant digits, no padding.

The work is split in three small expressions (value, units, text), each in a
projection of its own; nested in one expression they would repeat each other
many times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetgrain.functions.text import parse_number, strip_zeros


def coordinate_units(value: Column) -> Column:
    """Whole 1e-7 units nearest to a double below 1e5, judged on its exact
    binary value; ties go to the even unit.

    The value is split exactly into ``m / 2**24 + n / 2**68``. As 10**7 =
    2**7 * 5**7 the product is ``m * 5**7 / 2**17 + n * 5**7 / 2**61``: whole
    units and a remainder in 61 bits, without rounding anything.
    """
    size = F.abs(value)
    m = F.floor(size * F.lit(float(2**24)))
    n = F.floor((size - m / F.lit(float(2**24))) * F.lit(float(2**68))).cast("bigint")
    high = m.cast("bigint") * 78125
    rest = F.shiftleft(high.bitwiseAND(F.lit(2**17 - 1)), 44) + n * 78125
    units = F.shiftright(high, 17) + F.shiftright(rest, 61)
    beyond = rest.bitwiseAND(F.lit(2**61 - 1)) - F.lit(2**60)
    up = (beyond > 0) | ((beyond == 0) & (units.bitwiseAND(F.lit(1)) == 1))
    return F.when(size < 1e5, units + F.when(up, F.lit(1)).otherwise(F.lit(0)))


def coordinate_text(text: Column, value: Column, units: Column) -> Column:
    """Canonical text; ``text`` itself where it is no number."""
    # The sign of zero survives: "-0.00" becomes "-0".
    negative = (value < 0) | ((value == 0) & text.rlike(r"^\s*-"))
    sign = F.when(negative, F.lit("-")).otherwise(F.lit(""))
    whole, part = F.floor(units / 10000000).cast("string"), units % 10000000
    digits = F.rtrim(F.lpad(part.cast("string"), 7, "0"), F.lit("0"))
    plain = F.when(part == 0, whole).otherwise(F.concat(whole, F.lit("."), digits))

    # Below 1e-4 the shortest form has an exponent.
    tail = units.cast("string")
    tiny = F.concat(
        strip_zeros(F.concat(F.left(tail, F.lit(1)), F.lit("."), F.substring(tail, 2, 9))),
        F.lit("e-0"),
        (F.lit(8) - F.length(tail)).cast("string"),
    )

    # From 1e5 on, twelve significant digits leave fewer than seven decimals.
    size = F.abs(value)
    decimal = size.cast("decimal(30,10)")
    long_form = F.coalesce(
        *[
            F.when(size < float(10 ** (12 - places)), F.round(decimal, places).cast("string"))
            for places in (6, 5, 4, 3, 2, 1, 0)
        ]
    )
    scientific = F.regexp_replace(F.format_string("%.11e", size), r"\.?0*e", "e")
    return (
        F.when(value.isNull(), text)
        .when(units.between(1, 999), F.concat(sign, tiny))
        .when(units.isNotNull(), F.concat(sign, plain))
        .when(F.isnan(value), F.lit("nan"))
        .when(size == float("inf"), F.concat(sign, F.lit("inf")))
        .when(size < 1e12, F.concat(sign, strip_zeros(long_form)))
        .otherwise(F.concat(sign, scientific))
    )


def round_coordinates(df: DataFrame, names: list[str]) -> DataFrame:
    """The named text columns rounded to seven decimals.

    Three projections: each reads finished values of the one before.
    """
    for name in names:
        df = df.withColumn(f"_{name}", parse_number(F.col(f"`{name}`")))
    for name in names:
        df = df.withColumn(f"_{name}_units", coordinate_units(F.col(f"`_{name}`")))
    made = {n: coordinate_text(F.col(f"`{n}`"), F.col(f"`_{n}`"), F.col(f"`_{n}_units`")) for n in names}
    return df.withColumns(made).drop(*[c for n in names for c in (f"_{n}", f"_{n}_units")])

"""Exact ratios and roundings.

Ratios are rounded half up on integers, so a result does not depend on how an
engine types ``100.0 * a / b``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _scaled(num: Column, den: Column, scale: int) -> Column:
    """round(scale * num / den), half away from zero, as a whole number."""
    num, den = num.cast("bigint"), den.cast("bigint")
    size = F.call_function("div", F.abs(num) * (2 * scale) + den, den * 2)
    return F.when(den > 0, F.when(num < 0, -size).otherwise(size))


def ratio(num: Column, den: Column, digits: int) -> Column:
    """num / den to ``digits`` places; NULL when den is 0."""
    return _scaled(num, den, 10**digits) / F.lit(float(10**digits))


def percent(num: Column, den: Column, digits: int) -> Column:
    return _scaled(num, den, 100 * 10**digits) / F.lit(float(10**digits))


def cents(value: Column) -> Column:
    """A two-digit decimal as whole hundredths."""
    return F.rint(value.cast("double") * 100).cast("bigint")


def to_numeric(value: Column) -> Column:
    """Unparsable text and NaN become NULL."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)

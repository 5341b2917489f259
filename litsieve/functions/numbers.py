"""Numbers, as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from litsieve.functions.text import as_column

# Splits a double into two halves whose products with a small number are exact.
_SPLIT = 2.0**27 + 1
# Doubles beyond have no decimals worth rounding.
_LARGEST = 2.0**40


def round_decimals(value: Column | str, digits: int) -> Column:
    """``value`` rounded as Python's ``round`` does: by the exact binary value, halves to even.

    Spark rounds the shortest decimal form instead: 0.5005 lies below its half and becomes
    0.5 here, 0.501 there.
    """
    value = as_column(value).cast("double")
    scale = F.lit(float(10**digits))
    product = value * scale
    # What rounding the product lost, exactly.
    head = value * _SPLIT - (value * _SPLIT - value)
    lost = (head * scale - product) + (value - head) * scale
    down = F.floor(product)
    rest = product - down - 0.5
    up = (rest > 0) | ((rest == 0) & ((lost > 0) | ((lost == 0) & (down % 2 != 0))))
    return F.when(F.abs(value) < _LARGEST, (down + F.when(up, 1).otherwise(0)) / scale).otherwise(value)

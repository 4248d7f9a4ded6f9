"""Money and logarithm expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(value: Column) -> Column:
    """Exact two-digit decimal, so that sums do not depend on the order of addition."""
    return value.cast("decimal(12,2)")


def disc_price(price: Column, discount: Column) -> Column:
    """Price after discount."""
    return money(price) * (F.lit(1).cast("decimal(4,2)") - discount.cast("decimal(4,2)"))


def charge(price: Column, discount: Column, tax: Column) -> Column:
    """Price after discount and tax."""
    return disc_price(price, discount) * (F.lit(1).cast("decimal(4,2)") + tax.cast("decimal(4,2)"))


def log_sum(left: Column, right: Column) -> Column:
    """Log of the sum of two numbers given as logs; minus infinity stands for zero."""
    high, low = F.greatest(left, right), F.least(left, right)
    return F.when(low == float("-inf"), high).otherwise(high + F.log1p(F.exp(low - high)))

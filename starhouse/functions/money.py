"""Decimal money columns. Amounts are cast to decimal before any arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 2)
PCT = DecimalType(5, 2)


def to_money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


def to_pct(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(PCT)


def net_amount(unit_price: Column, quantity: Column, discount_pct: Column) -> Column:
    """``unit_price * quantity * (1 - discount_pct / 100)`` on decimals, HALF_UP to cents.

    A null discount gives a null amount.
    """
    return (unit_price * quantity * (F.lit(1) - discount_pct / F.lit(100))).cast(MONEY)

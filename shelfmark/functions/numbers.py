"""Lenient number reading, shared by every attribute normaliser."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def leading_number(text: Column) -> Column:
    """DECIMAL(18,2) at the start of ``text``; whatever follows is ignored.

    NULL when the text does not start with a number (after spaces).
    """
    prefix = F.regexp_extract(text, r"^\s*([+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+))", 1)
    return prefix.try_cast(MONEY)


def comma_as_dot(text: Column) -> Column:
    return F.translate(text, ",", ".")

"""Numeric helpers whose results agree across engines."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def rounded(x: Column, digits: int) -> Column:
    """Rounds half to even in binary, as array libraries do: the scaled value is rounded to the nearest integer."""
    return F.rint(x * 10.0**digits) / 10.0**digits

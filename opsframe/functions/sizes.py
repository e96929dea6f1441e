"""Sizes in bytes and what is requested for them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def disk_request(size: Column) -> Column:
    """Whole GiB, rounded up, as text such as ``3.0G``."""
    gib = F.ceil(size / F.lit(float(1024**3))).cast("long")
    return F.concat(gib.cast("string"), F.lit(".0G"))


def size_tb(size: Column) -> Column:
    """Bytes as TiB."""
    return size / F.lit(float(1024**4))


def int_div(numerator: Column, denominator: Column) -> Column:
    """Whole-number division of longs, without a detour through doubles."""
    return F.call_function("div", numerator, denominator)


def chunk_count(size: Column, chunk: int) -> Column:
    """Number of parts of ``chunk`` bytes that cover ``size`` bytes."""
    return int_div(size.cast("long") + F.lit(chunk - 1), F.lit(chunk))

"""Column helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once: an aggregate over nothing, which starts and finishes with it."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda kept, _: kept, use)

"""All registered queries and their SQL."""

from opsframe.plans import (  # noqa: F401
    cost_queries,
    fleet_queries,
    key_queries,
    manifest_queries,
    object_queries,
    record_queries,
    stream_queries,
)
from opsframe.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""Acceptance queries over the test tables; importing this package registers them all."""

from emberscope.acceptance import (  # noqa: F401
    log_queries,
    metric_queries,
    sql_queries,
    storage_queries,
    stream_queries,
    trace_queries,
)
from emberscope.acceptance.registry import REGISTRY

__all__ = ["REGISTRY"]

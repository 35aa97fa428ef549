"""The operators bound to the test tables, with their SQL counterparts."""

from tallymark.bindings import (  # noqa: F401
    aggregates, expressions, filters, joins, learning, quality, ranking, storage, streams,
)
from tallymark.bindings.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

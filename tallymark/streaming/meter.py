"""Streaming usage meter.

Every event counts, however late it comes: a batch is reduced to its sums per day and
session, which are added up on reading. There is no state and no watermark to drop rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallymark.functions.exprs import utc_day
from tallymark.streaming import batches

KEYS = ["day", "session_id"]


def usage_totals(events: DataFrame) -> DataFrame:
    """Tokens and cost per UTC day and session of a batch."""
    return events.groupBy(utc_day("ts").alias("day"), "session_id").agg(
        F.sum("tokens").alias("tokens"), F.sum("cost_usd").alias("cost_usd")
    )


def add_totals(totals: DataFrame) -> DataFrame:
    """The totals of several batches added up."""
    return totals.groupBy(*KEYS).agg(F.sum("tokens").alias("tokens"), F.sum("cost_usd").alias("cost_usd"))


def start_meter(
    events: DataFrame, target: str, checkpoint: str, merge_every: int = batches.MERGE_EVERY
) -> StreamingQuery:
    """Meter a stream with columns ``ts, session_id, tokens, cost_usd``."""
    return batches.store(events, usage_totals, add_totals, target, checkpoint, merge_every)


def read_meter(spark: SparkSession, target: str) -> DataFrame:
    """Totals per day and session."""
    return batches.read(spark, target, add_totals)

"""Usage ledger: merging, status, and the audit of admission decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.plans.scan import CHUNK, SEQ, ordered_chunks


def merge_usage(ledger: DataFrame) -> DataFrame:
    """One row per day and session; duplicates are added up."""
    return ledger.groupBy("day", "session_id").agg(
        F.sum("tokens").alias("tokens"), F.sum("cost_usd").alias("cost_usd")
    )


def usage_status(ledger: DataFrame, session_id, day: str | None = None) -> DataFrame:
    """Per day: total cost, number of sessions, and the tokens of one session."""
    rows = ledger if day is None else ledger.where(F.col("day") == day)
    mine = F.col("session_id") == F.lit(session_id)
    return rows.groupBy("day").agg(
        F.sum("cost_usd").alias("total_cost_usd"),
        F.count_distinct("session_id").alias("session_count"),
        F.coalesce(F.sum(F.when(mine, F.col("tokens"))), F.lit(0)).alias("session_tokens"),
        (F.count_if(mine) > 0).alias("session_exists"),
    )


def usage_admission(
    log: DataFrame, daily_budget_usd, session_token_cap, max_sessions_per_day
) -> DataFrame:
    """Replay a usage log and give the decision for every ``authorize`` row.

    ``log`` has event_id, ts, day, session_id, kind (authorize or record), tokens and
    cost_usd, ordered by (ts, event_id). Costs must not be negative: a spent budget
    then stays spent, and so does a full house. So a session counts as registered
    from its first row on if fewer than the maximum came before it, or from its first
    record. Give costs as decimals for exact comparison.

    The rows are cut into chunks of their order and written once. Sums per day, session and chunk say what each chunk
    starts with; these go in front of the rows of their chunk, and one sort of a chunk then gives
    all running totals. So neither a busy day nor a busy session lands in one task.
    """
    record = F.coalesce(F.col("kind") == "record", F.lit(False))
    rows = ordered_chunks(log, ["day"], ["ts", "event_id"]).select(
        "event_id", "ts", "day", "session_id", "kind", SEQ, CHUNK,
        F.struct("day").alias("_day"), F.struct("session_id").alias("_session"),  # null parts match each other
        F.when(record, F.col("tokens")).alias("_tokens"), F.when(record, F.col("cost_usd")).alias("_cost"),
        record.cast("long").alias("_records"),
    )
    sessions, chunks = _openings(rows, max_sessions_per_day)
    rows = rows.unionByName(sessions, allowMissingColumns=True).unionByName(chunks, allowMissingColumns=True)
    here, mine = Window.partitionBy("_day", CHUNK), Window.partitionBy("_day", CHUNK, "_session")

    def before(value: str, of) -> Column:
        return F.coalesce(F.sum(value).over(of.orderBy(SEQ).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    rows = rows.withColumns({
        "_arrival": F.max("_arrival").over(mine), "_fits": F.max("_fits").over(mine),
        "tokens_before": before("_tokens", mine), "records_before": before("_records", mine),
    })
    rows = rows.withColumn("_came", F.coalesce("_came", (F.col(SEQ) == F.col("_arrival")).cast("long")))
    rows = rows.withColumns({"cost_before": before("_cost", here), "sessions_before": before("_came", here)})

    registered = (F.col("_fits") & (F.col(SEQ) > F.col("_arrival"))) | (F.col("records_before") > 0)
    full = F.col("sessions_before") >= F.lit(max_sessions_per_day)
    reason = (
        F.when(F.col("cost_before") >= F.lit(daily_budget_usd), F.lit("budget"))
        .when(registered & (F.col("tokens_before") >= F.lit(session_token_cap)), F.lit("session_tokens"))
        .when(~registered & full, F.lit("max_sessions"))
    )
    decided = rows.where(F.col("kind") == "authorize").withColumn("reason", reason)
    return decided.select(
        "event_id", "ts", "day", "session_id",
        F.col("reason").isNull().alias("allowed"), "reason",
        "cost_before", "tokens_before",
    )


def _openings(rows: DataFrame, max_sessions: int) -> tuple[DataFrame, DataFrame]:
    """Rows that stand before all others of a chunk: what each of its sessions, and what the day, brings along.

    A session brings its tokens and records of earlier chunks, its first row (``_arrival``) and whether it fitted in
    (``_fits``); the day brings its cost and the number of sessions that came before. Made of sums per session and chunk only.
    """
    of_session = Window.partitionBy("_day", "_session")
    earlier = Window.unboundedPreceding, -1
    sums = rows.groupBy("_day", "_session", CHUNK).agg(
        F.sum("_tokens").alias("_t"), F.sum("_records").alias("_r"), F.sum("_cost").alias("_c"), F.min(SEQ).alias("_first")
    )
    sums = sums.withColumns({
        "_tokens": F.sum("_t").over(of_session.orderBy(CHUNK).rowsBetween(*earlier)),
        "_records": F.sum("_r").over(of_session.orderBy(CHUNK).rowsBetween(*earlier)),
        "_arrival": F.min("_first").over(of_session),
    })
    arrives = F.col("_first") == F.col("_arrival")
    of_day = Window.partitionBy("_day").orderBy(CHUNK).rowsBetween(*earlier)
    chunks = sums.groupBy("_day", CHUNK).agg(F.sum("_c").alias("_c"), F.count_if(arrives).alias("_a")).select(
        "_day", CHUNK, F.sum("_c").over(of_day).alias("_cost"), F.coalesce(F.sum("_a").over(of_day), F.lit(0)).alias("_came"),
        F.lit(-1).cast("long").alias(SEQ),
    )
    nth = F.row_number().over(Window.partitionBy("_day", CHUNK, arrives).orderBy("_first"))
    placed = sums.join(chunks.select("_day", CHUNK, "_came"), ["_day", CHUNK])
    placed = placed.withColumn("_nth", nth).withColumn("_fit", arrives & (F.col("_came") + F.col("_nth") <= F.lit(max_sessions)))
    sessions = placed.select(
        "_day", "_session", CHUNK, "_tokens", "_records", "_arrival", F.max("_fit").over(of_session).alias("_fits"),
        F.lit(-1).cast("long").alias(SEQ),
    )
    return sessions, chunks

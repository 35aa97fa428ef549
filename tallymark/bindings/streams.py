"""Queries that run a stream over the tables to its end and return what it stored."""

from pyspark.sql import functions as F

from tallymark.bindings.joins import _r
from tallymark.bindings.registry import register, rounded
from tallymark.bindings.storage import land_pages
from tallymark.plans.lineage import scratch_path
from tallymark.sources.readers import json_pages
from tallymark.streaming import ingest, live, meter


def _landed(df, label, files):
    """Rows landed as files in an order that is not that of their time."""
    path = scratch_path(df.sparkSession, label)
    df.repartition(files, F.xxhash64(*df.columns)).write.parquet(path)
    return path


def _twice_landed(t):
    """The pages as a stream; a part of them lands a second time, as after a broken run."""
    pages = land_pages(t)
    schema = "value string, endpoint string, year int"
    again = t.spark.read.schema(schema).text(pages).where(F.xxhash64("value") % 3 == 0)
    again.write.mode("append").partitionBy("endpoint", "year").text(pages)
    return json_pages(ingest.landed_stream(t.spark, pages, schema, "text", files_per_batch=10))


def _ingested(t):
    target = scratch_path(t.spark, "ingested")
    ingest.ingest_stream(_twice_landed(t), target, scratch_path(t.spark, "cp")).awaitTermination()
    return t.spark.read.parquet(target)


def _ingested_by_state(t):
    target = scratch_path(t.spark, "ingested")
    ingest.ingest_by_state(_twice_landed(t), target, scratch_path(t.spark, "cp")).awaitTermination()
    return ingest.read_ingested(t.spark, target)


INGESTED_SQL = "SELECT DISTINCT endpoint, year, data_json, sha256(endpoint || '_' || year || '_' || data_json) AS data_hash FROM <raw>"
register("st_ingest_dedup", _ingested, INGESTED_SQL)
register("st_ingest_state", _ingested_by_state, INGESTED_SQL)


def _metered(t):
    events = t("events").select(
        F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("session_id"),
        F.floor(F.col("value") * 10).alias("tokens"), (F.floor(F.col("value") * 10) * 3e-6).alias("cost_usd"))
    stream = ingest.landed_stream(t.spark, _landed(events, "usage", 5), events.schema, files_per_batch=2)
    target = scratch_path(t.spark, "meter")
    meter.start_meter(stream, target, scratch_path(t.spark, "cp"), merge_every=2).awaitTermination()
    return rounded(meter.read_meter(t.spark, target), 6)


register(
    "st_usage_meter", _metered,
    """SELECT day, session_id, CAST(sum(tokens) AS BIGINT) AS tokens, round(sum(tokens * 3e-6), 6) AS cost_usd FROM <usage_log> GROUP BY 1, 2""",
)


def _live(t):
    rows = t("customer").select(
        F.col("c_mktsegment").alias("state"), F.when(F.col("c_custkey") % 11 != 0, F.col("c_acctbal")).alias("math"),
        (F.col("c_custkey") * 7 % 90 / 8).alias("income"))
    stream = ingest.landed_stream(t.spark, _landed(rows, "schools", 5), rows.schema, files_per_batch=2)
    target = scratch_path(t.spark, "live")
    live.live_stats(stream, ["state"], "income", "math", target, scratch_path(t.spark, "cp"), merge_every=2).awaitTermination()
    return live.read_live(t.spark, target, ["state"])


register(
    "st_live_stats", _live,
    f"""WITH c AS (SELECT c_mktsegment AS state, CASE WHEN c_custkey % 11 <> 0 THEN c_acctbal END AS math, c_custkey * 7 % 90 / 8 AS income FROM <customer>)
        SELECT state, round(avg(math), 2) AS avg_math_pct_prof, round(avg(income) FILTER (math IS NOT NULL), 2) AS avg_pct_high_income,
               {_r('income', 'math')} AS pearson_r, count(math) AS school_count FROM c GROUP BY 1""",
)

"""Queries for readers and writers. Written tables go to the shared folder and are read back."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from tallymark.bindings.joins import over_districts, schools, stats_sql
from tallymark.bindings.ranking import LAYERS_SQL, layer_tables
from tallymark.bindings.registry import TABLES, register, rounded
from tallymark.operators import marts
from tallymark.plans.lineage import scratch_path, settle
from tallymark.sources import readers as R
from tallymark.sources import writers as W

register(
    "src_table",
    lambda t: R.table(t.spark, t.path("lineitem"), ["l_orderkey", "l_linenumber", "l_quantity"], F.col("l_quantity") > 45),
    "SELECT l_orderkey, l_linenumber, l_quantity FROM <lineitem> WHERE l_quantity > 45",
)
register(
    "src_page", lambda t: R.page(t("orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", 100, 250),
    "SELECT o_orderkey, o_orderstatus FROM <orders> ORDER BY o_orderkey LIMIT 100 OFFSET 250",
)


def _views(t):
    a = R.assessments_view(t("scores_text")).select(F.lit("assessments").alias("view"), "year", F.col("math_prof_low").alias("a"), F.col("read_valid").alias("b"))
    d = R.directory_view(t("directory")).select(F.lit("directory").alias("view"), "year", F.col("enrollment").alias("a"), F.col("teachers_fte").alias("b"))
    c = R.census_view(t("census")).select(F.lit("census").alias("view"), "year", F.col("total_pop").alias("a"), F.col("hhi_220k_plus").alias("b"))
    places = t("points").select(
        (F.col("point_id") % 997).cast("string").alias("zip"), F.lit("s").alias("state"), F.lit("1").alias("state_fips"),
        F.lit("1").alias("county_fips"), F.when(F.col("point_id") % 5 != 0, F.col("latitude")).alias("latitude"), "longitude")
    p = R.locations_view(places).select(
        F.lit("locations").alias("view"), F.lit(None).cast("int").alias("year"), F.col("latitude").alias("a"), F.col("longitude").alias("b"))
    out = a.unionByName(d).unionByName(c).unionByName(p)
    return rounded(out.groupBy("view", "year").agg(
        F.count(F.lit(1)).alias("n"), F.count("a").alias("n_a"), F.avg("a").alias("avg_a"), F.avg("b").alias("avg_b")))


register(
    "src_projection_views", _views,
    """WITH v AS (
         SELECT 'assessments' AS view, CAST(year_json AS INT) AS year, try_cast(math_test_pct_prof_low AS DOUBLE) AS a, try_cast(read_test_num_valid AS DOUBLE) AS b
           FROM <scores_text> WHERE year_json IS NOT NULL
         UNION ALL SELECT 'directory', CAST(year_json AS INT), try_cast(enrollment AS DOUBLE), try_cast(teachers_fte AS DOUBLE) FROM <directory> WHERE year_json IS NOT NULL
         UNION ALL SELECT 'census', year, CAST(total_pop AS DOUBLE), CAST(hhi_220k_plus AS DOUBLE) FROM <census> WHERE total_pop > 0
         UNION ALL SELECT 'locations', NULL, latitude, longitude FROM <points> WHERE point_id % 5 <> 0)
       SELECT view, year, count(*) AS n, count(a) AS n_a, round(avg(a), 4) AS avg_a, round(avg(b), 4) AS avg_b FROM v GROUP BY 1, 2""",
)


def land_pages(t, per_page: int = 50):
    """Raw records written as API pages: one JSON page per line, a folder per endpoint and year."""
    pages = (
        t("raw").withColumn("_page", F.floor(F.col("event_id") / per_page))
        .groupBy("endpoint", "year", "_page")  # a page holds at most per_page records
        .agg(F.array_join(F.collect_list("data_json"), ",").alias("_records"))
        .select("endpoint", "year", F.concat(F.lit('{"results":['), "_records", F.lit('],"next":null}')).alias("value"))
    )
    path = scratch_path(t.spark, "pages")
    pages.write.partitionBy("endpoint", "year").text(path)
    return path


def _pages(t):
    return R.json_pages(R.landed_pages(t.spark, land_pages(t)))


register(
    "src_json_pages", _pages,
    "SELECT endpoint, year, data_json, sha256(endpoint || '_' || year || '_' || data_json) AS data_hash FROM <raw>",
)
register(
    "src_coded_wide", lambda t: R.coded_wide(t("census_coded"), "label", 2021),
    """SELECT CAST(coalesce(B01003_001E, 0) AS INT) AS total_pop, CAST(coalesce(B19001_016E, 0) AS INT) AS hhi_150k_200k,
              CAST(coalesce(B19001_017E, 0) AS INT) AS hhi_220k_plus, regexp_extract(label, '(\\d{5,})', 1) AS zip_code, 2021 AS year,
              'census_api' AS data_source FROM <census_coded>""",
)


def _csv(t):
    path = W.export(t("supplier"), scratch_path(t.spark, "csv"), "supplier", "csv")
    return R.csv(t.spark, path, "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE")


register("src_csv", _csv, "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM <supplier>")


def _appended(t):
    path = scratch_path(t.spark, "append")
    rows = t("orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    W.append(rows.where("year <= 1998"), path)
    W.append(rows.where("year > 1998"), path)
    return t.spark.read.parquet(path)


register("snk_append", _appended, "SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year FROM <orders>")


def _replaced(t):
    path = scratch_path(t.spark, "replace")
    rows = t("orders").select("o_orderkey", "o_orderstatus")
    W.replace(rows, path, ["o_orderstatus"])
    W.replace(rows.where("o_orderstatus = 'F'"), path, ["o_orderstatus"])
    return t.spark.read.parquet(path)


register("snk_replace", _replaced, "SELECT o_orderkey, o_orderstatus FROM <orders> WHERE o_orderstatus = 'F'")


def _hashed(t):
    year = F.when(F.col("event_id") % 7 != 0, F.col("event_id") % 3 + 2020).cast("int")
    return t("events").select(
        F.col("event_type").alias("endpoint"), year.alias("year"), "props",
        F.sha2(F.concat_ws("_", "event_type", F.coalesce(year.cast("string"), F.lit("none")), "props"), 256).alias("data_hash"))


HASHED_SQL = """SELECT DISTINCT event_type AS endpoint, year, props,
    sha256(event_type || '_' || coalesce(CAST(year AS VARCHAR), 'none') || '_' || props) AS data_hash
    FROM (SELECT *, CAST(CASE WHEN event_id % 7 <> 0 THEN 2020 + event_id % 3 END AS INT) AS year FROM <events>)"""


def _inserted(t):
    path = scratch_path(t.spark, "insert")
    rows = _hashed(t)
    W.insert_if_absent(rows.where("year < 2022 OR year IS NULL"), path, buckets=4)
    for _ in range(2):
        W.insert_if_absent(rows, path, buckets=4)
    return t.spark.read.parquet(path).drop(W.BUCKET)


register("snk_insert_if_absent", _inserted, HASHED_SQL)


def _ndjson(t):
    path = scratch_path(t.spark, "ndjson")
    stats = marts.county_stats(schools(t), 8)
    W.ndjson(stats, path)
    return t.spark.read.schema(stats.schema).json(path)


register("snk_ndjson", _ndjson, over_districts(stats_sql(["state", "county_fips"], "state <> '' AND county_fips <> ''", 8)))


def _exported(t):
    rows = t("customer").select("c_custkey", "c_name", "c_acctbal")
    at = datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
    folder = scratch_path(t.spark, "export")
    as_json = t.spark.read.schema(rows.schema).json(W.export(rows, folder, "customer", "json", at))
    as_parquet = t.spark.read.parquet(W.export(rows, folder, "customer", "parquet", at))
    return as_json.withColumn("fmt", F.lit("json")).unionByName(as_parquet.withColumn("fmt", F.lit("parquet")))


register(
    "snk_export", _exported,
    """SELECT c_custkey, c_name, c_acctbal, 'json' AS fmt FROM <customer> UNION ALL SELECT c_custkey, c_name, c_acctbal, 'parquet' FROM <customer>""",
)


def _geodata(t):
    path = scratch_path(t.spark, "geodata")
    W.geodata(layer_tables(t), path)
    return t.spark.read.parquet(path)


register("snk_geodata", _geodata, LAYERS_SQL)


def _ingest_stats(t):
    path = scratch_path(t.spark, "stats")
    rows = _hashed(t)
    W.insert_if_absent(rows.where("year = 2020"), path)
    before = settle(W.stored_counts(t.spark.read.parquet(path)), "before")
    W.insert_if_absent(rows, path)
    return W.ingest_stats(rows, before, W.stored_counts(t.spark.read.parquet(path)), ["refund", "click"])


register(
    "snk_ingest_stats", _ingest_stats,
    f"""WITH u AS ({HASHED_SQL}), e AS (SELECT DISTINCT event_type AS endpoint FROM <events> UNION SELECT 'refund' UNION SELECT 'click'),
          s AS (SELECT endpoint, (SELECT count(*) FROM <events> WHERE event_type = endpoint) AS n_seen,
                       (SELECT count(*) FROM u WHERE u.endpoint = e.endpoint AND year IS DISTINCT FROM 2020) AS n_inserted FROM e)
        SELECT endpoint, CAST(sum(n_seen) AS BIGINT) AS n_seen, CAST(sum(n_inserted) AS BIGINT) AS n_inserted,
               count(*) FILTER (n_inserted > 0) AS n_tables
        FROM s GROUP BY GROUPING SETS ((endpoint), ())""",
)


def _copied(t):
    spark = t.spark
    tag = scratch_path(spark, "db").rsplit("-", 1)[1][:12]
    source, target = f"src_{tag}", f"dst_{tag}"
    for db in (source, target):
        spark.sql(f"CREATE DATABASE `{db}` LOCATION '{scratch_path(spark, db)}'")
    for name in TABLES:
        writer = t(name).write
        (writer.partitionBy("o_orderstatus") if name == "orders" else writer).saveAsTable(f"`{source}`.`{name}`")
    copied = W.copy_schema(spark, source, target)
    layout = [c.name for c in spark.catalog.listColumns(f"`{target}`.`orders`") if c.isPartition]
    return copied.withColumn("layout", F.when(F.col("table_name") == "orders", F.lit("|".join(layout))))


register(
    "snk_copy_schema", _copied,
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS n_source, count(*) AS n_target, true AS same, "
        f"{chr(39) + 'o_orderstatus' + chr(39) if n == 'orders' else 'NULL'} AS layout FROM <{n}>" for n in TABLES),
)

"""Queries for reshaping, windows, top-k and set operations."""

from pyspark.sql import functions as F

from tallymark.bindings.expressions import TOTALS_SQL, _totals
from tallymark.bindings.registry import register, rounded
from tallymark.operators import aggregates as A
from tallymark.operators import reshape, sets, topk, usage, windows

RACES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _yearly(t):
    return A.mean_sum_by(t("scores"), ["year", "race"], {"proficiency": "math_prof_mid"})


register(
    "rsh_pivot", lambda t: rounded(reshape.pivot(_yearly(t), "year", "race", "proficiency", RACES)),
    "SELECT year, " + ", ".join(f"""round(avg(math_prof_mid) FILTER (race = '{r}'), 4) AS "{r}" """ for r in RACES)
    + " FROM <scores> WHERE race IS NOT NULL GROUP BY 1",
)
_LABELS = {"math_prof_high": "High Proficiency", "math_prof_mid": "Mid Proficiency", "math_prof_low": "Low Proficiency"}
register(
    "rsh_melt",
    lambda t: rounded(reshape.melt(
        t("scores").select("l_orderkey", "l_linenumber", "sex", *_LABELS), ["l_orderkey", "l_linenumber", "sex"],
        list(_LABELS), "score_level", "proficiency", _LABELS)),
    " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, sex, '{n}' AS score_level, round({c}, 4) AS proficiency FROM <scores>" for c, n in _LABELS.items()),
)
register(
    "win_distinct_on",
    lambda t: windows.distinct_on(t("directory").withColumn("sn", F.upper("school_name")), ["sn"],
                                  [F.desc_nulls_first("year_json"), F.asc("ncessch")]).select("sn", "ncessch", "year_json"),
    """SELECT sn, ncessch, year_json FROM (SELECT upper(school_name) AS sn, ncessch, year_json,
         row_number() OVER (PARTITION BY upper(school_name) ORDER BY year_json DESC NULLS FIRST, ncessch) AS rn FROM <directory>) WHERE rn = 1""",
)
register(
    "win_yoy_diff", lambda t: rounded(windows.yoy_diff(t("scores"), "year", "race", "math_prof_mid", RACES)),
    f"""WITH a AS (SELECT year, race, avg(math_prof_mid) AS v FROM <scores> GROUP BY 1, 2),
             y AS (SELECT DISTINCT year FROM <scores>), n AS (SELECT unnest({RACES}) AS race),
             g AS (SELECT y.year, n.race, v FROM y CROSS JOIN n LEFT JOIN a ON a.year = y.year AND a.race = n.race)
        SELECT year, race, round(v - lag(v) OVER (PARTITION BY race ORDER BY year), 4) AS change FROM g""",
)
register(
    "win_latest_wins",
    lambda t: windows.latest_wins(t("orders"), ["o_custkey"], "o_orderdate", ["o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice"),
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
         ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM <orders>) WHERE rn = 1""",
)
register(
    "win_top_bottom_n",
    lambda t: windows.top_bottom(t("customer"), ["c_nationkey"], "c_acctbal", "c_name").select(
        "c_nationkey", "c_name", "c_acctbal", "rank", "side"),
    """WITH k AS (SELECT c_nationkey, c_name, c_acctbal, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_name) AS hi,
                     row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_name DESC) AS lo FROM <customer>)
       SELECT c_nationkey, c_name, c_acctbal, CAST(hi AS INT) AS rank, 'top' AS side FROM k WHERE hi <= 3
       UNION ALL SELECT c_nationkey, c_name, c_acctbal, CAST(lo AS INT), 'bottom' FROM k WHERE lo <= 3""",
)
register(
    "win_dupe_rank",
    lambda t: windows.dupe_rank(t("orders").select("o_custkey", "o_orderdate", "o_orderkey"), ["o_custkey"],
                                [F.desc("o_orderdate"), F.asc("o_orderkey")]),
    """SELECT o_custkey, o_orderdate, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS dupe_rank FROM <orders>""",
)
register(
    "win_schools_in_zip",
    lambda t: windows.count_in(t("directory").select("ncessch", "zip_location"), ["zip_location"], "schools_in_zip", ["ncessch"]),
    "SELECT ncessch, zip_location, count(*) OVER (PARTITION BY zip_location) AS schools_in_zip FROM <directory>",
)
BUDGET, TOKEN_CAP, MAX_SESSIONS = 0.35, 3000, 60
register(
    "win_usage_admission",
    lambda t: rounded(
        usage.usage_admission(t("usage_log"), BUDGET, TOKEN_CAP, MAX_SESSIONS)
        .withColumn("cost_before", F.col("cost_before").cast("double")), 6),
    f"""WITH a AS (SELECT *, coalesce(sum(CASE WHEN kind = 'record' THEN tokens END) OVER s, 0) AS tokens_before,
                 coalesce(sum(CASE WHEN kind = 'record' THEN 1 END) OVER s, 0) AS records_before,
                 coalesce(sum(CASE WHEN kind = 'record' THEN cost_usd END) OVER d, 0) AS cost_before,
                 row_number() OVER (PARTITION BY day, session_id ORDER BY ts, event_id) AS nth FROM <usage_log>
               WINDOW s AS (PARTITION BY day, session_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                      d AS (PARTITION BY day ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
          b AS (SELECT *, coalesce(sum(CASE WHEN nth = 1 THEN 1 END) OVER (PARTITION BY day ORDER BY ts, event_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sessions_before FROM a),
          c AS (SELECT *, nth > 1 AND first_value(sessions_before) OVER (PARTITION BY day, session_id ORDER BY ts, event_id) < {MAX_SESSIONS}
                  OR records_before > 0 AS registered FROM b),
          r AS (SELECT *, CASE WHEN cost_before >= {BUDGET} THEN 'budget' WHEN registered AND tokens_before >= {TOKEN_CAP} THEN 'session_tokens'
                  WHEN NOT registered AND sessions_before >= {MAX_SESSIONS} THEN 'max_sessions' END AS reason FROM c WHERE kind = 'authorize')
        SELECT event_id, ts, day, session_id, reason IS NULL AS allowed, reason, round(CAST(cost_before AS DOUBLE), 6) AS cost_before,
               CAST(tokens_before AS BIGINT) AS tokens_before FROM r""",
)
register(
    "top_n",
    lambda t: topk.top_n(_totals(t("census")), "white_total", 10, "zip_code", ["zip_code", "total_pop", "white_total"]),
    f"SELECT zip_code, total_pop, white_total FROM ({TOTALS_SQL}) ORDER BY white_total DESC, zip_code LIMIT 10",
)
register(
    "top_tail_sorted",
    lambda t: topk.top_tail(A.count_by(t("directory").where("state_location <> ''"), ["state_location"], "n_schools"), "n_schools", 15, "state_location"),
    """SELECT * FROM (SELECT state_location, count(*) AS n_schools FROM <directory> WHERE state_location <> '' GROUP BY 1
       ORDER BY n_schools DESC, state_location LIMIT 15) ORDER BY n_schools, state_location DESC""",
)
register(
    "srt_nulls_last",
    lambda t: rounded(topk.sort_nulls_last(t("golden").select("school_id", "math_high_pct"), "math_high_pct", "desc", "school_id")),
    "SELECT school_id, round(math_high_pct, 4) AS math_high_pct FROM <golden> ORDER BY 2 DESC NULLS LAST, 1",
)
register(
    "lim_recent", lambda t: topk.recent(t("events").select("event_id", "event_type"), "event_id", 100),
    "SELECT event_id, event_type FROM <events> ORDER BY event_id DESC LIMIT 100",
)
register(
    "smp_seeded", lambda t: topk.sample_n(t("orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 1000),
    "SELECT o_orderkey, o_totalprice FROM <orders> ORDER BY md5(o_orderkey || '-42'), o_orderkey LIMIT 1000",
)
register(
    "lim_context", lambda t: topk.first_n(t("golden").select("school_id", "school_name"), ["school_id"], 400),
    "SELECT school_id, school_name FROM <golden> ORDER BY school_id LIMIT 400",
)


def _years(t):
    rows = t("orders").select("o_orderkey", F.year("o_orderdate").alias("year"), "o_totalprice")
    return sets.union_all([
        rows.where("year <= 1997").drop("o_totalprice"), rows.where("year BETWEEN 1998 AND 1999"), rows.where("year > 1999"),
    ])


register(
    "set_union_years", _years,
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CASE WHEN year(o_orderdate) > 1997 THEN o_totalprice END AS o_totalprice FROM <orders>""",
)


def layer_tables(t):
    return {"zcta": t("zip_shapes"), "county": t("county_shapes"), "state": t("state_shapes")}


LAYERS_SQL = """SELECT 'zcta' AS layer_type, geoid, geoid AS name, NULL AS state_fips, NULL AS county_fips, geometry FROM <zip_shapes>
    UNION ALL SELECT 'county', geoid, name, state_fips, county_fips, geometry FROM <county_shapes>
    UNION ALL SELECT 'state', geoid, name, state_fips, NULL, geometry FROM <state_shapes>"""
register("set_union_layers", lambda t: sets.union_layers(layer_tables(t)), LAYERS_SQL)
register(
    "set_distinct", lambda t: sets.distinct(t("directory"), ["latitude", "longitude"]),
    "SELECT DISTINCT latitude, longitude FROM <directory>",
)

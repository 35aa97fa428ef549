"""Queries for the column expressions."""

from pyspark.sql import functions as F

from tallymark.bindings.registry import register, rounded
from tallymark.functions import exprs as E
from tallymark.functions.lookups import (
    ABBR_TO_NAME, CENSUS_COLUMNS, FIPS_TO_ABBR, MAP_EDGES, MAP_LABELS, MAP_NO_DATA,
)
from tallymark.operators import jsonx

register(
    "prj_rename_map",
    lambda t: t("census_coded").withColumnsRenamed(CENSUS_COLUMNS),
    "SELECT label, B01003_001E AS total_pop, B19001_016E AS hhi_150k_200k, B19001_017E AS hhi_220k_plus FROM <census_coded>",
)
register(
    "prj_fill_zero",
    lambda t: t("census").na.fill(0, subset=["hhi_150k_200k", "hhi_220k_plus"]).select(
        "zip_code", "hhi_150k_200k", "hhi_220k_plus"
    ),
    """SELECT zip_code, coalesce(hhi_150k_200k, 0) AS hhi_150k_200k,
              coalesce(hhi_220k_plus, 0) AS hhi_220k_plus FROM <census>""",
)
register(
    "prj_const_cols",
    lambda t: t("part").select("p_partkey").withColumns(
        {"year": F.lit(2021), "data_source": F.lit("census_api")}
    ),
    "SELECT p_partkey, 2021 AS year, 'census_api' AS data_source FROM <part>",
)
_TEXTS = """SELECT event_id, CASE event_id % 6 WHEN 0 THEN CAST(value AS STRING) WHEN 1 THEN concat(' ', CAST(value AS STRING), ' ')
    WHEN 2 THEN 'abc' WHEN 3 THEN '' WHEN 4 THEN CAST(user_id AS STRING) ELSE NULL END AS txt FROM <events>"""


def _texts(t):
    kind, value = F.col("event_id") % 6, F.col("value").cast("string")
    text = (
        F.when(kind == 0, value).when(kind == 1, F.concat(F.lit(" "), value, F.lit(" ")))
        .when(kind == 2, F.lit("abc")).when(kind == 3, F.lit("")).when(kind == 4, F.col("user_id").cast("string"))
    )
    return t("events").select("event_id", text.alias("txt"))


register(
    "prj_safe_float",
    lambda t: rounded(_texts(t).select("event_id", E.safe_float("txt").alias("number"))),
    f"SELECT event_id, round(try_cast(trim(txt) AS DOUBLE), 4) AS number FROM ({_TEXTS})",
)
register(
    "prj_safe_int",
    lambda t: _texts(t).select("event_id", E.safe_int("txt").alias("number")),
    f"SELECT event_id, CAST(trunc(try_cast(trim(txt) AS DOUBLE)) AS BIGINT) AS number FROM ({_TEXTS})",
)
register(
    "prj_typed_cast",
    lambda t: rounded(t("scores_text").select(
        "ncessch", "line", *E.typed({"year_json": "int", "math_test_pct_prof_low": "double",
                                     "read_test_pct_prof_low": "double", "math_test_num_valid": "bigint"})
    )),
    """SELECT ncessch, line, try_cast(year_json AS INT) AS year_json,
              round(try_cast(math_test_pct_prof_low AS DOUBLE), 4) AS math_test_pct_prof_low,
              round(try_cast(read_test_pct_prof_low AS DOUBLE), 4) AS read_test_pct_prof_low,
              try_cast(math_test_num_valid AS BIGINT) AS math_test_num_valid FROM <scores_text>""",
)
register(
    "prj_json_expand",
    lambda t: jsonx.expand_json(t("raw"), "data_json", ["event_id", "year"]),
    """SELECT event_id, year, data_json ->> '$.a_b' AS a_b_1, data_json ->> '$."a-b"' AS a_b,
              nullif(data_json ->> '$.note', 'null') AS note, data_json ->> '$.score' AS score,
              data_json ->> '$.user' AS "user", data_json ->> '$.year' AS year_json FROM <raw>""",
)
register(
    "prj_json_keys",
    lambda t: jsonx.json_keys(t("raw"), "data_json"),
    "SELECT DISTINCT unnest(json_keys(data_json)) AS key FROM <raw>",
)
register(
    "prj_json_types",
    lambda t: jsonx.json_types(t("raw"), "data_json"),
    """SELECT key, CASE json_type(data_json, concat('$."', key, '"')) WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array'
              WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' ELSE 'number' END AS kind, count(*) AS n
       FROM (SELECT data_json, unnest(json_keys(data_json)) AS key FROM <raw>) GROUP BY 1, 2""",
)
register(
    "prj_json_get",
    lambda t: t("events").select("event_id", jsonx.json_get("props", "k").alias("k")),
    "SELECT event_id, props ->> '$.k' AS k FROM <events>",
)
register(
    "prj_identifier",
    lambda t: t("pages").select("page_id", E.identifier("url").alias("name")),
    r"""SELECT page_id, lower(CASE WHEN regexp_matches(c, '^[0-9]') THEN 't_' || c ELSE c END) AS name
        FROM (SELECT page_id, regexp_replace(regexp_replace(url, '[^\p{L}\p{N}_]', '_', 'g'), '_+', '_', 'g') AS c FROM <pages>)""",
)
# keys that collide once they are identifiers, from the part names
_KEYS = """SELECT DISTINCT k AS key FROM (
    SELECT p_name AS k FROM <part> UNION ALL SELECT replace(p_name, ' ', '-') FROM <part>
    UNION ALL SELECT replace(p_name, ' ', '_') FROM <part> UNION ALL SELECT 'Year' FROM <part>
    UNION ALL SELECT CAST(p_size AS STRING) FROM <part>)"""


def _keys(t):
    parts = t("part")
    forms = [F.col("p_name"), F.replace("p_name", F.lit(" "), F.lit("-")),
             F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("Year"), F.col("p_size").cast("string")]
    return parts.select(F.explode(F.array(*forms)).alias("key")).distinct()


register(
    "prj_name_collision",
    lambda t: jsonx.named_keys(_keys(t)),
    r"""WITH k AS (%s), p AS (SELECT key, lower(regexp_replace(regexp_replace(key, '[^\p{L}\p{N}_]', '_', 'g'), '_+', '_', 'g')) AS c FROM k),
        q AS (SELECT key, CASE WHEN regexp_matches(c, '^[0-9]') THEN 't_' || c ELSE c END AS c FROM p),
        r AS (SELECT key, CASE WHEN c IN ('year', 'fetched_at', 'id') THEN c || '_json' ELSE c END AS c FROM q),
        s AS (SELECT key, c, row_number() OVER (PARTITION BY c ORDER BY key) - 1 AS n FROM r)
        SELECT key, CASE WHEN n = 0 THEN c ELSE c || '_' || n END AS "column" FROM s""" % _KEYS,
)
register(
    "prj_content_hash",
    lambda t: t("raw").select("event_id", E.content_hash("endpoint", "year", "data_json").alias("data_hash")),
    "SELECT event_id, sha256(endpoint || '_' || year || '_' || data_json) AS data_hash FROM <raw>",
)
register(
    "prj_strip_fips",
    lambda t: t("customer").select(
        "c_custkey",
        E.strip_fips(F.when(F.col("c_custkey") % 7 == 0, None)
                     .otherwise(F.lpad((F.col("c_custkey") % 30).cast("string"), 3, "0"))).alias("code"),
    ),
    """SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE CAST(c_custkey % 30 AS STRING) END AS code FROM <customer>""",
)
register(
    "prj_pad_fips",
    lambda t: t("directory").select(
        "ncessch", E.pad_fips("county_code", 5).alias("fips"), E.state_prefix("county_code").alias("state_fips")
    ),
    """SELECT ncessch, lpad(county_code, 5, '0') AS fips, substring(lpad(county_code, 5, '0'), 1, 2) AS state_fips FROM <directory>""",
)
_ABBR = " ".join(f"WHEN '{f}' THEN '{a}'" for f, a in FIPS_TO_ABBR.items())
_NAME = " ".join(f"WHEN '{a}' THEN '{n}'" for a, n in ABBR_TO_NAME.items())
register(
    "prj_code_label",
    lambda t: t("customer").withColumn("fips", E.pad_fips("c_nationkey", 2)).withColumn(
        "abbr", E.relabel("fips", FIPS_TO_ABBR, F.lit(""))
    ).select("c_custkey", "fips", "abbr", E.relabel("abbr", ABBR_TO_NAME, "abbr").alias("name")),
    f"""SELECT c_custkey, fips, abbr, CASE abbr {_NAME} ELSE abbr END AS name FROM (
        SELECT c_custkey, lpad(CAST(c_nationkey AS STRING), 2, '0') AS fips,
               CASE lpad(CAST(c_nationkey AS STRING), 2, '0') {_ABBR} ELSE '' END AS abbr FROM <customer>)""",
)
register(
    "prj_midpoint",
    lambda t: rounded(t("golden").select("school_id", E.midpoint("math_high_pct", "math_low_pct").alias("mid"))),
    """SELECT school_id, round(CASE WHEN math_high_pct IS NOT NULL AND math_low_pct IS NOT NULL THEN (math_high_pct + math_low_pct) / 2
              ELSE coalesce(math_high_pct, math_low_pct) END, 4) AS mid FROM <golden>""",
)
register(
    "prj_income_sum",
    lambda t: rounded(t("golden").select("school_id", E.null_safe_sum("pct_hhi_150k_200k", "pct_hhi_220k_plus").alias("pct"))),
    "SELECT school_id, round(coalesce(pct_hhi_150k_200k, 0) + coalesce(pct_hhi_220k_plus, 0), 4) AS pct FROM <golden>",
)
register(
    "prj_ratio",
    lambda t: t("golden").select("school_id", E.ratio("enrollment", "teachers_fte").alias("ratio")),
    "SELECT school_id, CASE WHEN teachers_fte <> 0 THEN round(enrollment / teachers_fte, 2) END AS ratio FROM <golden>",
)
register(
    "prj_pct_of",
    lambda t: rounded(t("census").where(F.col("total_pop") > 0).select(
        "zip_code", E.pct_of("hhi_220k_plus", "total_pop").alias("pct_high_income"),
        E.pct_of("hhi_150k_200k", "total_pop").alias("pct_upper_mid"))),
    """SELECT zip_code, round(coalesce(hhi_220k_plus / total_pop * 100, 0), 4) AS pct_high_income,
              round(coalesce(hhi_150k_200k / total_pop * 100, 0), 4) AS pct_upper_mid FROM <census> WHERE total_pop > 0""",
)


def _totals(df):
    return df.select(
        "zip_code", "total_pop",
        E.null_safe_sum("white_males_10_14", "white_females_10_14").alias("white_total"),
        E.null_safe_sum("black_males_10_14", "black_females_10_14").alias("black_total"),
        E.null_safe_sum("hispanic_males_10_14", "hispanic_females_10_14").alias("hispanic_total"),
        E.null_safe_sum("males_10_14", "females_10_14").alias("total_10_14"),
    )


TOTALS_SQL = """SELECT zip_code, total_pop, coalesce(white_males_10_14, 0) + coalesce(white_females_10_14, 0) AS white_total,
    coalesce(black_males_10_14, 0) + coalesce(black_females_10_14, 0) AS black_total,
    coalesce(hispanic_males_10_14, 0) + coalesce(hispanic_females_10_14, 0) AS hispanic_total,
    coalesce(males_10_14, 0) + coalesce(females_10_14, 0) AS total_10_14 FROM <census>"""
register("prj_null_safe_totals", lambda t: _totals(t("census")), TOTALS_SQL)
register(
    "prj_diversity",
    lambda t: rounded(_totals(t("census")).select(
        "zip_code", E.diversity(["white_total", "black_total", "hispanic_total"], "total_10_14").alias("diversity_score"))),
    f"""SELECT zip_code, round(1 - coalesce(pow(white_total / nullif(total_10_14, 0), 2) + pow(black_total / nullif(total_10_14, 0), 2)
              + pow(hispanic_total / nullif(total_10_14, 0), 2), 0), 4) AS diversity_score FROM ({TOTALS_SQL})""",
)
register(
    "prj_band",
    lambda t: t("scores").select(
        "l_orderkey", "l_linenumber",
        E.band("math_prof_mid", MAP_EDGES, MAP_LABELS, MAP_NO_DATA).alias("step"),
        E.band("read_prof_mid", [25, 50, 75], ["lt25", "b2550", "b5075", "gte75"]).alias("band")),
    """SELECT l_orderkey, l_linenumber,
         CASE WHEN math_prof_mid IS NULL THEN 'No data' WHEN math_prof_mid < 25 THEN '< 25%' WHEN math_prof_mid < 35 THEN '25–35%'
              WHEN math_prof_mid < 45 THEN '35–45%' WHEN math_prof_mid < 55 THEN '45–55%' WHEN math_prof_mid < 65 THEN '55–65%' ELSE '≥ 65%' END AS step,
         CASE WHEN read_prof_mid < 25 THEN 'lt25' WHEN read_prof_mid < 50 THEN 'b2550' WHEN read_prof_mid < 75 THEN 'b5075'
              WHEN read_prof_mid >= 75 THEN 'gte75' END AS band FROM <scores>""",
)
register(
    "prj_zip_prefix",
    lambda t: t("census").select("zip_code", E.zip_prefix("zip_code").alias("prefix")),
    "SELECT zip_code, substring(zip_code, 1, 3) AS prefix FROM <census>",
)
register(
    "prj_concat_label",
    lambda t: t("scores").select("l_orderkey", "l_linenumber", E.concat_label("race", "sex").alias("category")),
    "SELECT l_orderkey, l_linenumber, race || ' - ' || sex AS category FROM <scores>",
)
register(
    "prj_cost",
    lambda t: t("events").select(
        "event_id", E.round_to(E.cost(F.col("value") * 1000, F.col("user_id") * 1000, 3.0, 15.0), 6).alias("cost_usd")),
    "SELECT event_id, round(value * 1000 / 1e6 * 3e0 + user_id * 1000 / 1e6 * 15e0, 6) AS cost_usd FROM <events>",
)
register(
    "prj_utc_day",
    lambda t: t("events").select("event_id", E.utc_day("ts").alias("day")),
    "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM <events>",
)


def _features(t):
    rows = t("points").join(t("golden"), F.col("point_id") == F.col("school_id"))
    rows = rows.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return rows.select("school_id", E.point_feature(
        "longitude", "latitude", {"name": "school_name", "income": "pct_hhi_150k_200k", "enrollment": "enrollment"}
    ).alias("feature"))


register(
    "prj_point_feature", _features,
    """SELECT school_id, concat('{"type":"Feature","geometry":{"type":"Point","coordinates":[', longitude, ',', latitude,
              ']},"properties":{"name":"', school_name, '","income":', coalesce(CAST(pct_hhi_150k_200k AS STRING), 'null'),
              ',"enrollment":', enrollment, '}}') AS feature
       FROM <points> JOIN <golden> ON point_id = school_id""",
)
register(
    "prj_null_to_empty",
    lambda t: t("directory").select(
        "ncessch", E.null_to_empty("state_location").alias("state"), E.null_to_empty("year_json").alias("year_json")),
    """SELECT ncessch, CASE WHEN state_location IS NULL OR state_location IN ('None', 'nan', 'NaT') THEN '' ELSE state_location END AS state,
              coalesce(year_json, '') AS year_json FROM <directory>""",
)

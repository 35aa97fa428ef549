"""Queries for aggregates, statistics and profiles."""

from pyspark.sql import functions as F

from tallymark.bindings.expressions import TOTALS_SQL, _totals
from tallymark.bindings.joins import COUNTY_SQL, DISTRICTS_SQL, STATE_SQL, _r, schools
from tallymark.bindings.registry import names_of, register, rounded
from tallymark.functions.exprs import pct_of
from tallymark.functions.stats import pearson
from tallymark.operators import aggregates as A
from tallymark.operators import marts, profile, quantiles, stats, usage
from tallymark.plans.lineage import settle

register(
    "agg_race_scores",
    lambda t: rounded(A.mean_sum_by(
        t("scores"), ["race"], {"math_mean": "math_prof_mid", "read_mean": "read_prof_mid"},
        {"math_count": "math_valid", "read_count": "read_valid"})),
    """SELECT race, round(avg(math_prof_mid), 4) AS math_mean, round(avg(read_prof_mid), 4) AS read_mean,
              CAST(coalesce(sum(math_valid), 0) AS BIGINT) AS math_count, CAST(coalesce(sum(read_valid), 0) AS BIGINT) AS read_count
       FROM <scores> WHERE race IS NOT NULL GROUP BY race""",
)
register(
    "agg_year_race",
    lambda t: rounded(A.mean_sum_by(t("scores"), ["year", "race"], {"proficiency": "math_prof_mid"})),
    "SELECT year, race, round(avg(math_prof_mid), 4) AS proficiency FROM <scores> WHERE race IS NOT NULL GROUP BY 1, 2",
)
register(
    "agg_year_sex_counts",
    lambda t: A.mean_sum_by(t("scores"), ["year", "sex"], sums={"math_valid": "math_valid", "read_valid": "read_valid"},
                            total="total_students"),
    """SELECT year, sex, CAST(coalesce(sum(math_valid), 0) AS BIGINT) AS math_valid, CAST(coalesce(sum(read_valid), 0) AS BIGINT) AS read_valid,
              CAST(coalesce(sum(math_valid), 0) + coalesce(sum(read_valid), 0) AS BIGINT) AS total_students FROM <scores> GROUP BY 1, 2""",
)
register(
    "agg_year_sex_means",
    lambda t: rounded(A.mean_sum_by(t("scores"), ["year", "sex"], {"math": "math_prof_mid", "read": "read_prof_mid"})),
    "SELECT year, sex, round(avg(math_prof_mid), 4) AS math, round(avg(read_prof_mid), 4) AS read FROM <scores> GROUP BY 1, 2",
)
_SIX = [f"{s}_prof_{p}" for s in ("math", "read") for p in ("high", "mid", "low")]
register(
    "agg_score_bands",
    lambda t: rounded(A.mean_sum_by(t("scores"), ["year"], {c: c for c in _SIX})),
    f"SELECT year, {', '.join(f'round(avg({c}), 4) AS {c}' for c in _SIX)} FROM <scores> GROUP BY 1",
)
register(
    "agg_state_summary",
    lambda t: rounded(A.group_summary(
        t("golden").withColumn("state", F.col("school_type")), "state", "school_name",
        {"total_enrollment": "enrollment", "total_teachers": "teachers_fte"}, "total_enrollment", "avg_per_school", "n_schools")),
    """SELECT school_type AS state, count(school_name) AS n_schools, round(sum(enrollment), 4) AS total_enrollment,
              round(coalesce(sum(teachers_fte), 0), 4) AS total_teachers, round(sum(enrollment) / count(school_name), 0) AS avg_per_school
       FROM <golden> WHERE school_type IS NOT NULL GROUP BY 1""",
)
register(
    "agg_zip_prefix",
    lambda t: A.prefix_summary(t("census"), "zip_code", {"total_pop": "total_pop", "high_income": "hhi_220k_plus"}),
    """SELECT substring(zip_code, 1, 3) AS zip_prefix, CAST(sum(total_pop) AS BIGINT) AS total_pop,
              CAST(coalesce(sum(hhi_220k_plus), 0) AS BIGINT) AS high_income, count(zip_code) AS zip_count FROM <census> GROUP BY 1""",
)
register(
    "agg_value_counts", lambda t: A.value_counts(t("directory"), "school_type"),
    "SELECT school_type, count(*) AS n FROM <directory> GROUP BY 1",
)
register(
    "agg_ethnicity_totals",
    lambda t: A.label_totals(
        _totals(t("census")), {"White": "white_total", "Black": "black_total", "Hispanic": "hispanic_total"},
        "total_10_14", "ethnicity", "population", positive_only=True),
    f"""WITH s AS (SELECT sum(white_total) AS w, sum(black_total) AS b, sum(hispanic_total) AS h, sum(total_10_14) AS a FROM ({TOTALS_SQL}))
        SELECT * FROM (SELECT 'White' AS ethnicity, CAST(w AS DOUBLE) AS population FROM s UNION ALL SELECT 'Black', CAST(b AS DOUBLE) FROM s
            UNION ALL SELECT 'Hispanic', CAST(h AS DOUBLE) FROM s UNION ALL SELECT 'Other', CAST(a - w - b - h AS DOUBLE) FROM s) WHERE population > 0""",
)
register(
    "agg_gender_totals",
    lambda t: A.label_totals(t("census"), {"Male": "males_10_14", "Female": "females_10_14"}, label="gender", value="population"),
    """SELECT 'Male' AS gender, CAST(sum(males_10_14) AS DOUBLE) AS population FROM <census>
       UNION ALL SELECT 'Female', CAST(sum(females_10_14) AS DOUBLE) FROM <census>""",
)
_SIX_GROUPS = {f"{r.title()} {s.title()}": f"{r}_{s}_10_14" for s in ("males", "females") for r in ("white", "black", "hispanic")}
register(
    "agg_race_sex_totals",
    lambda t: A.label_totals(t("census"), _SIX_GROUPS, label="race", value="n_children"),
    " UNION ALL ".join(f"SELECT '{n}' AS race, CAST(sum({c}) AS DOUBLE) AS n_children FROM <census>" for n, c in _SIX_GROUPS.items()),
)
register(
    "agg_pearson",
    lambda t: t("scores").groupBy("year", "sex").agg(
        pearson("math_prof_mid", "read_prof_mid").alias("r"), pearson("math_valid", "math_valid", 3).alias("r_self")),
    f"SELECT year, sex, {_r('math_prof_mid', 'read_prof_mid')} AS r, {_r('math_valid', 'math_valid', 3)} AS r_self FROM <scores> GROUP BY 1, 2",
)
_OK = "math_prof_mid IS NOT NULL AND read_prof_mid IS NOT NULL"
register(
    "agg_trend_line",
    lambda t: rounded(stats.trend_segment(t("scores"), "math_prof_mid", "read_prof_mid", ["year"]), 3),
    f"""WITH f AS (SELECT year, count(*) AS n, regr_slope(read_prof_mid, math_prof_mid) AS b, regr_intercept(read_prof_mid, math_prof_mid) AS a,
            min(math_prof_mid) AS xl, max(math_prof_mid) AS xh, min(read_prof_mid) AS yl, max(read_prof_mid) AS yh FROM <scores> WHERE {_OK} GROUP BY 1),
         g AS (SELECT *, greatest(xl, least((yl - a) / b, (yh - a) / b)) AS p0, least(xh, greatest((yl - a) / b, (yh - a) / b)) AS p1 FROM f)
        SELECT year, n, round(b, 3) AS slope, round(a, 3) AS intercept, round(p0, 3) AS x0, round(a + b * p0, 3) AS y0,
               round(p1, 3) AS x1, round(a + b * p1, 3) AS y1 FROM g""",
)
register(
    "agg_ols",
    lambda t: rounded(stats.ols(t("census"), "total_pop", "hhi_220k_plus", ["data_source"])),
    """SELECT data_source, round(regr_slope(hhi_220k_plus, total_pop), 4) AS slope, round(regr_intercept(hhi_220k_plus, total_pop), 4) AS intercept,
              round(regr_r2(hhi_220k_plus, total_pop), 4) AS r2, CAST(regr_count(hhi_220k_plus, total_pop) AS BIGINT) AS n FROM <census> GROUP BY 1""",
)


def _cuts(t):
    q = quantiles.quantile_cuts(t("scores"), "read_prof_mid", keys=["sex"])
    return q.select("sex", "n", *[F.get("cuts", F.lit(i)).alias(f"cut{i + 1}") for i in range(4)])


register(
    "agg_quantile_cuts", _cuts,
    "SELECT sex, count(read_prof_mid) AS n, "
    + ", ".join(f"round(quantile_cont(read_prof_mid, {p}), 4) AS cut{i + 1}" for i, p in enumerate((0.2, 0.4, 0.6, 0.8)))
    + " FROM <scores> GROUP BY 1",
)
register(
    "agg_income_brackets",
    lambda t: rounded(quantiles.brackets(t("scores"), "read_prof_mid", "math_prof_mid", ["sex"], salt_by=["l_orderkey", "l_linenumber"])),
    f"""WITH p AS (SELECT sex, read_prof_mid AS x, math_prof_mid AS y FROM <scores> WHERE {_OK}),
          c AS (SELECT sex, min(x) AS lo, max(x) AS hi, round(quantile_cont(x, 0.2), 4) AS a, round(quantile_cont(x, 0.4), 4) AS b,
                       round(quantile_cont(x, 0.6), 4) AS c, round(quantile_cont(x, 0.8), 4) AS d FROM p GROUP BY 1),
          m AS (SELECT p.sex, CASE WHEN x < a THEN 0 WHEN x < b THEN 1 WHEN x < c THEN 2 WHEN x < d THEN 3 ELSE 4 END AS no, y, lo, hi, a, b, c, d
                FROM p JOIN c ON p.sex = c.sex),
          g AS (SELECT sex, no, any_value(CASE no WHEN 0 THEN lo WHEN 1 THEN a WHEN 2 THEN b WHEN 3 THEN c ELSE d END) AS low,
                       any_value(CASE no WHEN 0 THEN a WHEN 1 THEN b WHEN 2 THEN c WHEN 3 THEN d ELSE hi END) AS high, count(*) AS n,
                       count(*) FILTER (y < 25) AS n1, count(*) FILTER (y >= 25 AND y < 50) AS n2,
                       count(*) FILTER (y >= 50 AND y < 75) AS n3, count(*) FILTER (y >= 75) AS n4 FROM m GROUP BY 1, 2)
        SELECT sex, CAST(no AS INT) AS bracket_no, concat(CAST(round(low) AS BIGINT), '–', CAST(round(high) AS BIGINT), '%') AS bracket, round(low, 4) AS low, round(high, 4) AS high, n,
               n1 AS n_lt25, n2 AS n_b2550, n3 AS n_b5075, n4 AS n_gte75, round(n1 / n * 100, 4) AS lt25,
               round(n2 / n * 100, 4) AS b2550, round(n3 / n * 100, 4) AS b5075, round(n4 / n * 100, 4) AS gte75 FROM g""",
)
register(
    "agg_histogram",
    lambda t: rounded(quantiles.histogram(
        t("census").where(F.col("total_pop") > 0).select(pct_of("hhi_220k_plus", "total_pop").alias("pct")).where("pct > 0"), "pct", 40)),
    """WITH p AS (SELECT coalesce(hhi_220k_plus / total_pop * 100, 0) AS x FROM <census> WHERE total_pop > 0),
            q AS (SELECT x FROM p WHERE x > 0), e AS (SELECT min(x) AS lo, max(x) AS hi FROM q),
            c AS (SELECT least(CAST(floor(40 * (x - lo) / (hi - lo)) AS INT) + 1, 40) AS bin, count(*) AS n FROM q, e GROUP BY 1)
       SELECT CAST(b.bin AS INT) AS bin, round(lo + (hi - lo) / 40 * (b.bin - 1), 4) AS low, round(lo + (hi - lo) / 40 * b.bin, 4) AS high,
              coalesce(n, 0) AS n FROM range(1, 41) AS b(bin) CROSS JOIN e LEFT JOIN c ON c.bin = b.bin""",
)
register(
    "agg_summary",
    lambda t: rounded(quantiles.summary(t("census").where(F.col("total_pop") > 0), "total_pop")),
    """SELECT count(*) AS count, round(avg(total_pop), 4) AS mean, round(median(total_pop), 4) AS median, CAST(max(total_pop) AS DOUBLE) AS max
       FROM <census> WHERE total_pop > 0""",
)
_DESC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
register(
    "agg_describe",
    lambda t: rounded(profile.describe(t("lineitem"))),
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, round(CAST(min({c}) AS DOUBLE), 4) AS min,
            round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS p25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS p50,
            round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS p75, round(CAST(max({c}) AS DOUBLE), 4) AS max FROM <lineitem>"""
        for c in _DESC),
)
_GOLDEN = [
    "school_id", "school_name", "ncessch", "math_high_pct", "math_low_pct", "pct_hhi_150k_200k", "pct_hhi_220k_plus", "teachers_fte", "enrollment",
    "grade_eight_enrollment", "math_counts", "read_counts", "read_high_pct", "avg_natwalkind", "total_10_14", "schools_in_zip", "school_type",
]
register(
    "agg_missing_profile",
    lambda t: rounded(profile.missing_profile(t("golden"))),
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS missing, round(count(*) FILTER ({c} IS NULL) * 100.0 / count(*), 4) AS pct FROM <golden>"""
        for c in _GOLDEN),
)
_CATS = ["school_name", "ncessch", "state_location", "county_code", "zip_location"]  # the first five text columns
register(
    "agg_categorical_profile",
    lambda t: profile.categorical_profile(t("directory")).withColumn("listed", F.array_join("listed", "|")),
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct,
            CASE WHEN count(DISTINCT {c}) <= 10 THEN string_agg(DISTINCT {c}, '|' ORDER BY {c}) END AS listed FROM <directory>""" for c in _CATS),
)
register(
    "agg_count_distinct",
    lambda t: A.count_distinct(t("directory"), ["latitude", "longitude"], "n_pairs"),
    "SELECT count(*) AS n_pairs FROM (SELECT DISTINCT latitude, longitude FROM <directory> WHERE latitude IS NOT NULL AND longitude IS NOT NULL)",
)
register(
    "agg_bounds", lambda t: A.bounds(t("golden"), "enrollment", 1200.0),
    "SELECT min(enrollment) AS low, least(max(enrollment), 1200e0) AS high FROM <golden>",
)
register(
    "agg_global_mean",
    lambda t: rounded(A.global_means(t("scores"), {"avg_math": "math_prof_mid", "avg_read": "read_prof_mid"})),
    "SELECT count(*) AS n, round(avg(math_prof_mid), 4) AS avg_math, round(avg(read_prof_mid), 4) AS avg_read FROM <scores>",
)
register(
    "agg_having_dupes", lambda t: A.duplicates(t("orders"), ["o_custkey", "o_orderpriority"]),
    "SELECT o_custkey, o_orderpriority, count(*) AS n FROM <orders> GROUP BY 1, 2 HAVING count(*) > 1",
)
register(
    "agg_coverage", lambda t: A.coverage(t("directory"), "state_location"),
    """SELECT count(*) AS n_rows, count(nullif(state_location, '')) AS n_present,
              round(count(nullif(state_location, '')) * 100.0 / count(*), 4) AS pct_present FROM <directory>""",
)


def _insight(t):
    rows = settle(schools(t), "districts").where(F.col("state") != "")
    out = stats.insight_stats(rows, "pct_high_income", "math_pct_prof", "school_name", ["state"], marts.state_stats(rows))
    return out.withColumns({"top": names_of("top"), "bottom": names_of("bottom")})


_PAIR = "math_pct_prof IS NOT NULL AND pct_high_income IS NOT NULL"
register(
    "agg_insight_stats", _insight,
    f"""WITH d AS (SELECT * FROM ({DISTRICTS_SQL}) WHERE state <> ''), p AS (SELECT * FROM d WHERE {_PAIR}),
          b AS (SELECT state, count(*) AS row_count, count(*) FILTER ({_PAIR}) AS paired_points,
                  {_r('pct_high_income', 'math_pct_prof', 3)} AS pearson_r_on_screen, {_r('pct_high_income', 'math_pct_prof', 4)} AS pearson_r_precomputed
                FROM d GROUP BY 1),
          m AS (SELECT state, round(avg(math_pct_prof), 2) AS mean_y, round(avg(pct_high_income), 2) AS mean_x, round(median(math_pct_prof), 2) AS median_y,
                  round(median(pct_high_income), 2) AS median_x FROM p GROUP BY 1),
          k AS (SELECT state, school_name, row_number() OVER (PARTITION BY state ORDER BY math_pct_prof DESC, school_name) AS hi,
                  row_number() OVER (PARTITION BY state ORDER BY math_pct_prof, school_name DESC) AS lo FROM p)
        SELECT b.state, row_count, paired_points, mean_y, mean_x, pearson_r_on_screen, median_y, median_x,
               (SELECT string_agg(school_name, '|' ORDER BY hi) FROM k WHERE k.state = b.state AND hi <= 3) AS top,
               (SELECT string_agg(school_name, '|' ORDER BY lo) FROM k WHERE k.state = b.state AND lo <= 3) AS bottom,
               pearson_r_precomputed
        FROM b LEFT JOIN m ON b.state = m.state""",
)
register(
    "agg_national_totals", lambda t: A.national_totals(marts.state_stats(schools(t))),
    f"""SELECT count(*) AS state_count, CAST(sum(school_count) AS BIGINT) AS total_schools
        FROM (WITH d AS ({DISTRICTS_SQL}) {STATE_SQL.replace('<districts>', 'd')})""",
)
register(
    "agg_null_as_group", lambda t: A.count_by(t("directory"), ["state_location", "year_json"], "n", null_as_empty=True),
    """SELECT coalesce(state_location, '') AS state_location, coalesce(year_json, '') AS year_json, count(*) AS n
       FROM <directory> GROUP BY 1, 2""",
)
register(
    "agg_usage_status",
    lambda t: rounded(usage.usage_status(t("usage_log").withColumn("cost_usd", F.col("cost_usd").cast("double")), 7), 6),
    """SELECT day, round(sum(CAST(cost_usd AS DOUBLE)), 6) AS total_cost_usd, count(DISTINCT session_id) AS session_count,
              CAST(coalesce(sum(tokens) FILTER (session_id = 7), 0) AS BIGINT) AS session_tokens, count(*) FILTER (session_id = 7) > 0 AS session_exists
       FROM <usage_log> GROUP BY 1""",
)
register(
    "agg_usage_merge",
    lambda t: rounded(usage.merge_usage(t("usage_log").withColumn("cost_usd", F.col("cost_usd").cast("double"))), 6),
    """SELECT day, session_id, CAST(sum(tokens) AS BIGINT) AS tokens, round(sum(CAST(cost_usd AS DOUBLE)), 6) AS cost_usd FROM <usage_log> GROUP BY 1, 2""",
)


def _drill(t):
    rows = settle(schools(t), "districts")
    levels = settle(marts.level_stats(rows), "levels")
    states, counties = levels.where("level = 'state'").drop("level"), levels.where("level = 'county'").drop("level")
    national = marts.drill(rows, states, counties, "national").withColumn("level", F.lit("national"))
    state = marts.drill(rows, states, counties, "state", "NATION_7").withColumn("level", F.lit("state"))
    county = marts.drill(rows, states, counties, "county", "NATION_7", "703").withColumn("level", F.lit("county"))
    return national.unionByName(state).unionByName(rounded(county, 4), allowMissingColumns=True)


_COLS = "school_count, avg_math_pct_prof, avg_pct_high_income, pearson_r"
register(
    "agg_drill_levels", _drill,
    f"""WITH d AS ({DISTRICTS_SQL}), s AS ({STATE_SQL.replace('<districts>', 'd')}), c AS ({COUNTY_SQL.replace('<districts>', 'd')})
        SELECT state AS name, {_COLS}, 'national' AS level FROM s
        UNION ALL BY NAME SELECT county_fips AS name, {_COLS}, 'state' AS level FROM c WHERE state = 'NATION_7'
        UNION ALL BY NAME SELECT school_name AS name, enrollment, round(math_pct_prof, 4) AS math_pct_prof, round(pct_high_income, 4) AS pct_high_income,
               'county' AS level FROM d WHERE state = 'NATION_7' AND county_fips = '703'""",
)

"""Queries for joins, the spatial join and the marts."""

from pyspark.sql import functions as F

from tallymark.bindings.registry import register, rounded
from tallymark.plans.lineage import settle
from tallymark.operators import joins as J
from tallymark.operators import marts, spatial
from tallymark.operators.aggregates import count_by
from tallymark.sources.readers import wkt_layer


def schools(t):
    """The district mart over the test tables."""
    return marts.districts(t("golden"), t("directory"), salt_by=["school_id"])


DISTRICTS_SQL = """
    SELECT g.school_name, d.ncessch, d.state_location AS state, d.county_code AS county_fips, d.zip_location AS zip,
           try_cast(d.latitude AS DOUBLE) AS lat, try_cast(d.longitude AS DOUBLE) AS lon,
           CASE WHEN math_high_pct IS NOT NULL AND math_low_pct IS NOT NULL THEN (math_high_pct + math_low_pct) / 2.0
                ELSE coalesce(math_high_pct, math_low_pct) END AS math_pct_prof,
           coalesce(pct_hhi_150k_200k, 0) + coalesce(pct_hhi_220k_plus, 0) AS pct_high_income,
           pct_hhi_150k_200k, pct_hhi_220k_plus, g.teachers_fte,
           CAST(grade_eight_enrollment AS BIGINT) AS grade_eight_enrollment, CAST(math_counts AS BIGINT) AS math_counts,
           CAST(read_counts AS BIGINT) AS read_counts, read_high_pct, avg_natwalkind,
           CAST(total_10_14 AS BIGINT) AS total_10_14, CAST(schools_in_zip AS BIGINT) AS schools_in_zip, g.enrollment,
           CASE WHEN g.teachers_fte <> 0 THEN round(g.enrollment / g.teachers_fte, 2) END AS student_teacher_ratio
    FROM <golden> g LEFT JOIN (
        SELECT *, row_number() OVER (PARTITION BY upper(school_name) ORDER BY year_json DESC NULLS FIRST, ncessch) AS rn
        FROM <directory>) d ON d.rn = 1 AND upper(d.school_name) = upper(g.school_name)"""


def _r(x, y, digits=4):
    ok = f"{x} IS NOT NULL AND {y} IS NOT NULL"
    return (f"CASE WHEN count(*) FILTER ({ok}) >= 3 AND var_pop({x}) FILTER ({ok}) > 0 AND var_pop({y}) FILTER ({ok}) > 0 "
            f"THEN round(covar_pop({x}, {y}) / (sqrt(var_pop({x}) FILTER ({ok})) * sqrt(var_pop({y}) FILTER ({ok}))), {digits}) END")


def stats_sql(keys, filters, digits=2):
    """Statistics of the mart by SQL, for any keys."""
    out = [f"round(avg(math_pct_prof) FILTER (pct_high_income IS NOT NULL), {digits}) AS avg_math_pct_prof",
           f"round(avg(pct_high_income) FILTER (math_pct_prof IS NOT NULL), {digits}) AS avg_pct_high_income",
           f"{_r('pct_high_income', 'math_pct_prof')} AS pearson_r",
           "count(*) FILTER (math_pct_prof IS NOT NULL AND pct_high_income IS NOT NULL) AS school_count"]
    for m in marts.METRICS:
        out += [f"round(avg({m.x}) FILTER (math_pct_prof IS NOT NULL), {digits}) AS {m.avg_name}",
                f"{_r(m.x, 'math_pct_prof')} AS {m.r_name}",
                f"count(*) FILTER ({m.x} IS NOT NULL AND math_pct_prof IS NOT NULL) AS {m.n_name}"]
    return (f"SELECT {', '.join(keys)}, {', '.join(out)} FROM <districts> WHERE {filters} GROUP BY {', '.join(keys)} "
            "HAVING count(*) FILTER (math_pct_prof IS NOT NULL AND pct_high_income IS NOT NULL) > 0")


STATE_SQL = stats_sql(["state"], "state <> ''")
COUNTY_SQL = stats_sql(["state", "county_fips"], "state <> '' AND county_fips <> ''")


def over_districts(sql):
    return f"WITH d AS ({DISTRICTS_SQL}) {sql.replace('<districts>', 'd')}"


_ROUND = ["lat", "lon", "math_pct_prof", "pct_high_income", "pct_hhi_150k_200k", "pct_hhi_220k_plus", "teachers_fte",
          "read_high_pct", "avg_natwalkind", "enrollment", "student_teacher_ratio"]
register(
    "jn_left_upper_name", lambda t: rounded(schools(t)),
    f"SELECT * REPLACE ({', '.join(f'round({c}, 4) AS {c}' for c in _ROUND)}) FROM ({DISTRICTS_SQL})",
)
# eight digits instead of the published two: the averaged ratios have exact halves at two
register(
    "agg_state_stats", lambda t: marts.state_stats(schools(t), 8), over_districts(stats_sql(["state"], "state <> ''", 8)))
register(
    "agg_county_stats", lambda t: marts.county_stats(schools(t), 8),
    over_districts(stats_sql(["state", "county_fips"], "state <> '' AND county_fips <> ''", 8)))


def _map_stats(t):
    stats = t("customer").groupBy("c_nationkey").agg(
        F.avg("c_acctbal").alias("avg_math"), F.count(F.lit(1)).alias("school_count")
    ).where(F.col("c_nationkey") % 4 != 0)
    features = t("state_shapes").select("name", "geoid")
    return rounded(J.stats_to_feature(features, stats, "geoid", "c_nationkey", 2, ["avg_math", "school_count"]))


register(
    "jn_stats_to_feature", _map_stats,
    """SELECT lpad(geoid, 2, '0') AS geoid, name, round(avg_math, 4) AS avg_math, school_count FROM <state_shapes> LEFT JOIN
       (SELECT c_nationkey, avg(c_acctbal) AS avg_math, count(*) AS school_count FROM <customer> WHERE c_nationkey % 4 <> 0 GROUP BY 1)
       ON geoid = lpad(CAST(c_nationkey AS STRING), 2, '0')""",
)


def _named(t):
    names = t("nation").where("n_nationkey % 3 != 0").select(
        F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("county_name"))
    rows = t("customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("code"))
    return J.with_names(rows, names, "code", "county_name", salt_by=["c_custkey"])


register(
    "jn_county_names", _named,
    """SELECT c_custkey, CAST(c_nationkey AS STRING) AS code, coalesce(n_name, CAST(c_nationkey AS STRING)) AS name
       FROM <customer> LEFT JOIN (SELECT * FROM <nation> WHERE n_nationkey % 3 <> 0) ON c_nationkey = n_nationkey""",
)
register(
    "jn_inner_key",
    lambda t: J.inner_on(
        t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), t("orders"), "l_orderkey", "o_orderkey",
        ["o_orderpriority"], ["l_orderkey", "l_linenumber", "l_partkey"]),
    "SELECT l_orderkey, l_linenumber, l_partkey, o_orderpriority FROM <lineitem> JOIN <orders> ON l_orderkey = o_orderkey",
)
register(
    "jn_anti_hash",
    lambda t: J.not_stored(t("customer").select("c_custkey", "c_name"),
                           t("orders").where("o_custkey % 7 <> 0").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"]),
    "SELECT c_custkey, c_name FROM <customer> WHERE c_custkey NOT IN (SELECT o_custkey FROM <orders> WHERE o_custkey % 7 <> 0)",
)


def _dim(t):
    assess = t("scores").select(
        "l_orderkey", "l_linenumber", F.col("l_orderkey").cast("string").alias("ncessch"), "year", "math_prof_mid")
    directory = t("directory").where(F.col("year_json").isNotNull()).select(
        "ncessch", F.col("year_json").cast("int").alias("year"), "school_name",
        F.col("latitude").try_cast("double").alias("latitude"), F.col("longitude").try_cast("double").alias("longitude"))
    spots = t("points").groupBy("latitude", "longitude").agg(
        F.lpad(F.min("point_id").cast("string"), 9, "0").alias("zip"))
    census = t("census").groupBy(F.reverse("zip_code").alias("zip")).agg(F.max("total_pop").alias("total_pop"))
    years = census.withColumn("year", F.lit(1997))
    return rounded(marts.dim_assessments(assess, directory, spots, years, ["l_orderkey", "l_linenumber"]))


register(
    "jn_dim_assessments", _dim,
    """SELECT a.l_orderkey, a.l_linenumber, CAST(a.l_orderkey AS STRING) AS ncessch, a.year, round(a.math_prof_mid, 4) AS math_prof_mid,
              d.school_name, round(d.latitude, 4) AS latitude, round(d.longitude, 4) AS longitude, p.zip, c.total_pop
       FROM <scores> a
       LEFT JOIN (SELECT ncessch, CAST(year_json AS INT) AS year, school_name, try_cast(latitude AS DOUBLE) AS latitude,
                         try_cast(longitude AS DOUBLE) AS longitude FROM <directory> WHERE year_json IS NOT NULL) d
         ON d.ncessch = CAST(a.l_orderkey AS STRING) AND d.year = a.year
       LEFT JOIN (SELECT latitude, longitude, lpad(CAST(min(point_id) AS STRING), 9, '0') AS zip FROM <points> GROUP BY 1, 2) p
         ON p.latitude = d.latitude AND p.longitude = d.longitude
       LEFT JOIN (SELECT reverse(zip_code) AS zip, max(total_pop) AS total_pop FROM <census> GROUP BY 1) c ON c.zip = p.zip AND a.year = 1997""",
)


def golden_table(t):
    """The inferred school feature table over the test tables."""
    directory = t("directory").select(
        F.substring("ncessch", 1, 4).alias("ncessch"), "school_name", "school_type", F.col("ncessch").alias("entry"),
        F.col("year_json").try_cast("int").alias("year"), F.reverse(F.lpad(F.regexp_replace("zip_location", "^0+", ""), 9, "0")).alias("zip_code"),
        F.col("enrollment").try_cast("double").alias("enrollment"), F.col("teachers_fte").try_cast("double").alias("teachers_fte"))
    grade = (F.lit(7) + F.col("l_linenumber") % 2).cast("int").alias("grade")
    assess = t("scores").select(
        F.col("l_orderkey").cast("string").alias("ncessch"), grade, "math_valid", F.col("math_prof_low").alias("math_low"),
        F.col("math_prof_high").alias("math_high"), "read_valid", F.col("read_prof_low").alias("read_low"),
        F.col("read_prof_high").alias("read_high"))
    census = t("census").select(
        "zip_code", "total_pop", (F.col("males_10_14") + F.col("females_10_14")).alias("total_10_14"),
        "hhi_150k_200k", "hhi_220k_plus")
    directory = directory.withColumn("school_name", F.concat("school_name", F.lit(" "), "entry"))
    pupils = t("lineitem").select(
        F.col("l_orderkey").cast("string").alias("ncessch"), grade, F.col("l_quantity").cast("bigint").alias("enrollment"))
    walk = t("census").select("zip_code", (F.col("total_pop") % 20).cast("double").alias("avg_natwalkind"))
    return marts.golden(directory, assess, census, ["entry"], grades=pupils, walkability=walk)


GOLDEN_SQL = """WITH d AS (SELECT substring(ncessch, 1, 4) AS ncessch, school_name || ' ' || ncessch AS school_name, school_type, ncessch AS entry,
            try_cast(year_json AS INT) AS year, reverse(lpad(ltrim(zip_location, '0'), 9, '0')) AS zip_code,
            try_cast(enrollment AS DOUBLE) AS enrollment, try_cast(teachers_fte AS DOUBLE) AS teachers_fte FROM <directory>),
       a AS (SELECT CAST(l_orderkey AS STRING) AS ncessch, CAST(sum(math_valid) AS BIGINT) AS math_counts, avg(math_prof_low) AS math_low_pct,
            avg(math_prof_high) AS math_high_pct, CAST(sum(read_valid) AS BIGINT) AS read_counts, avg(read_prof_low) AS read_low_pct,
            avg(read_prof_high) AS read_high_pct FROM <scores> WHERE l_linenumber % 2 = 1 GROUP BY 1),
       e AS (SELECT CAST(l_orderkey AS STRING) AS ncessch, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS grade_eight_enrollment
             FROM <lineitem> WHERE l_linenumber % 2 = 1 GROUP BY 1),
       z AS (SELECT zip_code, count(*) AS schools_in_zip FROM d GROUP BY 1)
       SELECT d.zip_code, d.ncessch, d.school_name, d.school_type, d.entry, d.year, d.enrollment, d.teachers_fte, z.schools_in_zip, a.math_counts,
              a.math_low_pct, a.math_high_pct, a.read_counts, a.read_low_pct, a.read_high_pct, c.total_pop,
              c.males_10_14 + c.females_10_14 AS total_10_14, c.hhi_150k_200k, c.hhi_220k_plus,
              (c.males_10_14 + c.females_10_14) / nullif(c.total_pop, 0) * 100 AS pct_10_14,
              c.hhi_150k_200k / nullif(c.total_pop, 0) * 100 AS pct_hhi_150k_200k,
              c.hhi_220k_plus / nullif(c.total_pop, 0) * 100 AS pct_hhi_220k_plus,
              e.grade_eight_enrollment, CAST(c.total_pop % 20 AS DOUBLE) AS avg_natwalkind,
              row_number() OVER (PARTITION BY d.ncessch ORDER BY d.year DESC NULLS FIRST, d.school_name) AS dupe_rank
       FROM d LEFT JOIN z USING (zip_code) LEFT JOIN a ON a.ncessch = d.ncessch LEFT JOIN e ON e.ncessch = d.ncessch
              LEFT JOIN <census> c ON c.zip_code = d.zip_code"""
_GOLDEN_ROUND = ["math_low_pct", "math_high_pct", "read_low_pct", "read_high_pct", "pct_10_14", "pct_hhi_150k_200k", "pct_hhi_220k_plus"]
register(
    "jn_golden", lambda t: rounded(golden_table(t)),
    f"SELECT * REPLACE ({', '.join(f'round({c}, 4) AS {c}' for c in _GOLDEN_ROUND)}) FROM ({GOLDEN_SQL})",
)


def _published(t):
    """From the feature table to the published state and county statistics, in one chain."""
    golden = settle(golden_table(t), "golden")
    names = t("directory").withColumn("school_name", F.concat("school_name", F.lit(" "), "ncessch"))
    rows = settle(marts.districts(golden, names, salt_by=["entry"]), "districts")
    states = marts.state_stats(rows).withColumn("county_fips", F.lit(None).cast("string"))
    return states.unionByName(marts.county_stats(rows))


_CHAIN = f"""WITH gold AS ({GOLDEN_SQL}), named AS (SELECT * REPLACE (school_name || ' ' || ncessch AS school_name) FROM <directory>),
    d AS ({DISTRICTS_SQL.replace('<golden>', 'gold').replace('<directory>', 'named')}),
    s AS ({STATE_SQL.replace('<districts>', 'd')}), c AS ({COUNTY_SQL.replace('<districts>', 'd')})
    SELECT * FROM c UNION ALL BY NAME SELECT *, NULL AS county_fips FROM s"""
register("jn_golden_to_statistics", _published, _CHAIN)


# -- spatial -----------------------------------------------------------------

def layers(t):
    states = wkt_layer(t("state_shapes"), "geometry", {"name": "name", "state_fips": "state_fips"})
    counties = wkt_layer(t("county_shapes"), "geometry", {"name": "name", "state_fips": "state_fips", "county_fips": "county_fips"})
    zips = wkt_layer(t("zip_shapes"), "geometry", {"geoid": "geoid"})
    return [spatial.with_edges(x) for x in (states, counties, zips)]


_IN_STATE = """longitude > x AND longitude < x + 70 AND latitude > y AND latitude < y + 36
    AND NOT (longitude >= x + 10 AND longitude <= x + 20 AND latitude >= y + 5 AND latitude <= y + 15)"""
_IN_COUNTY = """(longitude > x AND longitude < x + 20 AND latitude > y AND latitude < y + 30)
    OR (longitude > x + 30 AND longitude < x + 60 AND latitude > y AND latitude < y + 20)"""
_IN_ZIP = "longitude > x AND latitude > y AND (longitude - x) + (latitude - y) < w"


def _located(t):
    return spatial.geocode(t("points"), *layers(t))


GEOCODE_SQL = f"""SELECT p.latitude, p.longitude, coalesce(z.geoid, '') AS zip, coalesce(c.name, '') AS county,
        coalesce(CAST(CAST(c.n_nationkey * 3 AS INT) AS STRING), '') AS county_fips, coalesce(s.n_name, '') AS state,
        coalesce(CAST(s.n_nationkey AS STRING), '') AS state_fips
    FROM (SELECT DISTINCT latitude, longitude FROM <points>) p
    LEFT JOIN <corners> s ON {_IN_STATE.replace('x +', 's.x +').replace('> x ', '> s.x ').replace('> y ', '> s.y ').replace('y +', 's.y +')}
    LEFT JOIN (SELECT *, concat('County ', n_nationkey) AS name FROM <corners>) c
         ON {_IN_COUNTY.replace('x +', 'c.x +').replace('> x ', '> c.x ').replace('> y ', '> c.y ').replace('y +', 'c.y +')}
    LEFT JOIN (SELECT *, lpad(CAST(s_suppkey AS STRING), 9, '0') AS geoid FROM <zip_corners>) z
         ON longitude > z.x AND latitude > z.y AND (longitude - z.x) + (latitude - z.y) < z.w"""
register("jn_spatial_within", _located, GEOCODE_SQL)


def _states_of_points(t):
    return spatial.within_left(t("points"), layers(t)[0], ["point_id"], "longitude", "latitude", {"name": "state"})


register(
    "jn_within_left", _states_of_points,
    f"SELECT point_id, longitude, latitude, n_name AS state FROM <points> LEFT JOIN <corners> ON {_IN_STATE}",
)
register(
    "src_wkt_layer",
    lambda t: spatial.with_edges(wkt_layer(t("zip_shapes"), "geometry", {"geoid": "geoid"})).select(
        "geoid", F.size("edges").alias("n_edges"), "xmin", "ymin", "xmax", "ymax"),
    """SELECT lpad(CAST(s_suppkey AS STRING), 9, '0') AS geoid, 3 AS n_edges, CAST(x AS DOUBLE) AS xmin, CAST(y AS DOUBLE) AS ymin,
              CAST(x + w AS DOUBLE) AS xmax, CAST(y + w AS DOUBLE) AS ymax FROM <zip_corners>""",
)
register(
    "agg_bbox",
    lambda t: spatial.bbox(layers(t)[1].withColumn("band", F.col("state_fips").cast("int") % 5), ["band"]),
    """SELECT CAST(n_nationkey % 5 AS INT) AS band, CAST(min(x) AS DOUBLE) AS lon_min, CAST(min(y) AS DOUBLE) AS lat_min,
              CAST(max(x) + 60 AS DOUBLE) AS lon_max, CAST(max(y) + 30 AS DOUBLE) AS lat_max FROM <corners> GROUP BY 1""",
)
register(
    "agg_zip_density",
    lambda t: count_by(t("points").withColumn("zip_code", (F.col("point_id") % 997).cast("string")),
                       ["zip_code", "latitude", "longitude"], "school_count"),
    """SELECT CAST(point_id % 997 AS STRING) AS zip_code, latitude, longitude, count(*) AS school_count FROM <points> GROUP BY 1, 2, 3""",
)

"""Queries for the row filters."""

from pyspark.sql import functions as F

from tallymark.bindings.joins import DISTRICTS_SQL, STATE_SQL, schools
from tallymark.bindings.registry import register, rounded
from tallymark.operators import filters as O
from tallymark.operators import marts

register(
    "flt_coord_valid",
    lambda t: t("directory").where(O.coord_valid("latitude", "longitude")).select("ncessch", "latitude", "longitude"),
    """SELECT ncessch, latitude, longitude FROM <directory>
       WHERE try_cast(latitude AS DOUBLE) BETWEEN -90 AND 90 AND try_cast(longitude AS DOUBLE) BETWEEN -180 AND 180""",
)
register(
    "flt_in_list",
    lambda t: t("scores").where(O.in_list("race", ["1-URGENT", "5-LOW"]) & O.in_list("year", []))
    .select("l_orderkey", "l_linenumber", "race"),
    "SELECT l_orderkey, l_linenumber, race FROM <scores> WHERE race IN ('1-URGENT', '5-LOW')",
)
register(
    "flt_range",
    lambda t: t("scores").where(O.in_range("math_prof_mid", 10, 30)).select("l_orderkey", "l_linenumber", "math_prof_mid"),
    "SELECT l_orderkey, l_linenumber, math_prof_mid FROM <scores> WHERE math_prof_mid >= 10 AND math_prof_mid <= 30",
)
register(
    "flt_eq_or_contains",
    lambda t: O.eq_or_contains(O.eq_or_contains(t("part"), "p_name", "RED|small"), "p_size", "28").select("p_partkey", "p_name", "p_size"),
    "SELECT p_partkey, p_name, p_size FROM <part> WHERE regexp_matches(p_name, '(?i)RED|small') AND p_size = 28",
)
register(
    "flt_threshold",
    lambda t: t("census").where(O.above("total_pop", 100)).select("zip_code", "total_pop"),
    "SELECT zip_code, total_pop FROM <census> WHERE total_pop > 100",
)
register(
    "flt_not_null",
    lambda t: O.not_null(t("golden"), ["teachers_fte", "read_high_pct"]).select("school_id", "teachers_fte"),
    "SELECT school_id, teachers_fte FROM <golden> WHERE teachers_fte IS NOT NULL AND read_high_pct IS NOT NULL",
)
register(
    "flt_drop_any_null",
    lambda t: rounded(O.drop_any_null(t("golden").select("school_id", "math_high_pct", "math_low_pct", "teachers_fte"))),
    """SELECT school_id, round(math_high_pct, 4) AS math_high_pct, round(math_low_pct, 4) AS math_low_pct, teachers_fte FROM <golden>
       WHERE math_high_pct IS NOT NULL AND math_low_pct IS NOT NULL AND teachers_fte IS NOT NULL""",
)


def _levels(t):
    rows = schools(t)
    states = marts.state_stats(rows)
    parts = [
        O.scatter(rows, states, "pct_high_income", "avg_pct_high_income"),
        O.scatter(rows, states, "avg_natwalkind", "avg_walkability", state="NATION_7"),
        O.scatter(rows, states, "pct_high_income", "avg_pct_high_income", state="NATION_7", county="703"),
    ]
    tagged = [p.withColumn("level", F.lit(n)) for p, n in zip(parts, ("national", "state", "county"))]
    return rounded(tagged[0].unionByName(tagged[1]).unionByName(tagged[2]), 2)


register(
    "flt_paired", _levels,
    f"""WITH d AS ({DISTRICTS_SQL}), s AS ({STATE_SQL.replace("<districts>", "d")})
        SELECT round(avg_pct_high_income, 2) AS x, round(avg_math_pct_prof, 2) AS y, state AS name, 'national' AS level FROM s
        UNION ALL SELECT round(avg_natwalkind, 2), round(math_pct_prof, 2), school_name, 'state' FROM d
            WHERE state = 'NATION_7' AND avg_natwalkind IS NOT NULL AND math_pct_prof IS NOT NULL
        UNION ALL SELECT round(pct_high_income, 2), round(math_pct_prof, 2), school_name, 'county' FROM d
            WHERE state = 'NATION_7' AND county_fips = '703' AND math_pct_prof IS NOT NULL""",
)
register(
    "flt_key_lookup",
    lambda t: O.key_lookup(t("directory"), state_location="NATION_3", county_code="301").select("ncessch", "school_name"),
    "SELECT ncessch, school_name FROM <directory> WHERE state_location = 'NATION_3' AND county_code = '301'",
)

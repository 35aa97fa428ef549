"""The published tables: schools with geography, county and state statistics, star joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.exprs import (
    midpoint, null_safe_sum, number, ratio, safe_float, safe_int,
)
from tallymark.operators.aggregates import count_by
from tallymark.operators.joins import left_upper_name
from tallymark.operators.stats import Metric, area_levels, area_stats
from tallymark.operators.windows import dupe_rank
from tallymark.plans.skew import salted_join

# the metrics published next to income, and their result names
METRICS = [
    Metric("student_teacher_ratio", "avg_student_teacher_ratio",
           "pearson_r_student_teacher_ratio", "n_student_teacher_ratio"),
    Metric("avg_natwalkind", "avg_walkability", "pearson_r_walkability", "n_walkability"),
    Metric("read_high_pct", "avg_read_high_pct", "pearson_r_reading", "n_reading"),
]

GOLDEN_NUMBERS = [
    "math_high_pct", "math_low_pct", "pct_hhi_150k_200k", "pct_hhi_220k_plus", "teachers_fte",
    "read_high_pct", "avg_natwalkind", "enrollment",
]
GEO_COLUMNS = ["ncessch", "state", "county_fips", "zip", "lat", "lon"]


def districts(golden: DataFrame, directory: DataFrame, tie: str = "ncessch",
              salt_by: Sequence[str] | None = None) -> DataFrame:
    """School rows with the geography of the newest directory entry of the same name.

    A directory row without a year counts as newest; entries of equal year are
    told apart by ``tie``.
    """
    geo = directory.select(
        "school_name",
        "ncessch",
        F.col("state_location").alias("state"),
        F.col("county_code").alias("county_fips"),
        F.col("zip_location").alias("zip"),
        safe_float("latitude").alias("lat"),
        safe_float("longitude").alias("lon"),
        "year_json",
    )
    order = [F.desc_nulls_first("year_json"), F.asc(tie)]
    facts = golden.drop("ncessch")
    joined = left_upper_name(facts, geo, "school_name", order, GEO_COLUMNS, salt_by)
    value = {c: number(golden, c) for c in GOLDEN_NUMBERS}
    return joined.select(
        "school_name",
        *GEO_COLUMNS,
        midpoint(value["math_high_pct"], value["math_low_pct"]).alias("math_pct_prof"),
        null_safe_sum(value["pct_hhi_150k_200k"], value["pct_hhi_220k_plus"])
        .cast("double").alias("pct_high_income"),
        *[value[c].alias(c) for c in ("pct_hhi_150k_200k", "pct_hhi_220k_plus", "teachers_fte")],
        *[_count(golden, c).alias(c) for c in ("grade_eight_enrollment", "math_counts", "read_counts")],
        *[value[c].alias(c) for c in ("read_high_pct", "avg_natwalkind")],
        *[_count(golden, c).alias(c) for c in ("total_10_14", "schools_in_zip")],
        value["enrollment"].alias("enrollment"),
        ratio(value["enrollment"], value["teachers_fte"]).alias("student_teacher_ratio"),
    )


def _count(df: DataFrame, name: str) -> Column:
    whole = isinstance(df.schema[name].dataType, T.IntegralType)
    return F.col(name).cast("bigint") if whole else safe_int(name)


def county_stats(schools: DataFrame, digits: int = 2) -> DataFrame:
    keys = ["state", "county_fips"]
    return area_stats(schools, keys, "pct_high_income", "math_pct_prof", METRICS, digits=digits)


def state_stats(schools: DataFrame, digits: int = 2) -> DataFrame:
    """From the schools, not from the counties: schools without a county count here."""
    keys = ["state"]
    return area_stats(schools, keys, "pct_high_income", "math_pct_prof", METRICS, digits=digits)


def level_stats(schools: DataFrame, digits: int = 2) -> DataFrame:
    """State and county statistics from one pass over the schools; ``level`` is state or county."""
    levels = {"state": ["state"], "county": ["state", "county_fips"]}
    return area_levels(schools, levels, "pct_high_income", "math_pct_prof", METRICS, digits=digits)


def drill(schools: DataFrame, states: DataFrame, counties: DataFrame, level: str,
          state: str | None = None, county: str | None = None) -> DataFrame:
    """Rows of the national, state or county view.

    The national view lists state averages and the state view county averages.
    """
    stats = ["school_count", "avg_math_pct_prof", "avg_pct_high_income", "pearson_r"]
    if level == "national":
        return states.select(F.col("state").alias("name"), *stats)
    if level == "state":
        return counties.where(F.col("state") == state).select(
            F.col("county_fips").alias("name"), *stats
        )
    if level == "county":
        return schools.where((F.col("state") == state) & (F.col("county_fips") == county)).select(
            F.col("school_name").alias("name"), "enrollment", "math_pct_prof", "pct_high_income"
        )
    raise ValueError(f"unknown level {level!r}")


def dim_assessments(assessments: DataFrame, directory: DataFrame, location: DataFrame,
                    census: DataFrame, salt_by: Sequence[str] | None = None) -> DataFrame:
    """Assessments with their school, its place, and the census of its zip code.

    The sources describe this mart but do not define it. Assumed keys: school and
    year, then coordinates, then zip and year. Each right side has one row per key.
    The small tables are joined to each other first, so the assessments are shuffled once.
    """
    schools = salted_join(directory, location, ["latitude", "longitude"], "left", ["ncessch", "year"])
    schools = salted_join(schools, census, ["zip", "year"], "left", ["ncessch", "year"])
    return salted_join(assessments, schools, ["ncessch", "year"], "left", salt_by)


def golden(directory: DataFrame, assessments: DataFrame, census: DataFrame,
           salt_by: Sequence[str] | None = None, grade: int | None = 8,
           grades: DataFrame | None = None, walkability: DataFrame | None = None) -> DataFrame:
    """School feature table, with every column that ``districts`` takes.

    Only its column names are known. Assumed: one row per directory entry,
    its results of one grade added up by school, the census of its zip code, shares as
    percent of the population, and ``dupe_rank`` numbering the entries of a school.

    Results of other grades than ``grade`` are left out where ``assessments`` has that column.
    ``grades`` (ncessch, grade, enrollment) gives the pupils of grade eight, ``walkability``
    (zip_code, avg_natwalkind) the walkability of a zip code; without them the columns are null.
    """
    if grade is not None and "grade" in assessments.columns:
        assessments = assessments.where(F.col("grade") == grade)
    scores = assessments.groupBy("ncessch").agg(
        F.sum("math_valid").alias("math_counts"),
        F.avg("math_low").alias("math_low_pct"),
        F.avg("math_high").alias("math_high_pct"),
        F.sum("read_valid").alias("read_counts"),
        F.avg("read_low").alias("read_low_pct"),
        F.avg("read_high").alias("read_high_pct"),
    )
    ranked = dupe_rank(directory, ["ncessch"], [F.desc_nulls_first("year"), F.asc("school_name")])
    zips = count_by(directory, ["zip_code"], "schools_in_zip").join(census, "zip_code", "left")
    if walkability is not None:
        zips = zips.join(walkability.select("zip_code", "avg_natwalkind"), "zip_code", "left")
    if grades is not None:
        eighth = grades.where(F.col("grade") == 8).groupBy("ncessch").agg(F.sum("enrollment").alias("grade_eight_enrollment"))
        scores = scores.join(eighth, "ncessch", "full")
    out = salted_join(ranked, zips, ["zip_code"], "left", salt_by)
    out = salted_join(out, scores, ["ncessch"], "left", salt_by)

    def share(part: str):
        return F.try_divide(F.col(part), F.col("total_pop")) * 100

    out = out.withColumns({
        "pct_10_14": share("total_10_14"),
        "pct_hhi_150k_200k": share("hhi_150k_200k"),
        "pct_hhi_220k_plus": share("hhi_220k_plus"),
    })
    absent = {"grade_eight_enrollment": "bigint", "avg_natwalkind": "double"}
    return out.withColumns({c: F.lit(None).cast(t) for c, t in absent.items() if c not in out.columns})

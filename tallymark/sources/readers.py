"""Readers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tallymark.functions.exprs import content_hash, safe_float, safe_int, strip_fips
from tallymark.functions.lookups import CENSUS_COLUMNS


def table(
    spark: SparkSession, name: str, columns: Sequence[str] | None = None,
    where: Column | None = None, limit: int | None = None,
) -> DataFrame:
    """A catalog table or a Parquet path, with columns and filters left to the scan."""
    df = spark.read.parquet(name) if "/" in name else spark.table(name)
    if where is not None:
        df = df.where(where)
    if columns:
        df = df.select(*columns)
    return df if limit is None else df.limit(limit)


def page(df: DataFrame, order_key: str, limit: int, offset: int = 0, after=None) -> DataFrame:
    """One page of a table in key order.

    ``after`` (the last key of the page before) lets the scan skip what was shown, which
    a deep ``offset`` cannot.
    """
    if after is not None:
        df = df.where(F.col(order_key) > F.lit(after))
    ordered = df.orderBy(order_key)
    return (ordered.offset(offset) if offset else ordered).limit(limit)


def jdbc(
    spark: SparkSession, url: str, source: str, partition_column: str, low, high,
    partitions: int, properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """An operational database, read by ranges of a column in parallel."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=source, partitionColumn=partition_column,
        lowerBound=str(low), upperBound=str(high), numPartitions=str(partitions),
    )
    return reader.options(**dict(properties or {})).load()


def csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with a header; types are inferred only when no schema is given."""
    reader = spark.read.option("header", True)
    if schema:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


_PAGE = "results array<string>, _broken string"


def _parsed(pages: DataFrame, payload: str) -> DataFrame:
    """Pages with their parsed text (``_page``), whether that is broken, and the file it came from."""
    file = F.col("_metadata.file_path")
    try:
        pages.select(file)
    except AnalysisException:  # not read from files
        file = F.lit(None).cast("string")
    parsed = F.from_json(payload, _PAGE, {"columnNameOfCorruptRecord": "_broken"})
    out = pages.withColumns({"_file": file, "_page": parsed})
    page_ = F.col("_page")
    return out.withColumn("_is_broken", page_.isNull() | page_["_broken"].isNotNull() | page_["results"].isNull())


def json_pages(pages: DataFrame, payload: str = "value", endpoint: str = "endpoint",
               year: str = "year", skip_broken: bool = False) -> DataFrame:
    """Records of landed API pages, one row per entry of ``results``, with their hash.

    Each record keeps its JSON text. A page that is no JSON object with a list ``results``
    fails the read, with the name of its file; with ``skip_broken`` it is left to
    ``broken_pages``. An empty list is a page without records.
    """
    rows = _parsed(pages, payload)
    results = F.col("_page")["results"]
    if skip_broken:
        rows = rows.where(~F.col("_is_broken"))
    else:
        what = F.concat(F.lit("broken page in "), F.coalesce("_file", F.lit("an unnamed source")), F.lit(": "), F.left(F.col(payload), F.lit(80)))
        results = F.when(F.col("_is_broken"), F.raise_error(F.coalesce(what, F.lit("page without text")))).otherwise(results)
    records = rows.select(endpoint, F.col(year).cast("int").alias("year"), F.explode(results).alias("data_json"))
    return records.withColumn("data_hash", content_hash(endpoint, "year", "data_json"))


def broken_pages(pages: DataFrame, payload: str = "value", endpoint: str = "endpoint",
                 year: str = "year") -> DataFrame:
    """The pages that ``json_pages`` cannot read, with the file they came from."""
    rows = _parsed(pages, payload).where("_is_broken")
    return rows.select(endpoint, F.col(year).cast("int").alias("year"), F.col("_file").alias("file"), F.col(payload).alias("payload"))


def landed_pages(spark: SparkSession, path: str, one_per_line: bool = True) -> DataFrame:
    """Page files under ``endpoint=.../year=...``, one page per line or one per file."""
    return spark.read.text(path, wholetext=not one_per_line)


def coded_wide(
    df: DataFrame, label: str, year: int | Column, source: str = "census_api",
    names: Mapping[str, str] = CENSUS_COLUMNS,
) -> DataFrame:
    """A coded statistics table as named columns per zip; missing counts are 0."""
    have = {k: v for k, v in names.items() if k in df.columns}
    named = df.withColumnsRenamed(have)
    named = named.withColumn("zip_code", F.regexp_extract(label, r"(\d{5,})", 1)).drop(label)
    named = named.na.fill(0, subset=list(have.values()))
    stamp = F.lit(year) if isinstance(year, int) else year
    return named.withColumns({"year": stamp, "data_source": F.lit(source)})


def wkt_layer(
    df: DataFrame, geometry: str, codes: Mapping[str, str], pads: Mapping[str, int] | None = None,
) -> DataFrame:
    """A polygon layer: attribute subset under its output names, with codes stripped of zeros."""
    attributes = [
        (strip_fips(c) if o.endswith("_fips") else F.col(c)).alias(o) for c, o in codes.items()
    ]
    return df.select(*attributes, F.col(geometry).alias("geometry"))


# -- typed base views --------------------------------------------------------

def _view(df: DataFrame, texts: Mapping[str, str], numbers: Mapping[str, str]) -> DataFrame:
    return df.select(
        *[F.col(c).alias(o) for c, o in texts.items()],
        *[safe_float(c).alias(o) for c, o in numbers.items()],
        safe_int("year_json").cast("int").alias("year"),
    )


def assessments_view(df: DataFrame) -> DataFrame:
    """Assessment results with numeric columns; rows need a year."""
    numbers = {}
    for subject in ("math", "read"):
        numbers[f"{subject}_test_num_valid"] = f"{subject}_valid"
        numbers[f"{subject}_test_pct_prof_high"] = f"{subject}_prof_high"
        numbers[f"{subject}_test_pct_prof_low"] = f"{subject}_prof_low"
        numbers[f"{subject}_test_pct_prof_midpt"] = f"{subject}_prof_mid"
    texts = {c: c for c in ("lea_name", "ncessch", "econ_disadvantaged", "race", "sex")}
    return _view(df.where(F.col("year_json").isNotNull()), texts, numbers)


def directory_view(df: DataFrame) -> DataFrame:
    """School directory with numeric columns; rows need a year."""
    texts = {
        "school_name": "school_name", "ncessch": "ncessch", "school_status": "school_status",
        "school_type": "school_type", "zip_location": "zip_code", "city_location": "city",
        "state_location": "state",
    }
    numbers = {c: c for c in ("enrollment", "teachers_fte", "latitude", "longitude")}
    return _view(df.where(F.col("year_json").isNotNull()), texts, numbers)


CENSUS_NUMBERS = tuple(CENSUS_COLUMNS.values())


def census_view(df: DataFrame) -> DataFrame:
    """Census counts as doubles, for zip codes somebody lives in."""
    return df.where(F.col("total_pop") > 0).select(
        "zip_code", "year", *[F.col(c).cast("double").alias(c) for c in CENSUS_NUMBERS]
    )


def locations_view(df: DataFrame) -> DataFrame:
    """Geocoded places with both coordinates."""
    return df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(
        "zip", "state", "state_fips", "county_fips",
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
    )

"""Queries about tables and their quality."""

from pyspark.sql import functions as F

from tallymark.bindings.registry import TABLES, register
from tallymark.operators import catalog, filters, quality

register(
    "cat_row_counts", lambda t: catalog.row_counts({n: t(n) for n in TABLES}),
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, (SELECT count(*) FROM <{n}>) AS n_rows, (SELECT count(*) FROM (DESCRIBE <{n}>)) AS n_columns" for n in TABLES),
)
register(
    "cat_exists", lambda t: catalog.usable_rows(t("directory"), filters.coord_valid("latitude", "longitude")),
    """SELECT count(*) AS n_rows, count(*) FILTER (ok) AS n_usable, count(*) FILTER (ok) > 0 AS usable FROM (
         SELECT coalesce(try_cast(latitude AS DOUBLE) BETWEEN -90 AND 90 AND try_cast(longitude AS DOUBLE) BETWEEN -180 AND 180, false) AS ok FROM <directory>)""",
)
_SELECT = """WITH busy AS (SELECT o_custkey, count(*) AS n FROM {orders} GROUP BY o_custkey)
    SELECT c_mktsegment, CAST(sum(n) AS BIGINT) AS n_orders FROM busy JOIN {customer} ON o_custkey = c_custkey WHERE n >= {least} GROUP BY c_mktsegment"""
register(
    "qry_select",
    lambda t: catalog.run_select(t.spark, _SELECT.format(orders="q_orders", customer="q_customer", least=":least"),
                                 {"q_orders": t("orders"), "q_customer": t("customer")}, {"least": 5}),
    _SELECT.format(orders="<orders>", customer="<customer>", least=5),
)
# the declared models over the roles: the select list of each, and the role
_MODELS = {
    "stg_census_data": ("CASE WHEN total_pop = 0 THEN NULL ELSE left(zip_code, 1) END AS state", "census"),
    "stg_school_directory": (
        "nullif(left(ncessch, 2), '12') AS leaid, ncessch, try_cast(latitude AS DOUBLE) AS latitude, try_cast(longitude AS DOUBLE) AS longitude", "directory"),
    "stg_school_assessments": ("nullif(lea_name, 'LEA 7') AS leaid, ncessch, year_json AS year", "scores_text"),
    "stg_location_data": ("nullif(latitude, 0e0) AS latitude, longitude", "points"),
    "dim_school_assessments": ("nullif(CAST(l_orderkey AS STRING), '1') AS leaid, CAST(l_orderkey AS STRING) AS ncessch, year", "scores"),
}


def _failures(t):
    tables = {}
    for name, (select, role) in _MODELS.items():
        rows = t.spark.sql(f"SELECT {select} FROM {{rows}}", rows=t(role))
        tables[name] = (rows, quality.NOT_NULL[name])
    return quality.not_null(tables)


register(
    "dq_not_null", _failures,
    " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS failures FROM (SELECT {select} FROM <{role}>)"""
        for name, (select, role) in _MODELS.items() for c in quality.NOT_NULL[name]),
)
register(
    "dq_unique", lambda t: quality.unique(t("events").select(F.sha2("props", 256).alias("data_hash")), ["data_hash"]),
    "SELECT sha256(props) AS data_hash, count(*) AS failures FROM <events> GROUP BY 1 HAVING count(*) > 1",
)

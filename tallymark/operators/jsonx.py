"""Semi-structured payloads to columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.exprs import identifier
from tallymark.functions.lookups import RESERVED_NAMES

def json_keys(df: DataFrame, payload: str) -> DataFrame:
    """Distinct top-level keys of all payloads, as ``key``."""
    return df.select(F.explode(F.json_object_keys(payload)).alias("key")).distinct()


def json_types(df: DataFrame, payload: str) -> DataFrame:
    """Every top-level key with the kinds of its values and how often each occurs, as ``key, kind, n``.

    Kinds are object, array, string, number, boolean and null. Payloads are parsed once, as variants, and counted in one
    aggregate; keys are data here, so there may be any number. Text that is no JSON object has no keys.
    """
    parsed = df.select(F.try_parse_json(payload).alias("_v")).where(F.col("_v").isNotNull())
    entries = parsed.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_v").outer())).where(F.col("key").isNotNull())
    kind = F.schema_of_variant("value")
    named = (
        F.when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array").when(kind == "STRING", "string")
        .when(kind == "BOOLEAN", "boolean").when(kind == "VOID", "null").otherwise("number")
    )
    return entries.groupBy("key", named.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def json_get(payload: str | Column, key: str) -> Column:
    """One top-level value as text: nested values stay JSON, JSON null is null."""
    c = F.col(payload) if isinstance(payload, str) else payload
    return F.try_element_at(F.from_json(c, "map<string,string>"), F.lit(key))


def json_map(df: DataFrame, payload: str, out: str = "values") -> DataFrame:
    """The top-level values of each payload as one map column of text."""
    return df.withColumn(out, F.from_json(payload, "map<string,string>"))


def named_keys(keys: DataFrame, reserved: Sequence[str] = RESERVED_NAMES) -> DataFrame:
    """A column name for every key.

    Keys become identifiers; reserved ones get ``_json``; equal ones get ``_1``, ``_2``,
    ... in key order. The second round settles suffixed names that meet another
    key's own name. The table has one row per column, so the windows stay small.
    """
    def numbered(df: DataFrame, base: str, out: str) -> DataFrame:
        n = F.row_number().over(Window.partitionBy(base).orderBy("key")) - 1
        name = F.when(n == 0, F.col(base)).otherwise(F.concat(F.col(base), F.lit("_"), n))
        return df.withColumn(out, name)

    plain = identifier("key")
    base = F.when(plain.isin(list(reserved)), F.concat(plain, F.lit("_json"))).otherwise(plain)
    once = numbered(keys.withColumn("_base", base), "_base", "_once")
    return numbered(once, "_once", "column").select("key", "column")


def expand_json(
    df: DataFrame,
    payload: str,
    keep: Sequence[str] = (),
    names: dict[str, str] | None = None,
    max_columns: int = 10_000,
) -> DataFrame:
    """One text column per key next to the ``keep`` columns.

    ``names`` (key -> column) is the schema of the result. If it is not given it is
    found with a pass over the payloads; only that column list reaches the driver. More than
    ``max_columns`` keys are refused; ``json_map`` takes payloads with an open set of keys.
    """
    if names is None:
        found = named_keys(json_keys(df, payload), tuple(keep) + RESERVED_NAMES)
        rows = found.limit(max_columns + 1).collect()
        if len(rows) > max_columns:
            raise ValueError(f"more than {max_columns} distinct keys: these are data, not columns")
        names = {r["key"]: r["column"] for r in rows}
    if len(set(names.values())) != len(names):
        raise ValueError("column names are not unique")
    ordered = sorted(names.items(), key=lambda kv: kv[1])
    if len({k.lower() for k in names}) < len(names):
        # keys that differ only in case cannot be told apart as struct fields
        parsed = df.withColumn("_p", F.from_json(payload, "map<string,string>"))
        values = [F.try_element_at("_p", F.lit(k)).alias(c) for k, c in ordered]
    else:
        shape = T.StructType([T.StructField(k, T.StringType()) for k, _ in ordered])
        parsed = df.withColumn("_p", F.from_json(payload, shape))
        values = [F.col("_p").getField(k).alias(c) for k, c in ordered]
    return parsed.select(*keep, *values)

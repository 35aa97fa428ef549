"""Writers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tallymark.operators.catalog import row_counts
from tallymark.operators.joins import not_stored
from tallymark.operators.sets import union_layers


#: Column and folder of a key's bucket.
BUCKET = "key_bucket"
#: Rows of a batch whose hashed keys may be sent to all tasks (some 30 bytes each).
MOST_SENT = 1 << 21


def _sized(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows gathered by partition value into well-sized files; AQE splits a heavy value."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ("year",)) -> None:
    _sized(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def replace(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the whole table, whatever the overwrite mode of the session."""
    writer = _sized(df, partition_by).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def insert_if_absent(
    df: DataFrame, path: str, key: str = "data_hash", partition: str = "year",
    touched: Sequence | None = None, buckets: int = 0, rows: int | None = None,
) -> None:
    """Append the rows whose key is not stored yet, one per key; a null partition is one like others.

    Of the stored rows only the key is read, and with ``touched`` (the partition values the
    batch may hold, such as the years of a run; None for the null one) only those partitions. With ``buckets``
    a partition is laid out in that many folders by a hash of the key (column ``key_bucket``), and only the
    folders are read in which a key of the batch could be; a table keeps the number it was
    begun with. Of up to MOST_SENT ``rows`` (counted if not given) the hashed keys are sent to where the stored ones
    are read, so that only stored keys of the same hash are shuffled, not the whole table for each
    batch. Running it twice stores nothing twice; a table must have one writer at a time.
    """
    fresh, layout = df.dropDuplicates([key]), [partition]
    if buckets:
        fresh, layout = fresh.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")), [partition, BUCKET]
    stored = _stored(df.sparkSession, path)
    if stored is not None:
        if bool(buckets) != (BUCKET in stored.columns):
            raise ValueError(f"{path} is{' not' if buckets else ''} laid out in buckets")
        if touched is not None:
            known = F.col(partition).isin([v for v in touched if v is not None])
            expected = F.coalesce(known, F.lit(False)) | (F.col(partition).isNull() if None in touched else F.lit(False))
            stored = stored.where(expected)
            fresh = fresh.where(F.assert_true(expected, "row outside the touched partitions").isNull())
        if buckets:
            stored = stored.where(F.col(BUCKET).isin([r[0] for r in fresh.select(BUCKET).distinct().collect()]))
        if (df.count() if rows is None else rows) <= MOST_SENT:
            sent = F.broadcast(df.select(F.xxhash64(key).alias("_sent")))
            stored = stored.join(sent, F.xxhash64(F.col(key).cast(df.schema[key].dataType)) == F.col("_sent"), "left_semi")
        fresh = not_stored(fresh, stored, [*layout, key])
    append(fresh, path, layout)


def ndjson(df: DataFrame, path: str) -> None:
    """One JSON object per line; null fields are left out."""
    df.write.mode("overwrite").json(path, ignoreNullFields=True)


def export(df: DataFrame, folder: str, name: str, fmt: str = "csv",
           at: datetime | None = None) -> str:
    """Write as csv, json or parquet under a name with the time in it; gives the path."""
    stamp = (at or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S")
    path = f"{folder}/{name}_{stamp}.{fmt}"
    writer = df.write.mode("errorifexists")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "json":
        writer.json(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return path


def geodata(layers: dict[str, DataFrame], path: str) -> None:
    """The unified polygon table, one partition per layer."""
    replace(union_layers(layers), path, ["layer_type"])


def copy_schema(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Copy every table of one database into another, with format and partitioning, and compare the row counts."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{target}`")
    names = [t.name for t in spark.catalog.listTables(source) if not t.isTemporary]
    for name in names:
        table = f"`{source}`.`{name}`"
        layout = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
        about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
        writer = spark.table(table).write.mode("overwrite").format(about.get("Provider", "parquet"))
        (writer.partitionBy(*layout) if layout else writer).saveAsTable(f"`{target}`.`{name}`")

    def counts(db: str, out: str) -> DataFrame:
        tables = {n: spark.table(f"`{db}`.`{n}`") for n in names}
        return row_counts(tables).select("table_name", F.col("n_rows").alias(out))

    return counts(source, "n_source").join(counts(target, "n_target"), "table_name").withColumn(
        "same", F.col("n_source") == F.col("n_target")
    )


def stored_counts(store: DataFrame) -> DataFrame:
    """Rows of a store per endpoint: what ``ingest_stats`` compares a run with."""
    return store.groupBy("endpoint").agg(F.count(F.lit(1)).alias("n"))


def ingest_stats(seen: DataFrame, before: DataFrame | None, after: DataFrame,
                 endpoints: Sequence[str] = ()) -> DataFrame:
    """Per endpoint: records seen in a run and rows it added to its table.

    ``before`` and ``after`` are ``stored_counts`` of the store. ``endpoints`` lists the endpoints of the
    run, so that those without a record appear too. The row with a null endpoint holds the
    totals of the run; ``n_tables`` counts the tables that got rows.
    """
    spark, zero = seen.sparkSession, F.lit(0)
    named = spark.createDataFrame([(e,) for e in endpoints], "endpoint string")
    seen_n = seen.groupBy("endpoint").agg(F.count(F.lit(1)).alias("n_seen"))
    every = named.unionByName(seen_n.select("endpoint")).distinct()
    out = every.join(seen_n, "endpoint", "left").join(after.withColumnRenamed("n", "_after"), "endpoint", "left")
    if before is not None:
        out = out.join(before.withColumnRenamed("n", "_before"), "endpoint", "left")
    else:
        out = out.withColumn("_before", zero)
    added = F.coalesce("_after", zero) - F.coalesce("_before", zero)
    out = out.select("endpoint", F.coalesce("n_seen", zero).alias("n_seen"), added.cast("bigint").alias("n_inserted"))
    return out.groupingSets([["endpoint"], []], "endpoint").agg(
        F.sum("n_seen").alias("n_seen"), F.sum("n_inserted").alias("n_inserted"),
        F.count_if(F.col("n_inserted") > 0).alias("n_tables"),
    )

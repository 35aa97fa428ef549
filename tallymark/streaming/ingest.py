"""Streaming ingestion of landed records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallymark.sources.writers import insert_if_absent
from tallymark.streaming import batches


def ingest_stream(
    records: DataFrame, target: str, checkpoint: str, key: str = "data_hash",
    partition: str = "year", most_partitions: int = 1000, buckets: int = 0,
) -> StreamingQuery:
    """Store each new record once, by micro-batch, until all landed files are read.

    A batch that is run again after a failure adds nothing, since its hashes are stored. Of the
    store only the partitions are read that the batch holds, and only keys that may be in the batch are shuffled; a batch with more than
    ``most_partitions`` of them is compared with the whole store. With ``buckets`` see ``insert_if_absent``.
    """
    def store(batch: DataFrame, _: int) -> None:
        found = batch.groupBy(F.col(partition)).agg(F.count(F.lit(1))).limit(most_partitions + 1).collect()
        if len(found) <= most_partitions:
            insert_if_absent(batch, target, key, partition, [r[0] for r in found], buckets, sum(r[1] for r in found))
        else:
            insert_if_absent(batch, target, key, partition, None, buckets)

    return (
        records.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_by_state(
    records: DataFrame, target: str, checkpoint: str, key: str = "data_hash", partition: str = "year",
    event_time: str | None = None, horizon: str | None = None,
) -> StreamingQuery:
    """As ``ingest_stream``, with the keys seen so far in the stream's state instead of the store.

    The state is kept by RocksDB on the executors' disks and in the checkpoint, so a batch costs what its own rows
    cost, however large the store is. Each batch writes a folder of its own under its number; one that is run again after a
    failure finds the state as it was before and replaces its folder, also if it had been written but not
    committed. Without a ``horizon`` a key is remembered for ever; with one (such as ``"7 days"``, of the
    ``event_time``) a key that comes again later than that is stored again. Read by ``read_ingested``.
    """
    spark = records.sparkSession
    batches.claim(spark, target, checkpoint)
    if horizon:
        once = records.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark([key])
    else:
        once = records.dropDuplicates([key])

    def store(batch: DataFrame, number: int) -> None:
        # the whole folder is replaced, whatever the overwrite mode of the session
        writer = batch.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy(partition).parquet(f"{target}/batch={number}")

    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        # the query keeps the settings it was started with
        return (
            once.writeStream.foreachBatch(store)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(setting, before)


def read_ingested(spark: SparkSession, target: str) -> DataFrame:
    """The rows stored by ``ingest_by_state``."""
    return batches.rows(spark, target).drop("batch")


def landed_stream(
    spark: SparkSession, folder: str, schema, fmt: str = "parquet", glob: str | None = None,
    files_per_batch: int = 100,
) -> DataFrame:
    """Files of a folder as a stream, a bounded number per micro-batch."""
    reader = (
        spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder)

"""Running totals over ordered rows, without putting a key's rows in one task.

A plain window ``partitionBy(key).orderBy(t)`` sorts all rows of a key in one task.
Here rows are range-partitioned by (key, order), so a heavy key covers many
partitions ("chunks"). A running total is the total inside the chunk plus the
totals of the key's earlier chunks, of which there are at most as many as there
are partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.plans.lineage import settle

SEQ, CHUNK = "_seq", "_chunk"


def _columns(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def ordered_chunks(
    df: DataFrame,
    keys: Sequence[str | Column],
    order_by: Sequence[str | Column],
    partitions: int | None = None,
) -> DataFrame:
    """Add ``_seq`` (increasing along keys, order_by) and ``_chunk`` (its range partition).

    ``order_by`` should be a total order inside the keys; rows equal in all of
    it share a chunk. The result is settled, because range bounds are sampled
    and must not be drawn anew for each branch that reads the rows.
    """
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = _columns(keys) + _columns(order_by)
    numbered = (
        df.repartitionByRange(parts, *by)
        .sortWithinPartitions(*by)
        .withColumn(SEQ, F.monotonically_increasing_id())
    )
    return settle(numbered, "chunks").withColumn(CHUNK, F.shiftright(SEQ, 33))


def _keyed(chunked: DataFrame, keys: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """The rows with ``_key`` and the summed values.

    The key is one non-null struct, so that null key parts match each other in a join.
    """
    key = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(1).alias("one"))
    values = {f"_v_{name}": F.coalesce(expr, F.lit(0)) for name, expr in sums.items()}
    return chunked.withColumns({**values, "_key": key})


def chunk_offsets(
    chunked: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, Column],
    totals: Mapping[str, str] | None = None,
) -> DataFrame:
    """Per key and chunk: the sum inside it (``_c_*``), that of the key's earlier chunks
    (``_o_*``), and the totals of the key. As many rows per key as it has chunks.
    """
    per_chunk = _keyed(chunked, keys, sums).groupBy("_key", CHUNK).agg(
        *[F.sum(f"_v_{n}").alias(f"_c_{n}") for n in sums]
    )
    whole = Window.partitionBy("_key")
    earlier = whole.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return per_chunk.select(
        "*",
        *[F.coalesce(F.sum(f"_c_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in sums],
        *[F.sum(f"_c_{src}").over(whole).alias(out) for out, src in (totals or {}).items()],
    )


def running(
    chunked: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, Column],
    totals: Mapping[str, str] | None = None,
    offsets: DataFrame | None = None,
) -> DataFrame:
    """Add, per key, the sum of each expression over the rows *before* the current one.

    ``keys`` may be longer than the keys the chunks were made with, as long as
    the order is the same. ``totals`` maps an output name to a name in ``sums``
    whose whole-key total is wanted as well. ``offsets`` (from ``chunk_offsets``, with
    rows left out) restricts the result to the chunks it lists.
    """
    totals = totals or {}
    rows = _keyed(chunked, keys, sums)
    if offsets is None:
        offsets = chunk_offsets(chunked, keys, sums, totals)
    else:
        rows = rows.join(offsets.select("_key", CHUNK), ["_key", CHUNK], "left_semi")
    inside = (
        Window.partitionBy("_key", CHUNK)
        .orderBy(SEQ)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = rows.withColumns(
        {f"_l_{n}": F.coalesce(F.sum(f"_v_{n}").over(inside), F.lit(0)) for n in sums}
    )
    joined = local.join(offsets, ["_key", CHUNK])
    return joined.select(
        *[F.col(c) for c in chunked.columns if c not in sums],
        *[(F.col(f"_l_{n}") + F.col(f"_o_{n}")).alias(n) for n in sums],
        *[F.col(out) for out in totals],
    )


def unchunk(df: DataFrame) -> DataFrame:
    """Drop the helper columns."""
    return df.drop(SEQ, CHUNK)

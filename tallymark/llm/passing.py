"""Add columns to rows from their text, in tasks, with the other columns passed through."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm import flat


def add_columns(
    docs: DataFrame, text: str, new: str, work: Callable[[np.ndarray, np.ndarray], list[pa.Array]],
    limit: int = flat.CHUNK_BYTES,
) -> DataFrame:
    """``work(bytes, bounds)`` gives the ``new`` columns (a DDL text) of a chunk of texts.

    Columns of the same names are replaced. A text that is passed through as it is goes to the workers once.
    """
    added = T._parse_datatype_string(new)
    kept = [c for c in docs.columns if c not in added.names]
    source = docs.select(*[F.col(f"`{c}`") for c in kept])
    names = [*kept, *added.names]
    if text in kept and "." not in text and source.schema[text].dataType == T.StringType():
        at = kept.index(text)
    else:
        source, at = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text).cast("string").alias("_text")), len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, bounds in flat.chunks(batch.column(at), limit):
                columns = [batch.column(i).slice(a, b - a) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*columns, *work(data, bounds)], names=names)
        flat.give_back()

    return source.mapInArrow(run, T.StructType([*docs.select(*[f"`{c}`" for c in kept]).schema.fields, *added.fields]))

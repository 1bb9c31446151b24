"""Per-row work on Arrow batches, shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopcube.llm.words import chunks


def map_rows(df: DataFrame, keys: list[str], text: str,
             work: Callable[[pa.Array], dict], schema: str) -> DataFrame:
    """``keys`` of every row of ``df`` beside the columns that ``work`` makes of its text.

    Only the named columns are read, so extra columns of any name are no
    concern.  ``work`` gets a string array (nulls included) of a few MB and
    returns one array for each column of ``schema``.
    """
    source = df.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{text}`").cast("string").alias("__text"))
    fields = [T.StructField(k, df.schema[k].dataType) for k in keys]
    out = T.StructType(fields + list(T.StructType.fromDDL(schema).fields))
    names = [f.name for f in out.fields[len(keys):]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keys))
            for at, part in chunks(texts):
                made = work(part)
                cols = [batch.column(i).slice(at, len(part)) for i in range(len(keys))]
                cols += [c if isinstance(c, pa.Array) else pa.array(c) for c in (made[n] for n in names)]
                yield pa.RecordBatch.from_arrays(cols, names=[*keys, *names])

    return source.mapInArrow(run, out)

"""What the text operators share: reading, Arrow maps of bounded batches, staging."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Rows in one Arrow batch. Texts may be very long, and a Python worker holds a batch whole.
BATCH_ROWS = 512


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Keep the Arrow batches of this session at ``BATCH_ROWS`` rows or fewer."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def map_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: T.StructType) -> DataFrame:
    """``mapInArrow`` over bounded batches."""
    bound_batches(df.sparkSession)
    return df.mapInArrow(function, schema)


def per_text(df: DataFrame, column: Column, make: Callable[[], Callable[[str], tuple]], schema: T.StructType) -> Column:
    """A struct column that a Python function computes from each text.

    ``make`` runs once in each worker and gives the function of one text; a null text is
    passed as the empty one. The function sees one text at a time, so a worker holds one
    batch and one text's working set.
    """
    bound_batches(df.sparkSession)
    arrow = pa.struct([pa.field(f.name, to_arrow_type(f.dataType)) for f in schema])
    names = [f.name for f in schema]

    @F.arrow_udf(schema)
    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        function = make()
        for texts in batches:
            rows = [function(t.as_py() or "") for t in texts]
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
            yield pa.StructArray.from_arrays(
                [pa.array(c, type=arrow.field(i).type) for i, c in enumerate(columns)], fields=list(arrow))

    return each(column)



"""Frames of a handful of rows."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

def few_rows(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A handful of driver-side rows as a local table that needs no Python worker."""
    schema = StructType.fromDDL(ddl)
    columns = [pa.array([row[i] for row in rows], field.type) for i, field in enumerate(to_arrow_schema(schema))]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema.names), schema).coalesce(1)


def side_by_side(*frames: DataFrame) -> DataFrame:
    """One-row frames with different columns as one row: stacked and folded, so that no join is needed."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.agg(*(F.max(c).alias(c) for c in stacked.columns))

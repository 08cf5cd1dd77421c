"""Literal tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def inline_table(spark: SparkSession, columns: dict[str, pa.DataType], rows: list[tuple]) -> DataFrame:
    """A small table given in code. As an Arrow table it becomes a local relation whose size Spark knows."""
    listed = {name: [row[i] for row in rows] for i, name in enumerate(columns)}
    return spark.createDataFrame(pa.table(listed, schema=pa.schema(list(columns.items()))))

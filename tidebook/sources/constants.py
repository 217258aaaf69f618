"""Small Python constants as frames."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def constant_frame(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    """A local relation. Unlike a frame made from a list it has known statistics,
    so the optimizer can see that it is small enough to broadcast.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    arrow_schema = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in arrow_schema]
    arrays = [pa.array(values, field.type) for values, field in zip(columns, arrow_schema)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow_schema), schema=schema)

"""Small tables stated in code."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_TYPES = {
    "string": pa.string(), "int": pa.int32(), "double": pa.float64(), "array<int>": pa.list_(pa.int32()),
    "array<string>": pa.list_(pa.string()),
}


def literal_table(spark: SparkSession, schema: dict[str, str], rows: Sequence[Sequence]) -> DataFrame:
    """A local relation: its exact size is known to the planner, which may broadcast it by its own check."""
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    arrays = [pa.array(values, _TYPES[t]) for values, t in zip(columns, schema.values())]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=list(schema)))

"""Small frames from Python values."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Rows handed over as one Arrow table. Unlike rows sent as Python objects, they become a
    local relation, whose size Catalyst knows and may decide to broadcast by."""
    fields = StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)
    columns = [pa.array([row[i] for row in rows], f.type) for i, f in enumerate(arrow)]
    return spark.createDataFrame(pa.table(columns, schema=arrow), schema=fields)

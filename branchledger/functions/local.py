"""Small configuration tables."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def config_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Rows of a configuration as a local relation.

    Its size is known to the optimizer, so a join broadcasts it only while it is under the
    session's threshold.
    """
    types = StructType.fromDDL(schema)
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in types]
    arrow = to_arrow_schema(types)
    arrays = [pa.array(list(c), f.type) for c, f in zip(columns, arrow, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema=types)

"""A table layout: ordered column names with Spark types."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SPARK_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: Mapping[str, str]

    def schema(self, **extra: str) -> T.StructType:
        return T.StructType(
            [T.StructField(n, SPARK_TYPES[t]) for n, t in {**self.columns, **extra}.items()]
        )

    def empty(self, spark: SparkSession, **extra: str) -> DataFrame:
        return spark.createDataFrame([], self.schema(**extra))

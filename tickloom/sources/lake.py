"""Parquet tables: the lake, the raw table, the candle mart."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tickloom.schema import LAKE_TRADE
from tickloom.sinks.tables import partition_values


def read_table(spark: SparkSession, path: str, schema: StructType, anywhere: bool = False) -> DataFrame:
    """The table's rows under a declared schema; no rows where nothing was written yet.

    Partition columns the schema does not name are left out. Only a missing path counts as
    "nothing yet". Any other failure is raised. ``anywhere`` takes in every file below the path
    whatever folder it is in; without it files beside partition folders are not seen.
    """
    try:
        reader = spark.read.schema(schema).option("recursiveFileLookup", str(anywhere).lower())
        return reader.parquet(path).select(*schema.fieldNames())
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    """All trades of a lake, whether its writers put files into the root, into batch folders or both."""
    return read_table(spark, path, LAKE_TRADE, anywhere=True)


def read_days(spark: SparkSession, path: str, schema: StructType, days: list[str], by: str = "insert_date") -> DataFrame:
    """The rows of these days; only their folders are listed. Days the table does not have are left out."""
    there = set(partition_values(spark, path, by)) if days else set()
    folders = [f"{path}/{by}={d}" for d in days if d in there]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*schema.fieldNames())


def partitioned(schema: StructType, name: str, kind: str = "date") -> StructType:
    """The schema with a partition column added."""
    return StructType(list(schema.fields)).add(name, kind)

"""CSV sources, JSON and Parquet sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str, day_format: str = "yyyy-MM-dd") -> DataFrame:
    """A CSV file or folder with a header, read by a given schema: nothing is inferred, a row that doesn't fit is an error."""
    return spark.read.csv(path, schema=schema, header=True, dateFormat=day_format, mode="FAILFAST", enforceSchema=False)


def write_json(df: DataFrame, path: str) -> None:
    """Report rows as JSON lines."""
    df.write.mode("overwrite").json(path)


def write_features(df: DataFrame, path: str, by: str | None = None) -> None:
    """Parquet, split by a column that readers filter on."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(path)

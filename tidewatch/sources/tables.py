"""Catalog tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def shape(schema: StructType) -> list[tuple[str, str]]:
    """Column names and types, nullability left out."""
    return [(field.name, field.dataType.simpleString()) for field in schema.fields]


def require_same_schema(stored: StructType, written: StructType, name: str) -> None:
    if shape(stored) != shape(written):
        raise ValueError(f"schema of {name} may not change: {shape(stored)} -> {shape(written)}")


def write_table(
    df: DataFrame,
    name: str,
    format: str = "parquet",
    same_schema: bool = False,
    path: str | None = None,
    bucket_by: list[str] | None = None,
    buckets: int = 200,
) -> None:
    """Replace a table. Its schema may change unless `same_schema` is set.

    `bucket_by`: columns by whose hash the rows are dealt into `buckets` files a
    task, sorted. Tables in equal buckets of the columns of a join or merge meet
    without a shuffle, if they are read by name: the catalog knows the buckets.
    """
    spark = df.sparkSession
    if same_schema and table_exists(spark, name):
        require_same_schema(read_table(spark, name).schema, df.schema, name)
    writer = df.write.format(format).mode("overwrite").option("overwriteSchema", not same_schema)
    if bucket_by:
        # One task per bucket, so that a bucket is one file.
        writer = df.repartition(buckets, *bucket_by).write.format(format).mode("overwrite")
        writer = writer.option("overwriteSchema", not same_schema).bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")

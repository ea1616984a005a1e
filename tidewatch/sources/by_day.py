"""Tables laid out by time: a folder per day, sorted by time inside.

A cutoff or a high-water mark then skips the folders of earlier days without
opening a file, and the row groups of its own day by their statistics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.newest import Posts

DAY = "day"
SECONDS = 86_400


def day_of(time: Column) -> Column:
    """Whole days since 1970 of a time in seconds; null for null."""
    return F.floor(time / SECONDS).cast("int")


def write_by_day(df: DataFrame, path: str, time: str, files: int = 200, mode: str = "overwrite") -> None:
    """Store `df` in folders by the day of its column `time`.

    Rows are dealt to `files` tasks by ranges of time, so a day with a large
    share of all rows is written by many tasks, and a quiet day by one.
    """
    placed = df.withColumn(DAY, day_of(F.col(time)))
    ranged = placed.repartitionByRange(files, DAY, time).sortWithinPartitions(DAY, time)
    ranged.write.mode(mode).partitionBy(DAY).parquet(path)


def read_newer(spark: SparkSession, path: str, time: str, after: float | DataFrame | None) -> DataFrame:
    """The rows stored by `write_by_day` whose time is later than `after`, a
    number or a frame of one (a high-water mark); null times are never later.

    A mark is looked up first, as the folders to read are chosen by its value.
    None reads everything; a mark that is null reads nothing.
    """
    df = spark.read.parquet(path)
    if after is None:
        return df.drop(DAY)
    if isinstance(after, DataFrame):
        after = after.first()[0]
    mark = F.lit(after).cast("double")
    return df.where((F.col(DAY) >= day_of(mark)) & (F.col(time) > mark)).drop(DAY)


def newer_posts(spark: SparkSession, path: str, after: float | DataFrame | None = None) -> Posts:
    """Posts stored by day, those after a time only."""
    return Posts.of(read_newer(spark, path, "created_utc", after))

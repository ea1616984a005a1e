"""The newest k rows of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.session import cut

# Up to this many rows a top-k is one ordered take.
MAX_TAKE = 10_000


def with_rank(df: DataFrame, order: list[Column], out: str = "_rank") -> DataFrame:
    """`df` in order, with the place of each row from 0.

    The rows are sorted across the cluster and written; the rows before each
    partition are then counted. No task sees more than its partition.
    """
    place = F.monotonically_increasing_id()
    rows = cut(df.orderBy(*order).withColumn("_place", place))
    part, local = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # One row per partition of the sort.
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = F.broadcast(sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before")))
    ranked = rows.withColumn("_part", part).join(starts, "_part")
    return ranked.withColumn(out, F.col("_before") + local).drop("_part", "_place", "_before")


def newest_k(
    df: DataFrame,
    k: int,
    time: str = "time_utc",
    ties: tuple[str, ...] = ("id",),
    max_take: int = MAX_TAKE,
    seconds: int = 3600,
) -> DataFrame:
    """The `k` rows with the latest `time`, smaller `ties` first among equals.

    A small k is one ordered take. For a large k the rows are counted per hour
    to find the hour in which the k-th row lies. Newer hours are kept whole,
    wherever they are, and only that hour is ranked, by a sort across the
    cluster. The result is in order. `df` should be a stored table, as it is
    read more than once.
    """
    order = [F.col(time).desc(), *[F.col(t).asc() for t in ties]]
    if k <= max_take:
        return df.orderBy(*order).limit(k)

    bucket = F.floor(F.col(time) / seconds)
    # At most one row per hour of history.
    counts = df.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    running = F.sum("n").over(Window.orderBy(F.col("bucket").desc()))
    edge = (
        counts.withColumn("upto", running).where(F.col("upto") >= k).orderBy(F.col("upto").asc()).first()
    )
    if edge is None:
        return df.orderBy(*order)
    if edge["bucket"] is None:
        newer = df.where(bucket.isNotNull())
    else:
        newer = df.where(bucket > edge["bucket"])
    inside = df.where(bucket.eqNullSafe(F.lit(edge["bucket"])))
    rest = k - (edge["upto"] - edge["n"])
    inside = with_rank(inside, order).where(F.col("_rank") < rest).select(*df.columns)
    return newer.unionAll(inside).orderBy(*order)

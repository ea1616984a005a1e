"""The incremental match as a Structured Streaming job.

New post files are matched as they arrive and merged by (id, key). The merge
makes a batch that runs twice, after a failure, change nothing the second
time. The newest-N limit of the batch run does not apply: each micro-batch is
bounded by what arrived.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from tidewatch import schemas
from tidewatch.operators.match import match_posts
from tidewatch.operators.newest import Posts
from tidewatch.plans.bronze import MERGE_KEYS
from tidewatch.sources.snapshots import SnapshotTables
from tidewatch.sources.watchlist import WatchList


def read_post_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Post files as a stream, at most `max_files` per micro-batch."""
    return spark.readStream.schema(schemas.POSTS).option("maxFilesPerTrigger", max_files).parquet(path)


def _one_per_post(batch: DataFrame) -> DataFrame:
    """Of a post that arrived more than once, the version with most comments.

    Ties go to the smaller hash of the text, so no text is compared."""
    latest = Window.partitionBy("id").orderBy(F.col("num_comments").desc(), F.xxhash64("title", "selftext"))
    return batch.withColumn("_rank", F.row_number().over(latest)).where("_rank = 1").drop("_rank")


def follow_posts(
    posts: DataFrame,
    tables: SnapshotTables,
    table: str,
    watch: WatchList,
    cutoff: float,
    checkpoint: str,
) -> StreamingQuery:
    """Match what has arrived since the last call, then stop."""

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        staging = f"{table}_batch"
        matched = match_posts(Posts.of(_one_per_post(batch)), watch, None, cutoff)
        tables.overwrite(matched, staging)
        arrived = tables.read(staging)
        if not tables.exists(table):
            tables.overwrite(arrived, table)
        else:
            bound = arrived.count()
            if bound:
                tables.merge(arrived, table, MERGE_KEYS, max_source=bound)
        tables.drop(staging)

    return (
        posts.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

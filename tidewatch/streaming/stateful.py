"""The match as a stream that remembers what it has found.

Posts arrive late, out of order and more than once. The state store keeps each
(post, keyword) found until the watermark has passed its time by the delay, so a
match is handed on once although its post comes again; what comes later than the
delay allows is dropped. The state is as large as the matches of one delay,
whatever the stream's age. Posts are matched where they are read; only matches
are shuffled, by (id, key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.operators.match import MAX_AUTOMATON_BYTES, as_submissions, match_keywords
from tidewatch.plans.bronze import CUTOFF, MERGE_KEYS
from tidewatch.sources.watchlist import WatchList

DELAY = "2 days"


def match_stream(posts: DataFrame, watch: WatchList, cutoff: float = CUTOFF, delay: str = DELAY) -> DataFrame:
    """Bronze submissions of a stream of posts, one row per (post, keyword).

    The newest-N limit does not apply: a stream has no last post. A keyword given
    twice counts once. The watch list must be one that can be broadcast.
    """
    if not watch.keyword_size.broadcastable or watch.keyword_size.bytes > MAX_AUTOMATON_BYTES:
        raise ValueError("a stream is matched in place, which takes a shorter keyword list")
    names = F.broadcast(watch.subreddits.withColumnRenamed("subreddits", "subreddit_name").distinct())
    timed = posts.where(F.col("created_utc") > F.lit(float(cutoff))).withColumn(
        "_event_time", F.timestamp_seconds("created_utc")
    )
    watched = timed.withWatermark("_event_time", delay).join(names, "subreddit_name", "left_semi")
    found = match_keywords(watched, ["title", "selftext"], watch, "key", ["id"])
    once = found.dropDuplicatesWithinWatermark(MERGE_KEYS)
    return as_submissions(once)


def follow_matches(
    posts: DataFrame,
    watch: WatchList,
    path: str,
    checkpoint: str,
    cutoff: float = CUTOFF,
    delay: str = DELAY,
) -> StreamingQuery:
    """Add the matches of what has arrived since the last call to the Parquet
    table at `path`, then stop. State and progress are kept at `checkpoint`."""
    return (
        match_stream(posts, watch, cutoff, delay)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

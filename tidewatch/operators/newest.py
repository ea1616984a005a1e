"""The newest N posts of each watched community."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.sizes import MAX_BROADCAST_ROWS, broadcast_if
from tidewatch.sources.watchlist import WatchList

# Posts considered per community: for post matching and for comment matching.
POSTS_PER_SUBREDDIT = 500
COMMENT_POSTS_PER_SUBREDDIT = 200
# Width of the time spans in which posts are counted to find the newest N.
SPAN_SECONDS = 86_400

INDEX_COLUMNS = ("subreddit_name", "id", "created_utc", "num_comments", "upvote_ratio")
CONTENT_COLUMNS = ("id", "title", "selftext", "permalink")


@dataclass(frozen=True)
class Posts:
    """Posts as a narrow index and their text, both keyed by a unique `id`.

    Ranking reads only the index. Text is read once, for the posts that were
    chosen, and is never shuffled to be ranked.
    """

    index: DataFrame
    content: DataFrame
    whole: DataFrame | None = None  # both in one table, if they come from one

    @classmethod
    def of(cls, posts: DataFrame) -> Posts:
        """Both halves of one table. Parquet reads only the columns asked for."""
        return cls(posts.select(*INDEX_COLUMNS), posts.select(*CONTENT_COLUMNS, "created_utc"), posts)

    def newer_than(self, after: float | Column | None) -> Posts:
        """Posts created strictly after `after`, which may be a scalar subquery.

        Because the newest posts come first, this filter gives the same result
        before the newest-N limit as after it, so it reaches the scan.
        """
        if after is None:
            return self
        bound = after if isinstance(after, Column) else F.lit(float(after))
        newer = F.col("created_utc") > bound
        has_time = "created_utc" in self.content.columns
        return Posts(
            self.index.where(newer),
            self.content.where(newer) if has_time else self.content,
            self.whole.where(newer) if self.whole is not None else None,
        )


def _bounds(posts: Posts, watch: WatchList, n: int, span_seconds: int) -> DataFrame:
    """(subreddit_name, first_span): the span in which a watched community's n-th
    newest post lies, NULL if it has fewer."""
    names = watch.subreddits.select(F.col("subreddits").alias("subreddit_name"))
    span = F.floor(F.col("created_utc") / span_seconds)
    counts = (
        posts.index.join(broadcast_if(names, watch.n_subreddits), "subreddit_name", "left_semi")
        .groupBy("subreddit_name", span.alias("span"))
        .agg(F.count("*").alias("n"))
    )
    newest_first = Window.partitionBy("subreddit_name").orderBy(F.col("span").desc())
    return (
        counts.withColumn("upto", F.sum("n").over(newest_first))
        .groupBy("subreddit_name")
        .agg(F.max(F.when(F.col("upto") >= n, F.col("span"))).alias("first_span"))
    )


def newest_index(
    posts: Posts, watch: WatchList, n: int | None, span_seconds: int = SPAN_SECONDS
) -> DataFrame:
    """Index rows of the newest `n` posts per watched community; all if None.

    Ties go to the smaller id. Posts are first counted per community and span
    of time, which combines before the shuffle however large one community
    is. The counts tell the span in which a community's n-th newest post
    lies, and only posts from that span on are ranked.
    """
    names = watch.subreddits.select(F.col("subreddits").alias("subreddit_name"))
    watched = broadcast_if(names, watch.n_subreddits)
    if n is None:
        return posts.index.join(watched, "subreddit_name", "left_semi")

    span = F.floor(F.col("created_utc") / span_seconds)
    bounds = _bounds(posts, watch, n, span_seconds)
    recent = posts.index.join(broadcast_if(bounds, watch.n_subreddits), "subreddit_name").where(
        F.col("first_span").isNull() | (span >= F.col("first_span"))
    )
    order = Window.partitionBy("subreddit_name").orderBy(F.col("created_utc").desc(), F.col("id").asc())
    return (
        recent.withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= n)
        .select(*posts.index.columns)
    )


def newest_posts(
    posts: Posts, watch: WatchList, n: int | None, span_seconds: int = SPAN_SECONDS
) -> DataFrame:
    """Full rows of the newest `n` posts per watched community.

    A community listed twice gives its posts twice, as two visits would. Where
    the posts are one table and too many communities are watched to broadcast
    the posts' ids, only the text of posts that may be among the newest leaves
    the scan; without a limit the table is read once.
    """
    names = watch.subreddits.select(F.col("subreddits").alias("subreddit_name"))
    watched = broadcast_if(names, watch.n_subreddits)
    if n is None and posts.whole is not None:
        columns = [*CONTENT_COLUMNS, *(c for c in INDEX_COLUMNS if c != "id")]
        return posts.whole.select(*columns).join(watched, "subreddit_name").select(*columns)
    index = newest_index(posts, watch, n, span_seconds)
    index = index.join(watched, "subreddit_name")
    content = posts.content.drop("created_utc")
    bound = watch.post_bound(n)
    if n is not None and posts.whole is not None and bound > MAX_BROADCAST_ROWS:
        span = F.floor(F.col("created_utc") / span_seconds)
        bounds = broadcast_if(_bounds(posts, watch, n, span_seconds), watch.n_subreddits)
        recent = posts.whole.join(bounds, "subreddit_name")
        recent = recent.where(F.col("first_span").isNull() | (span >= F.col("first_span")))
        content = recent.select(*CONTENT_COLUMNS)
    return content.join(broadcast_if(index, bound), "id")

"""Bronze: matched posts and their comments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tidewatch.operators import comments as comment_ops
from tidewatch.operators.match import high_water_mark, match_posts
from tidewatch.operators.newest import (
    COMMENT_POSTS_PER_SUBREDDIT,
    POSTS_PER_SUBREDDIT,
    Posts,
    newest_index,
)
from tidewatch.sizes import broadcast_if
from tidewatch.sources.watchlist import WatchList

# Fixed value: posts and comments up to this time (2025-01-01 UTC) are skipped.
CUTOFF = 1735689600
MERGE_KEYS = ["id", "key"]


def submissions_full(
    posts: Posts, watch: WatchList, cutoff: float = CUTOFF, n: int | None = POSTS_PER_SUBREDDIT
) -> DataFrame:
    """All matches among the newest posts."""
    return match_posts(posts, watch, n, cutoff)


def submissions_incremental(
    posts: Posts,
    watch: WatchList,
    stored: DataFrame,
    n: int | None = POSTS_PER_SUBREDDIT,
) -> DataFrame:
    """Matches newer than every stored one. None if nothing is stored."""
    latest: Column = high_water_mark(stored).scalar()
    return match_posts(posts, watch, n, latest)


def comments_indirect(
    posts: Posts,
    comments: DataFrame,
    watch: WatchList,
    cutoff: float = CUTOFF,
    n: int | None = COMMENT_POSTS_PER_SUBREDDIT,
) -> DataFrame:
    """Keyword matches among the comments of the newest posts. The posts'
    text is not read, nor need the post itself match or be recent."""
    listed = newest_index(posts, watch, n)
    names = watch.subreddits.withColumnRenamed("subreddits", "subreddit_name")
    visited = listed.join(broadcast_if(names, watch.n_subreddits), "subreddit_name")
    return comment_ops.comments_indirect(visited, comments, watch, cutoff, watch.post_bound(n))

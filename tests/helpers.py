"""Small fixtures and plan inspection."""

from __future__ import annotations

import random

from tidewatch import schemas
from tidewatch.operators.newest import Posts
from tidewatch.sources.watchlist import WatchList


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def watch_list(spark, subreddits, keywords) -> WatchList:
    return WatchList.of(
        spark.createDataFrame([(s,) for s in subreddits], schemas.SUBREDDITS),
        spark.createDataFrame([(k,) for k in keywords], schemas.KEYWORDS),
    )


def post(id, subreddit="a", title="", body="", at=100.0, permalink=None, n=0, ratio=0.5):
    return (subreddit, id, title, permalink or f"/r/{subreddit}/{id}/", n, body, at, ratio)


def posts_frame(spark, posts, partitions=3):
    return spark.createDataFrame(posts, schemas.POSTS).repartition(partitions)


def posts_of(spark, posts, partitions=3) -> Posts:
    return Posts.of(posts_frame(spark, posts, partitions))


def comments_frame(spark, comments):
    return spark.createDataFrame(comments, schemas.RAW_COMMENTS)


def bronze_comments(spark, comments):
    return spark.createDataFrame(comments, schemas.COMMENTS)


WORDS = ["Alpha", "beta", "gamma", "station", "über", "Ünder", "the", "a", "x", "日本語", "naïve"]


def random_text(rng: random.Random, most: int = 12) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, most)))


def brute_matches(posts, subreddits, keywords, n, after):
    """The nested loops: per community and keyword, over the newest n posts."""
    found = []
    for subreddit in subreddits:
        listed = sorted(
            (p for p in posts if p[0] == subreddit),
            key=lambda p: (p[6] is None, -(p[6] or 0), p[1]),
        )
        for keyword in keywords:
            for p in listed if n is None else listed[:n]:
                texts = [t for t in (p[2], p[5]) if t is not None]
                if keyword is None or p[6] is None or p[6] <= after:
                    continue
                if any(keyword.lower() in t.lower() for t in texts):
                    found.append((subreddit, keyword, p[1]))
    return sorted(found, key=repr)

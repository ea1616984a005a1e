"""Gold: silver with sentiment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.sentiment import with_sentiment


def gold_comments(comments: DataFrame, lexicon: DataFrame) -> DataFrame:
    return with_sentiment(comments, ["comment_id"], "comment_body", lexicon, "comment_sentiment")


def gold_submissions(submissions: DataFrame, lexicon: DataFrame) -> DataFrame:
    return with_sentiment(submissions, ["id", "key"], "post_title", lexicon, "title_sentiment")


def as_stored(df: DataFrame) -> DataFrame:
    """Sentiment as `float`, the type of the stored tables."""
    names = [c for c in df.columns if c.endswith("_sentiment")]
    return df.withColumns({c: F.col(c).cast("float") for c in names})

"""The given tables seen as posts, comments, watch lists and a word list.

`documents` are the posts, timed by the event of the same number. The
conversations are the comments; conversation 0 belongs to the newest post,
1 to the one before, and so on. `oracle.py` states the same views in SQL.
"""

from __future__ import annotations

from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.newest import Posts
from tidewatch.sources.watchlist import WatchList

CUTOFF = 1704153600  # 2024-01-02 UTC
FIRST_RUN = 1704304800  # 2024-01-03 18:00 UTC: what an earlier run could see
SUBREDDITS = [*(f"src{i}" for i in range(20)), "nosuch"]
KEYWORDS = ["The", "tion", "EAU", "über"]
LEXICON = {"the": 0.1, "is": 2.5, "was": -4.0, "not": -0.2, "la": 0.3, "und": -0.3}
# Words that change the next one: whether they negate it, and by what factor they strengthen it.
MODIFIERS = {"in": (True, None), "of": (False, 1.5), "de": (True, 2.0), "en": (False, 0.5)}

# Stated so that no job has to run to look the schemas up.
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "labels": "doc_id bigint, quality int, toxic int",
}


def epoch_seconds(ts: Column) -> Column:
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", start, ts).cast("double")


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def literal(self, **columns: list) -> DataFrame:
        """A few literal rows, which the optimizer sees as such."""
        return self.spark.createDataFrame(pa.table(columns))

    @cached_property
    def documents(self) -> DataFrame:
        return self.table("documents")

    @cached_property
    def conversations(self) -> DataFrame:
        last = self.documents.agg(F.max("doc_id")).scalar()
        return self.table("conversations").withColumn("doc_id", last - F.col("conv_id"))

    @cached_property
    def times(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_id").alias("doc_id"), epoch_seconds(F.col("ts")).alias("created_utc")
        )

    @cached_property
    def index(self) -> DataFrame:
        """Every post, narrow columns only (and `doc_id`)."""
        sizes = self.conversations.groupBy("doc_id").agg(F.count("*").cast("int").alias("num_comments"))
        return (
            self.documents.select("doc_id", "source")
            .join(self.times, "doc_id")
            .join(sizes, "doc_id", "left")
            .select(
                F.col("source").alias("subreddit_name"),
                F.col("doc_id").cast("string").alias("id"),
                "created_utc",
                F.coalesce("num_comments", F.lit(0)).alias("num_comments"),
                (F.col("doc_id") % 101 / F.lit(100.0)).alias("upvote_ratio"),
                "doc_id",
            )
        )

    @staticmethod
    def permalink(source: Column, doc_id: Column) -> Column:
        return F.concat(F.lit("/r/"), source, F.lit("/comments/"), doc_id.cast("string"), F.lit("/"))

    @cached_property
    def content(self) -> DataFrame:
        """Every post's text."""
        return self.documents.select(
            F.col("doc_id").cast("string").alias("id"),
            F.substring_index("text", "\n", 1).alias("title"),
            F.col("text").alias("selftext"),
            self.permalink(F.col("source"), F.col("doc_id")).alias("permalink"),
        )

    def posts(self, until: float | None = None) -> Posts:
        index = self.index.drop("doc_id")
        if until is not None:
            index = index.where(F.col("created_utc") <= until)
        return Posts(index, self.content)

    def wide_posts(self) -> DataFrame:
        """Posts as one table."""
        return self.content.join(self.index.drop("doc_id"), "id")

    def comments(self, until: float | None = None) -> DataFrame:
        turn = F.col("turn")
        mark = F.col("conv_id") + turn
        comments = (
            self.conversations.join(self.documents.select("doc_id", "source"), "doc_id")
            .join(self.times, "doc_id")
            .select(
                F.col("doc_id").cast("string").alias("submission_id"),
                F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("_"), turn.cast("string")).alias(
                    "comment_id"
                ),
                # The tables hold no removed and no NULL texts; some are made here.
                F.when(mark % 11 == 0, "[deleted]").when(mark % 13 != 0, F.col("text")).alias("body"),
                (turn - 2).cast("int").alias("score"),
                F.concat(
                    self.permalink(F.col("source"), F.col("doc_id")), turn.cast("string"), F.lit("/")
                ).alias("permalink"),
                (F.col("created_utc") + (turn + 1) * F.lit(1800.0)).alias("created_utc"),
            )
        )
        return comments if until is None else comments.where(F.col("created_utc") <= until)

    @cached_property
    def subreddits(self) -> DataFrame:
        return self.literal(subreddits=SUBREDDITS)

    @cached_property
    def keywords(self) -> DataFrame:
        return self.literal(keywords=KEYWORDS)

    @cached_property
    def watch(self) -> WatchList:
        return WatchList.of(self.subreddits, self.keywords)

    @cached_property
    def lexicon(self) -> DataFrame:
        return self.literal(word=list(LEXICON), polarity=list(LEXICON.values()))

    @cached_property
    def emails(self) -> DataFrame:
        """One address per event, as a recipient list with many copies."""
        user = F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.org"))
        return self.table("events").select(user.alias("_c0"))

"""Comments of matched posts, keyword matches among comments, cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.functions.text import not_deleted
from tidewatch.operators.match import match_keywords
from tidewatch.session import cut
from tidewatch.sizes import MAX_BROADCAST_ROWS, broadcast_if
from tidewatch.sources.watchlist import WatchList

# Fixed value: the keyword of comments taken along with a matched post.
NO_KEYWORD = "N/A"
# Bits of the bitmap of ids; as 64-bit words a quarter of a million rows, 6 MB.
BITMAP_BITS = 1 << 24


def _bronze_comments(df: DataFrame, keyword: Column) -> DataFrame:
    return df.select(
        "submission_id",
        "comment_id",
        keyword.alias("keyword"),
        F.col("body").alias("comment_body"),
        "score",
        "permalink",
        F.col("created_utc").alias("time_utc"),
    )


def among(df: DataFrame, wanted: DataFrame, column: str, bits: int = BITMAP_BITS) -> DataFrame:
    """The rows of `df` whose `column` may be among that of `wanted`, and few others.

    The hashes of the wanted values set bits of a bitmap, kept as words of 64
    bits: at most bits / 64 rows, so it is broadcast whatever it is made from.
    A row whose bit is not set is left out where it is read. Of rows that are
    not wanted about (wanted values / bits) pass.
    """
    slot = F.pmod(F.xxhash64(column), F.lit(bits))
    word, bit = F.shiftright(slot, 6), (slot % 64).cast("int")
    one = F.lit(1).cast("bigint")
    words = wanted.where(F.col(column).isNotNull()).groupBy(word.alias("_word")).agg(
        F.bit_or(F.call_function("shiftleft", one, bit)).alias("_bits")
    )
    tested = df.where(F.col(column).isNotNull()).withColumn("_word", word).join(F.broadcast(words), "_word")
    set_ = F.call_function("shiftrightunsigned", F.col("_bits"), bit).bitwiseAND(one) == 1
    return tested.where(set_).select(*df.columns)


def comments_direct(
    submissions: DataFrame, comments: DataFrame, max_posts: int | None = None, buckets_meet: bool = False
) -> DataFrame:
    """Every comment of each submissions row; a post stored under two keywords
    gives its comments twice.

    Only post ids and how often each is stored leave the submissions.
    `max_posts`, a proven bound on the ids, lets them be broadcast, so a post
    with a large share of all comments stays spread over the scan's tasks.
    Without it AQE splits such a post, and a bitmap of the ids, of fixed size,
    keeps most comments of other posts out of the shuffle. `buckets_meet` leaves
    the bitmap out, for tables that need no shuffle.
    """
    stored = submissions.groupBy(F.col("id").alias("submission_id")).agg(F.count("*").alias("_copies"))
    if not buckets_meet and (max_posts is None or max_posts > MAX_BROADCAST_ROWS):
        stored = cut(stored)  # ids alone, read twice
        comments = among(comments, stored, "submission_id")
    joined = comments.join(broadcast_if(stored, max_posts), "submission_id")
    copies = F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))
    return _bronze_comments(joined.withColumn("_copy", F.explode(copies)), F.lit(NO_KEYWORD))


def comments_indirect(
    posts: DataFrame,
    comments: DataFrame,
    watch: WatchList,
    cutoff: float,
    max_posts: int | None = None,
) -> DataFrame:
    """Comments newer than `cutoff` under the given posts that contain a
    keyword, one row per (comment, keyword)."""
    ids = posts.select(F.col("id").alias("submission_id"))
    recent = comments.where(F.col("created_utc") > F.lit(float(cutoff)))
    under = recent.join(broadcast_if(ids, max_posts), "submission_id")
    matched = match_keywords(under, ["body"], watch, "keyword", ["comment_id"])
    return _bronze_comments(matched, F.col("keyword"))


def union_comments(direct: DataFrame, indirect: DataFrame) -> DataFrame:
    return direct.unionByName(indirect)


def dedup_comments(comments: DataFrame) -> DataFrame:
    """One row per comment: the newest, a keyword match before "N/A", then the
    smallest keyword, then the highest score.

    Keeping the first row of a group is pushed below the shuffle, so each task
    sends at most one copy of a comment.
    """
    order = Window.partitionBy("comment_id").orderBy(
        F.col("time_utc").desc(),
        F.when(F.col("keyword") == NO_KEYWORD, 1).otherwise(0),
        F.col("keyword"),
        F.col("score").desc(),
    )
    return comments.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def drop_deleted(comments: DataFrame) -> DataFrame:
    return comments.where(not_deleted(F.col("comment_body")))

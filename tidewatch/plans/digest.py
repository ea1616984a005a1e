"""The digest of a run as a table. Nothing is sent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import escape_html
from tidewatch.operators.topk import newest_k, with_rank

SUBJECT = "Watch list news"
SEPARATOR = "<br>"

# Lines a digest page holds, whatever the length of the digest.
PAGE_LINES = 1000


def digest_lines(posts: DataFrame, n_posts: int, comments: DataFrame, n_comments: int) -> DataFrame:
    """(section, time_utc, tie, line): the newest titles and bodies, escaped."""

    def section(df: DataFrame, name: int, text: str, ties: tuple[str, ...], k: int) -> DataFrame:
        chosen = newest_k(df.select(text, "time_utc", *ties), k, ties=ties)
        return chosen.select(
            F.lit(name).alias("section"),
            F.col("time_utc"),
            F.concat_ws("\x00", *ties).alias("tie"),
            F.coalesce(escape_html(F.col(text)), F.lit("")).alias("line"),
        )

    return section(posts, 0, "post_title", ("id", "key"), n_posts).unionAll(
        section(comments, 1, "comment_body", ("comment_id", "keyword"), n_comments)
    )


def _joined(section: int) -> Column:
    """The lines of a section, newest first, as one text."""
    entry = F.struct(
        F.col("time_utc").isNull().alias("untimed"),
        (-F.col("time_utc")).alias("age"),
        F.col("tie"),
        F.col("line"),
    )
    entries = F.array_sort(F.collect_list(F.when(F.col("section") == section, entry)))
    return F.array_join(F.transform(entries, lambda e: e["line"]), SEPARATOR)


def digest_html(
    kind: str, recipient: Column, n_posts: Column, n_comments: Column, posts: Column, comments: Column,
    report_url: str | None = None,
) -> Column:
    """The message text; `kind` is update or first. `report_url` adds a link."""
    opening = [F.lit("<p>This is the first digest of your watch list.</p>")]
    if kind == "update":
        opening = [
            F.lit("<p>Since the last digest: "), n_posts.cast("string"), F.lit(" posts, "),
            n_comments.cast("string"), F.lit(" comments.</p>"),
        ]
    link = [F.lit(f'<p><a href="{report_url}">Report</a></p>')] if report_url else []
    return F.concat(
        F.lit("<p>To "), escape_html(recipient), F.lit("</p>"),
        *opening,
        F.lit("<h4>Posts</h4>"), posts, F.lit("<h4>Comments</h4>"), comments,
        *link,
    )


def digest(
    kind: str,
    recipient: DataFrame,
    posts: DataFrame,
    n_posts: int,
    comments: DataFrame,
    n_comments: int,
    page_lines: int = PAGE_LINES,
    report_url: str | None = None,
) -> DataFrame:
    """(recipient, subject, page, html, post_count, comment_count).

    Line r, counted from 0 in reading order, is on page r div `page_lines`, so a
    task gathers no more than a page. A digest without lines is one empty page.
    """
    lines = digest_lines(posts, n_posts, comments, n_comments)
    order = [F.col("section"), F.col("time_utc").desc(), F.col("tie")]
    page = F.floor(F.col("_rank") / page_lines).cast("bigint")
    paged = with_rank(lines, order).select(page.alias("page"), *lines.columns)
    first = lines.sparkSession.range(1).select(
        F.lit(0).cast("bigint").alias("page"), F.lit(-1).alias("section"),
        *[F.lit(None).cast(lines.schema[c].dataType).alias(c) for c in ("time_utc", "tie", "line")],
    )
    texts = [_joined(0).alias("posts"), _joined(1).alias("comments")]
    pages = paged.unionByName(first).groupBy("page").agg(*texts)
    to = recipient.select("recipient").scalar()
    counted = pages.select(
        to.alias("recipient"),
        "page",
        "posts",
        "comments",
        F.lit(n_posts).cast("bigint").alias("post_count"),
        F.lit(n_comments).cast("bigint").alias("comment_count"),
    )
    html = digest_html(
        kind, *[F.col(c) for c in ("recipient", "post_count", "comment_count", "posts", "comments")],
        report_url=report_url,
    )
    return counted.select(
        "recipient", F.lit(SUBJECT).alias("subject"), "page", html.alias("html"), "post_count", "comment_count"
    )

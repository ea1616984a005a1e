"""Keyword matching: which texts contain which watched keywords.

A keyword matches when it occurs anywhere in a text, case folded. Short lists
are broadcast and tested one by one. Longer ones become one automaton, broadcast
behind a size check, that reads every text once, where it is scanned: no text is
shuffled. Beyond that size, texts and keywords meet by an equi-join on a short
character sequence both contain, and each meeting is then verified. All ways
give the same rows.
"""

from __future__ import annotations

import uuid
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.newest import Posts, newest_posts
from tidewatch.sizes import broadcast_if
from tidewatch.sources.watchlist import SEQUENCE, WatchList

# Up to this many keywords are tested one by one on each text.
MAX_TESTED_KEYWORDS = 700
# An automaton takes about 60 bytes for every byte of its keywords, at most.
MAX_AUTOMATON_BYTES = 4 * 1024 * 1024


def _any_contains(texts: list[Column], keyword: Column) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(t, keyword) for t in texts])


def match_keywords(
    df: DataFrame,
    texts: list[str],
    watch: WatchList,
    out: str,
    row_key: list[str],
    max_tested: int = MAX_TESTED_KEYWORDS,
    max_automaton: int = MAX_AUTOMATON_BYTES,
) -> DataFrame:
    """`df` once per keyword found in any of the columns `texts`, with the
    keyword in column `out`. `row_key` names a unique key of `df`."""
    size = watch.keyword_size
    if size.broadcastable and size.rows <= max_tested:
        return _match_broadcast(df, texts, watch.keywords, out)
    if size.broadcastable and size.bytes <= max_automaton:
        return _match_by_automaton(df, texts, watch.keywords, out)
    if watch.short_keywords > max_tested:
        return _match_by_sequence(df, texts, watch, watch.keywords, range(SEQUENCE + 1), out, row_key)
    # Short keywords are few: test those, look up the others.
    short = F.length(F.lower("keywords")) < SEQUENCE
    sizes = range(SEQUENCE, SEQUENCE + 1)
    found = _match_by_sequence(df, texts, watch, watch.keywords.where(~short), sizes, out, row_key)
    if watch.short_keywords:
        found = found.unionByName(_match_broadcast(df, texts, watch.keywords.where(short), out))
    return found


def _match_broadcast(df: DataFrame, texts: list[str], keywords: DataFrame, out: str) -> DataFrame:
    folded = {f"_folded{i}": F.lower(F.col(c)) for i, c in enumerate(texts)}
    words = keywords.select(F.col("keywords").alias(out), F.lower("keywords").alias("_keyword"))
    hit = _any_contains([F.col(c) for c in folded], F.col("_keyword"))
    # Folding sits below the join, so a text is folded once, not per keyword.
    return df.withColumns(folded).join(F.broadcast(words), hit).drop("_keyword", *folded)


def _match_by_automaton(df: DataFrame, texts: list[str], keywords: DataFrame, out: str) -> DataFrame:
    """One pass over each text finds all keywords (Aho and Corasick, 1975).

    Only the folded texts go to the Python worker, in Arrow batches, and only
    numbers of keywords come back; the row itself stays in the JVM.
    """
    spark = df.sparkSession
    listed = keywords.where(F.col("keywords").isNotNull()).select("keywords", F.lower("keywords")).collect()
    number = {folded: place for place, folded in enumerate(sorted({folded for _, folded in listed}))}
    shared = spark.sparkContext.broadcast(number)
    run_id = uuid.uuid4().hex

    def automaton():
        """Built once in a worker, which serves one query after another."""
        import ahocorasick

        kept = getattr(ahocorasick, "_tidewatch", (None, None))
        if kept[0] != run_id:
            made = ahocorasick.Automaton()
            for folded, place in shared.value.items():
                if folded:
                    made.add_word(folded, place)
            made.make_automaton()
            kept = ahocorasick._tidewatch = run_id, made
        return kept[1]

    def found(*columns: pa.Array) -> pa.Array:
        made = automaton()
        empty = {shared.value[""]} if "" in shared.value else set()
        out = []
        for row in zip(*[c.to_pylist() for c in columns], strict=True):
            present = [text for text in row if text is not None]
            met = set(empty) if present else set()
            if len(made):
                for text in present:
                    met.update([place for _, place in made.iter(text)])
            out.append(list(met))
        return pa.array(out, pa.list_(pa.int32()))

    hits = F.arrow_udf(found, "array<int>")(*[F.lower(F.col(c)) for c in texts])
    # As many rows as the list has of a keyword, in any case.
    table = pa.table({"_place": pa.array([number[f] for _, f in listed], pa.int32()), out: pa.array([k for k, _ in listed], pa.string())})
    names = F.broadcast(spark.createDataFrame(table))
    return df.withColumn("_place", F.explode(hits)).join(names, "_place").drop("_place")


def _sequences(text: Column, sizes: range) -> Column:
    """All character sequences of the given sizes in `text`, with repeats."""
    parts = [
        F.array(F.lit(""))
        if size == 0
        else F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1))
        for size in sizes
    ]
    return F.when(text.isNotNull(), F.concat(*parts)).otherwise(F.array().cast("array<string>"))


def _match_by_sequence(
    df: DataFrame,
    texts: list[str],
    watch: WatchList,
    keywords: DataFrame,
    sizes: range,
    out: str,
    row_key: list[str],
) -> DataFrame:
    """Texts and keywords meet on a sequence of SEQUENCE characters (or on the
    whole of a shorter keyword); `sizes` are the lengths that can occur."""
    words = (
        keywords.where(F.col("keywords").isNotNull())
        .groupBy("keywords")
        .agg(F.count("*").alias("_copies"))
    )
    folded = F.lower("keywords")
    own = F.when(F.length(folded) < SEQUENCE, F.array(folded)).otherwise(
        F.array_distinct(_sequences(folded, range(SEQUENCE, SEQUENCE + 1)))
    )
    of_words = words.select("keywords", "_copies", F.explode(own).alias("sequence"))

    # Only sequences some keyword holds leave the scan of the texts. There are
    # no more of them than the keywords have bytes.
    bound = watch.keyword_size.bytes if watch.keyword_size.broadcastable else None
    wanted = of_words.select("sequence").distinct()
    in_text = F.concat(*[_sequences(F.lower(F.col(c)), sizes) for c in texts])
    of_texts = (
        df.select(*row_key, F.explode(in_text).alias("sequence"))
        .join(broadcast_if(wanted, bound), "sequence", "left_semi")
        .distinct()
    )

    # Each keyword is looked up by its rarest sequence, the one fewest texts
    # hold. A keyword with a sequence that no text holds drops out.
    holders = of_texts.groupBy("sequence").agg(F.count("*").alias("_texts"))
    anchors = (
        of_words.join(holders, "sequence", "left")
        .groupBy("keywords", "_copies")
        .agg(F.min(F.struct(F.coalesce("_texts", F.lit(0)).alias("texts"), "sequence")).alias("_rarest"))
        .where(F.col("_rarest.texts") > 0)
        .select("keywords", "_copies", F.col("_rarest.sequence").alias("sequence"))
    )
    candidates = of_texts.join(anchors, "sequence").drop("sequence")
    verified = df.join(candidates, row_key).where(
        _any_contains([F.lower(F.col(c)) for c in texts], F.lower("keywords"))
    )
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies")))
    return verified.select(
        *[F.col(c) for c in df.columns], F.col("keywords").alias(out), copies.alias("_copy")
    ).drop("_copy")


def match_posts(
    posts: Posts, watch: WatchList, n: int | None, after: float | Column | None
) -> DataFrame:
    """Bronze submissions: one row per (post, keyword) among the newest `n`
    posts per community that were created after `after`."""
    candidates = newest_posts(posts.newer_than(after), watch, n)
    return as_submissions(match_keywords(candidates, ["title", "selftext"], watch, "key", ["id"]))


def as_submissions(matched: DataFrame) -> DataFrame:
    """Matched posts under the names of the bronze table."""
    return matched.select(
        "subreddit_name",
        "key",
        F.col("title").alias("post_title"),
        "id",
        F.col("permalink").alias("PermaLink"),
        F.col("num_comments").alias("Comments"),
        F.col("selftext").alias("Self_text"),
        F.col("created_utc").alias("time_utc"),
        "upvote_ratio",
    )


def high_water_mark(submissions: DataFrame) -> DataFrame:
    """The latest stored time, as a one-row frame."""
    return submissions.agg(F.max("time_utc").alias("time_utc"))


def watch_matrix(watch: WatchList, bucket_rows: int = 1_000) -> DataFrame:
    """Every (subreddit, keyword) pair, multiplicity kept.

    Keywords travel in bundles of about `bucket_rows`, joined on the bundle
    number, so no side needs to fit in one task.
    """
    buckets = max(1, -(-watch.keyword_size.rows // bucket_rows))
    if not watch.keyword_size.broadcastable:
        buckets = max(1, -(-watch.keywords.count() // bucket_rows))
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(buckets))
    bundles = (
        watch.keywords.withColumn("bucket", spread)
        .groupBy("bucket")
        .agg(F.collect_list(F.struct("keywords")).alias("bundle"))
    )
    rows = watch.subreddits.withColumn(
        "bucket", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(buckets - 1).cast("bigint")))
    )
    return rows.join(bundles, "bucket").select("subreddits", F.inline("bundle"))

"""Every registered query: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.inputs import CUTOFF, FIRST_RUN, LEXICON, MODIFIERS, Inputs
from tidewatch import schemas
from tidewatch.functions.sentiment import with_sentiment
from tidewatch.functions.time import local_timestamp, utc_text
from tidewatch.operators import changes, comments as comment_ops, match, merge
from tidewatch.operators.newest import Posts, newest_index
from tidewatch.operators.topk import newest_k
from tidewatch.plans import bronze, decisions, digest, full_run, gold, growth, incremental, silver
from tidewatch.session import cut, scratch_dir
from tidewatch.sources import by_day, jdbc, tables, watchlist
from tidewatch.sources.snapshots import SnapshotTables
from tidewatch.sources.watchlist import WatchList
from tidewatch.streaming import stateful
from tidewatch.streaming.follow import read_post_stream

NEWEST = 30
TOP = 100

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
    return fn


# --- lists -----------------------------------------------------------------


@query
def scan_config_list(i: Inputs) -> DataFrame:
    path = f"{scratch_dir(i.spark, 'list')}/subreddits"
    watchlist.write_list(i.documents.select("source"), path)
    listed = watchlist.read_stored_list(i.spark, path, "subreddits")
    return listed.groupBy("subreddits").agg(F.count("*").alias("n"))


def _two_lists(i: Inputs) -> tuple[DataFrame, DataFrame]:
    """The communities of all posts, as seen at the first run and now."""
    root = scratch_dir(i.spark, "diff")
    seen = i.index.where(F.col("created_utc") <= FIRST_RUN)
    watchlist.write_list(seen.select("subreddit_name"), f"{root}/old")
    watchlist.write_list(i.index.select("subreddit_name"), f"{root}/new")
    return watchlist.read_csv_raw(i.spark, f"{root}/old"), watchlist.read_csv_raw(i.spark, f"{root}/new")


@query
def config_diff(i: Inputs) -> DataFrame:
    old, new = _two_lists(i)
    return changes.multiset_diff(old, new).select(F.col("_c0").alias("subreddits"), "side")


@query
def config_diff_flags(i: Inputs) -> DataFrame:
    # The second pair holds the same rows in another order.
    old, new = i.index.where(F.col("created_utc") <= FIRST_RUN), i.index
    langs = i.documents.select("lang")
    return changes.config_flags(
        old.select("subreddit_name"), new.select("subreddit_name"), langs, langs.orderBy(F.desc("lang"))
    )


@query
def config_round_trip(i: Inputs) -> DataFrame:
    """Lines with blanks, empty ones, NULLs and line breaks, saved and read."""
    path = f"{scratch_dir(i.spark, 'trip')}/list"
    n = F.col("doc_id")
    line = (
        F.when(n % 5 == 0, F.concat(F.lit(" "), "source", F.lit("  "))).when(n % 7 == 0, "")
        .when(n % 11 == 0, F.lit(None)).when(n % 13 == 0, F.concat("source", F.lit('\n"x",y')))
        .otherwise(F.col("source"))
    )
    lines = i.documents.select(line.alias("line"))
    watchlist.write_list(lines, path)
    stored = watchlist.read_stored_list(i.spark, path, "line")
    same = changes.config_flags(lines, stored, lines, stored).select("same_sub")
    return stored.groupBy("line").agg(F.count("*").alias("n")).crossJoin(F.broadcast(same))


@query
def list_rejects(i: Inputs) -> DataFrame:
    """Lines of a list that hold a comma, told from the others."""
    path = f"{scratch_dir(i.spark, 'rejects')}/list"
    line = F.when(F.col("doc_id") % 4 == 0, F.concat_ws(", ", "source", "lang")).otherwise(F.col("source"))
    i.documents.select(line.alias("line")).write.text(path)
    kept, rejected = watchlist.read_list_checked(i.spark, path, "line")
    lines = kept.select("line", F.lit(True).alias("kept")).unionAll(rejected.select(F.col(watchlist.REJECTED), F.lit(False)))
    return lines.groupBy("line", "kept").agg(F.count("*").alias("n"))


@query
def list_fingerprints(i: Inputs) -> DataFrame:
    """Whether lists are the same, by fingerprints: the same rows in another
    order, rows added, one more copy of a row, and a value changed."""
    lists = {
        "shuffled": (i.documents.select("lang"), i.documents.select("lang").orderBy(F.desc("lang"))),
        "added": (i.index.where(F.col("created_utc") <= FIRST_RUN).select("subreddit_name"), i.index.select("subreddit_name")),
        "copied": (i.documents.select("source"), i.documents.select("source").unionAll(i.documents.select("source").limit(1))),
        "changed": (i.documents.select("source"), i.documents.select(F.when(F.col("doc_id") == 7, "other").otherwise(F.col("source")))),
    }
    rows = [
        changes.same_fingerprint(changes.list_fingerprint(old), changes.list_fingerprint(new), "same").select(F.lit(name).alias("name"), "same")
        for name, (old, new) in lists.items()
    ]
    return rows[0].unionAll(rows[1]).unionAll(rows[2]).unionAll(rows[3])


@query
def config_select(i: Inputs) -> DataFrame:
    toxic = i.table("labels").where("toxic = 1").select("doc_id", F.lit(True).alias("toxic"))
    files = i.documents.join(toxic, "doc_id", "left").select(
        "doc_id", F.col("source").alias("name"), F.coalesce("toxic", F.lit(False)).alias("trashed")
    )
    return watchlist.select_config_files(files, ("src1", "src5", "src9")).select("doc_id", "name")


@query
def digest_recipient(i: Inputs) -> DataFrame:
    return watchlist.first_recipient(i.emails)


# --- posts -----------------------------------------------------------------


@query
def newest_per_subreddit(i: Inputs) -> DataFrame:
    return newest_index(i.posts(), i.watch, NEWEST)


@query
def watch_matrix(i: Inputs) -> DataFrame:
    found = submissions_full(i).groupBy("subreddit_name", "key").agg(F.count("*").alias("n"))
    pairs = match.watch_matrix(i.watch)
    on = (F.col("subreddits") == F.col("subreddit_name")) & (F.col("keywords") == F.col("key"))
    return pairs.join(found, on, "left").select(
        "subreddits", "keywords", F.coalesce("n", F.lit(0)).alias("n")
    )


@query
def submissions_full(i: Inputs) -> DataFrame:
    return bronze.submissions_full(i.posts(), i.watch, CUTOFF)


def _submissions_t0(i: Inputs) -> DataFrame:
    return bronze.submissions_full(i.posts(FIRST_RUN), i.watch, CUTOFF)


@query
def high_water_mark(i: Inputs) -> DataFrame:
    return match.high_water_mark(_submissions_t0(i))


@query
def submissions_incremental(i: Inputs) -> DataFrame:
    return bronze.submissions_incremental(i.posts(), i.watch, _submissions_t0(i))


@query
def merge_submissions(i: Inputs) -> DataFrame:
    # Every match of today against the earlier ones: matched and new rows.
    # Both are stored first, as a run has them: a merge names its inputs several times.
    return merge.merge_upsert(cut(_submissions_t0(i)), cut(submissions_full(i)), bronze.MERGE_KEYS)


@query
def merge_changed(i: Inputs) -> DataFrame:
    """The bounded route: rows that are new, changed, equal, or differ by a NULL only."""
    store = SnapshotTables(i.spark, scratch_dir(i.spark, "changed"))
    store.overwrite(_submissions_t0(i), "target")
    number = F.col("id").cast("bigint")
    source = submissions_full(i).withColumns(
        {
            "post_title": F.when(number % 3 == 0, F.concat("post_title", F.lit("!"))).otherwise(F.col("post_title")),
            "Self_text": F.when(number % 3 == 1, F.lit(None)).otherwise(F.col("Self_text")),
        }
    )
    store.overwrite(source, "source")
    stored = store.read("source")
    store.merge(stored, "target", bronze.MERGE_KEYS, max_source=stored.count())
    return store.read("target")


@query
def submissions_long_keywords(i: Inputs) -> DataFrame:
    """More keywords than are tested one by one: all words of the benchmark, and an empty one."""
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    listed = i.spark.read.parquet(f"{i.sf_dir}/benchmark.parquet").select(words.alias("keywords")).distinct()
    listed = listed.unionAll(i.literal(keywords=[""]))
    found = bronze.submissions_full(i.posts(), WatchList.of(i.subreddits, listed), CUTOFF)
    return found.groupBy("key").agg(F.count("*").alias("n"), F.max("time_utc").alias("latest"))


@query
def newest_k_large(i: Inputs) -> DataFrame:
    return _newest_lines(i, F.unix_date(F.col("l_shipdate").cast("date")) * 86_400.0)


@query
def newest_k_one_hour(i: Inputs) -> DataFrame:
    # All rows within one hour of each other, most with equal times.
    return _newest_lines(i, F.year("l_shipdate").cast("double"))


def _newest_lines(i: Inputs, time: Column) -> DataFrame:
    lines = i.spark.read.parquet(f"{i.sf_dir}/lineitem.parquet")
    lines = lines.select("l_orderkey", "l_linenumber", time.alias("time_utc"))
    return newest_k(lines, 20_000, ties=("l_orderkey", "l_linenumber"))


@query
def write_then_read(i: Inputs) -> DataFrame:
    store = SnapshotTables(i.spark, scratch_dir(i.spark, "write"))
    store.overwrite(i.index, "posts")
    store.overwrite(i.wide_posts(), "posts")
    return store.read("posts")


@query
def table_by_name(i: Inputs) -> DataFrame:
    name = f"tidewatch_{uuid.uuid4().hex}"
    tables.write_table(i.wide_posts(), name, path=scratch_dir(i.spark, "table"))
    found = tables.read_table(i.spark, name).select("id", "subreddit_name", "title", "created_utc")
    tables.drop_table(i.spark, name)  # the files, named by path, stay
    return found


@query
def submissions_by_day(i: Inputs) -> DataFrame:
    """Matches after the latest stored one, from posts stored by day: earlier days are not read.

    The newest posts of a community that are later than the mark are the later
    ones of its newest posts, so the limit may come behind."""
    path = f"{scratch_dir(i.spark, 'days')}/posts"
    by_day.write_by_day(i.wide_posts(), path, "created_utc", 8)
    later = by_day.newer_posts(i.spark, path, match.high_water_mark(_submissions_t0(i)))
    return bronze.submissions_full(later, i.watch, CUTOFF)


@query
def stream_submissions(i: Inputs) -> DataFrame:
    """All matches, found by a stream of post files; posts that come again are found once."""
    root = scratch_dir(i.spark, "stream")
    columns = ["subreddit_name", "id", "title", "permalink", "num_comments", "selftext", "created_utc", "upvote_ratio"]
    posts = i.wide_posts().select(*columns)
    again = posts.where(F.col("id").cast("bigint") % 3 == 0)
    for part in (posts, again):
        # As many files as the posts take; each run of the stream goes on from the checkpoint.
        part.write.mode("append").parquet(f"{root}/posts")
        arriving = read_post_stream(i.spark, f"{root}/posts")
        done = stateful.follow_matches(arriving, i.watch, f"{root}/found", f"{root}/checkpoint", CUTOFF, "365 days")
        done.awaitTermination()
    return i.spark.read.schema(schemas.SUBMISSIONS).parquet(f"{root}/found")


# --- comments --------------------------------------------------------------


@query
def comments_direct(i: Inputs) -> DataFrame:
    bound = i.watch.post_bound(bronze.POSTS_PER_SUBREDDIT)
    return comment_ops.comments_direct(submissions_full(i), i.comments(), bound)


@query
def comments_unbounded(i: Inputs) -> DataFrame:
    return comment_ops.comments_direct(submissions_full(i), i.comments())


@query
def comments_bucketed(i: Inputs) -> DataFrame:
    """Comments of posts from two catalog tables in equal buckets of the post's id, which meet without a shuffle."""
    root, tag = scratch_dir(i.spark, "buckets"), uuid.uuid4().hex
    stored = {}
    for name, frame, key in (("posts", submissions_full(i), "id"), ("comments", i.comments(), "submission_id")):
        table = f"tidewatch_{name}_{tag}"
        tables.write_table(frame, table, path=f"{root}/{name}", bucket_by=[key], buckets=8)
        stored[name] = tables.read_table(i.spark, table)
        tables.drop_table(i.spark, table)  # the files, named by path, stay
    return comment_ops.comments_direct(stored["posts"], stored["comments"], buckets_meet=True)


@query
def comments_indirect(i: Inputs) -> DataFrame:
    return bronze.comments_indirect(i.posts(), i.comments(), i.watch, CUTOFF)


@query
def comments_union(i: Inputs) -> DataFrame:
    return comment_ops.union_comments(comments_direct(i), comments_indirect(i))


@query
def comments_dedup(i: Inputs) -> DataFrame:
    return comment_ops.dedup_comments(comments_union(i))


@query
def comments_clean(i: Inputs) -> DataFrame:
    return comment_ops.drop_deleted(comments_dedup(i))


# --- silver and gold -------------------------------------------------------


@query
def times_utc_local(i: Inputs) -> DataFrame:
    utc = utc_text(F.col("created_utc"))
    return i.index.select("id", utc.alias("time_utc"), local_timestamp(utc).alias("time_est"))


@query
def silver_comments(i: Inputs) -> DataFrame:
    return silver.silver_comments(comments_direct(i), comments_indirect(i))


@query
def silver_incremental(i: Inputs) -> DataFrame:
    """Silver comments after three runs, of which the last two take what has changed."""
    store = SnapshotTables(i.spark, scratch_dir(i.spark, "silver"))
    steps = [("silver", silver.silver_comments)]
    for run, until in enumerate((FIRST_RUN, FIRST_RUN + 43_200, None)):
        made_from = {name: store.latest(name) for name in ("direct", "indirect")} if run else {}
        comments, posts = i.comments(until), i.posts(until)
        matched = cut(bronze.submissions_full(posts, i.watch, CUTOFF))
        store.overwrite(comment_ops.comments_direct(matched, comments, i.watch.post_bound(bronze.POSTS_PER_SUBREDDIT)), "direct")
        store.overwrite(bronze.comments_indirect(posts, comments, i.watch, CUTOFF), "indirect")
        if run:
            incremental.update(store, made_from, ["comment_id"], steps)
        else:
            store.overwrite(silver.silver_comments(store.read("direct"), store.read("indirect")), "silver")
    return store.read("silver")


@query
def silver_submissions(i: Inputs) -> DataFrame:
    return silver.silver_submissions(submissions_full(i))


@query
def comment_sentiment(i: Inputs) -> DataFrame:
    # All comments, matched or not.
    return with_sentiment(
        i.comments().select("comment_id", "body"), ["comment_id"], "body", i.lexicon, "comment_sentiment"
    )


@query
def title_sentiment(i: Inputs) -> DataFrame:
    return with_sentiment(i.content.select("id", "title"), ["id"], "title", i.lexicon, "title_sentiment")


def _words(column: str) -> Column:
    return F.regexp_extract_all(F.lower(column), F.lit(r"\p{L}+"), F.lit(0))


@query
def sentiment_long_list(i: Inputs) -> DataFrame:
    """A list of thousands of words, those that the documents hold ten times or more."""
    words = i.documents.select(F.explode(_words("text")).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    lexicon = words.where("n >= 10").select("word", (F.col("n") % 9 - 4).cast("double").alias("polarity"))
    comments = i.comments().select("comment_id", "body")
    return with_sentiment(comments, ["comment_id"], "body", lexicon, "comment_sentiment")


@query
def sentiment_modifiers(i: Inputs) -> DataFrame:
    """Words that negate or strengthen the next one."""
    lexicon = i.literal(
        word=[*LEXICON, *MODIFIERS],
        polarity=[*LEXICON.values(), *(None for _ in MODIFIERS)],
        is_negation=[*(False for _ in LEXICON), *(negation for negation, _ in MODIFIERS.values())],
        intensity=[*(None for _ in LEXICON), *(intensity for _, intensity in MODIFIERS.values())],
    )
    comments = i.comments().select("comment_id", "body")
    return with_sentiment(comments, ["comment_id"], "body", lexicon, "comment_sentiment")


@query
def gold_comments(i: Inputs) -> DataFrame:
    return gold.gold_comments(silver_comments(i), i.lexicon)


@query
def gold_submissions(i: Inputs) -> DataFrame:
    return gold.gold_submissions(silver_submissions(i), i.lexicon)


# --- decisions -------------------------------------------------------------


def _flags(i: Inputs) -> DataFrame:
    """Flags per (community, language), taken from all posts."""
    toxic = i.table("labels").select("doc_id", "toxic")
    at = F.col("created_utc")
    return (
        i.index.join(i.documents.select("doc_id", "lang"), "doc_id")
        .join(toxic, "doc_id", "left")
        .groupBy("subreddit_name", "lang")
        .agg(
            (F.count_if(at <= CUTOFF) > 0).alias("table_exists"),
            (F.count_if(F.col("toxic") == 1) == 0).alias("both_same"),
            F.count_if((at > CUTOFF) & (at <= FIRST_RUN)).alias("stored_rows"),
            F.count_if(at > FIRST_RUN).alias("new_rows"),
        )
    )


@query
def refresh_decision(i: Inputs) -> DataFrame:
    names = [F.col(c) for c in ("table_exists", "both_same", "stored_rows", "new_rows")]
    return (
        _flags(i)
        .withColumn("action", decisions.refresh_action(*names))
        .withColumn("updates", decisions.has_updates(F.col("action")))
    )


@query
def notify_decision(i: Inputs) -> DataFrame:
    version = F.least(F.col("stored_rows"), F.lit(2)).alias("version")
    flags = _flags(i).select(
        "subreddit_name", "lang", F.col("both_same").alias("same"), F.col("new_rows").alias("n"), version
    )
    names = [F.col(c) for c in ("same", "n", "version")]
    return flags.withColumns(
        {
            "notify": decisions.notify_action(*names),
            "notify_compat": decisions.notify_action(*names, compat=True),
        }
    )


# --- two whole runs --------------------------------------------------------

_RUNS: dict[tuple[str, str], tuple[SnapshotTables, list[full_run.RunReport]]] = {}


def two_runs(i: Inputs) -> tuple[SnapshotTables, list[full_run.RunReport]]:
    """The tables after a first run on what there was at FIRST_RUN and a
    second run on everything. Made once per session and data folder."""
    key = (i.spark.sparkContext.applicationId, i.sf_dir)
    if key not in _RUNS:
        root = scratch_dir(i.spark, "runs")
        settings = full_run.Settings(cutoff=CUTOFF)
        # A run reads the index and the comments many times: stored tables, as the original has them.
        inputs = {"index": i.posts().index, "comments": i.comments()}
        for name, frame in inputs.items():
            frame.write.parquet(f"{root}/inputs/{name}")
        index, comments = (i.spark.read.schema(frame.schema).parquet(f"{root}/inputs/{name}") for name, frame in inputs.items())
        reports = []
        for until in (FIRST_RUN, None):
            seen = F.lit(True) if until is None else F.col("created_utc") <= until
            reports.append(
                full_run.run_once(
                    i.spark, root, Posts(index.where(seen), i.content), comments.where(seen), i.subreddits, i.keywords,
                    watchlist.first_recipient(i.emails), i.lexicon, settings,
                )
            )
        _RUNS[key] = SnapshotTables(i.spark, f"{root}/tables"), reports
    return _RUNS[key]


@query
def snapshot_read(i: Inputs) -> DataFrame:
    return two_runs(i)[0].read(full_run.SUBMISSIONS, 0)


@query
def snapshot_latest(i: Inputs) -> DataFrame:
    store = two_runs(i)[0]
    latest = store.latest(full_run.SUBMISSIONS)
    return store.read(full_run.SUBMISSIONS, latest).select(
        F.lit(latest).cast("bigint").alias("version"), "id", "key", "post_title", "time_utc"
    )


@query
def snapshot_counts(i: Inputs) -> DataFrame:
    return two_runs(i)[0].counts(full_run.SUBMISSIONS, [0, 1])


@query
def snapshot_changes(i: Inputs) -> DataFrame:
    """What two versions differ in: new rows, changed ones, and some that went."""
    store = SnapshotTables(i.spark, scratch_dir(i.spark, "feed"))
    number = F.col("id").cast("bigint")
    store.overwrite(_submissions_t0(i), "table")
    title = F.when(number % 3 == 0, F.concat("post_title", F.lit("!"))).otherwise(F.col("post_title"))
    store.overwrite(submissions_full(i).where(number % 5 != 0).withColumn("post_title", title), "table")
    return store.changes("table", 0, 1, bronze.MERGE_KEYS)


@query
def snapshot_growth(i: Inputs) -> DataFrame:
    return growth.snapshot_growth(two_runs(i)[0].counts(full_run.INDIRECT, [0, 1]), 1)


@query
def snapshot_new_rows(i: Inputs) -> DataFrame:
    store = two_runs(i)[0]
    new = growth.snapshot_new_rows(store, full_run.INDIRECT, 1, ["comment_id", "keyword"])
    return new.select("comment_id", "keyword", "time_utc")


@query
def full_run_gold_comments(i: Inputs) -> DataFrame:
    return _rounded(two_runs(i)[0].read(full_run.GOLD_COMMENTS), "comment_sentiment")


@query
def full_run_gold_submissions(i: Inputs) -> DataFrame:
    return _rounded(two_runs(i)[0].read(full_run.GOLD_SUBMISSIONS), "title_sentiment")


def _rounded(df: DataFrame, name: str) -> DataFrame:
    """The stored `float` as a `double` of six places, for comparison."""
    return df.withColumn(name, F.round(F.col(name).cast("double"), 6) + F.lit(0.0))


@query
def sync_submissions(i: Inputs) -> DataFrame:
    return jdbc.sync_frame(full_run_gold_submissions(i))


@query
def sql_type_map(i: Inputs) -> DataFrame:
    store = two_runs(i)[0]
    reports = [
        jdbc.column_report(jdbc.sync_frame(store.read(name)), table, compat).withColumn(
            "compat", F.lit(compat)
        )
        for name, table in ((full_run.GOLD_SUBMISSIONS, "submissions"), (full_run.GOLD_COMMENTS, "comments"))
        for compat in (False, True)
    ]
    return reports[0].unionAll(reports[1]).unionAll(reports[2]).unionAll(reports[3])


@query
def digest_posts(i: Inputs) -> DataFrame:
    stored = two_runs(i)[0].read(full_run.SUBMISSIONS)
    return newest_k(stored, TOP, ties=("id", "key")).select("id", "key", "post_title")


@query
def digest_comments(i: Inputs) -> DataFrame:
    stored = two_runs(i)[0].read(full_run.INDIRECT)
    return newest_k(stored, TOP, ties=("comment_id", "keyword")).select(
        "comment_id", "keyword", "comment_body"
    )


@query
def digest_lines(i: Inputs) -> DataFrame:
    store, reports = two_runs(i)
    last = reports[-1]
    return digest.digest_lines(
        store.read(full_run.SUBMISSIONS), last.new_posts, store.read(full_run.INDIRECT), last.new_comments
    ).select("section", "time_utc", "line")


@query
def digest_html(i: Inputs) -> DataFrame:
    return two_runs(i)[0].read(full_run.DIGEST)

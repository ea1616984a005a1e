"""One whole run: bronze, silver, gold, digest.

Every stage is written before the next reads it, so a lost executor costs the
tasks it held, not the run. A run that fails is simply started again: config
lists and the versions reported are saved last, so it sees the same changes and
the same news as before.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.text import BASE_URL
from tidewatch.functions.time import NEW_YORK
from tidewatch.operators import changes
from tidewatch.operators.changes import config_flags
from tidewatch.operators.comments import comments_direct
from tidewatch.operators.newest import COMMENT_POSTS_PER_SUBREDDIT, POSTS_PER_SUBREDDIT, Posts
from tidewatch.plans import bronze, gold, incremental, silver
from tidewatch.plans.decisions import has_updates, notify_action, refresh_action
from tidewatch.plans.digest import digest
from tidewatch.plans.growth import update_counts
from tidewatch.sources.files import path_exists
from tidewatch.sources.snapshots import SnapshotTables
from tidewatch.sources.jdbc import sync_frame
from tidewatch.sources.watchlist import WatchList, first_recipient, read_stored_list, write_list

SUBMISSIONS = "bronze_submissions"
STAGING = "bronze_submissions_temp"
DIRECT = "bronze_comments_direct"
INDIRECT = "bronze_comments_indirect"
SILVER_COMMENTS = "silver_comments"
SILVER_SUBMISSIONS = "silver_submissions"
GOLD_COMMENTS = "gold_comments"
GOLD_SUBMISSIONS = "gold_submissions"
DIGEST = "digest"


@dataclass(frozen=True)
class Settings:
    cutoff: float = bronze.CUTOFF
    posts_per_subreddit: int | None = POSTS_PER_SUBREDDIT
    comment_posts_per_subreddit: int | None = COMMENT_POSTS_PER_SUBREDDIT
    base_url: str = BASE_URL
    zone: str = NEW_YORK
    report_url: str | None = None
    compat_digest: bool = False


@dataclass(frozen=True)
class RunReport:
    action: str
    updates: bool
    same_sub: bool
    same_key: bool
    new_posts: int
    new_comments: int
    notify: str
    versions: dict[str, int] = field(default_factory=dict)


def run_once(
    spark: SparkSession,
    root: str,
    posts: Posts,
    comments: DataFrame,
    subreddits: DataFrame,
    keywords: DataFrame,
    email: DataFrame,
    lexicon: DataFrame,
    settings: Settings = Settings(),
    tables=None,
    sync: Callable[[DataFrame, str], None] | None = None,
) -> RunReport:
    """Bring all tables below `root` up to date with the inputs.

    `sync(frame, table)` gets the two gold tables as a database would have them,
    once they are stored (see `sources.jdbc.sync_jdbc`).
    """
    tables = tables or SnapshotTables(spark, f"{root}/tables")
    watch = WatchList.of(subreddits, keywords)
    flags = _compare_lists(spark, root, watch)
    both_same = flags["both_same"]

    action = _refresh_submissions(spark, tables, posts, watch, both_same, settings)
    updates = spark.range(1).select(has_updates(F.lit(action))).first()[0]
    submissions = tables.read(SUBMISSIONS)
    tables.overwrite(comments_direct(submissions, comments, max_posts=submissions.count()), DIRECT)
    tables.overwrite(
        bronze.comments_indirect(
            posts, comments, watch, settings.cutoff, settings.comment_posts_per_subreddit
        ),
        INDIRECT,
    )

    _refresh_silver_and_gold(spark, root, tables, lexicon, settings, anew=action in ("full", "rebuild"))

    if sync is not None:
        for name in (GOLD_SUBMISSIONS, GOLD_COMMENTS):
            sync(sync_frame(tables.read(name)), name)

    reported = _reported(spark, root)
    new_posts, new_comments = update_counts(tables, both_same, updates, SUBMISSIONS, INDIRECT, reported)
    notify = (
        spark.range(1)
        .select(
            notify_action(
                F.lit(both_same),
                F.lit(new_posts + new_comments),
                F.lit(tables.latest(SUBMISSIONS)),
                settings.compat_digest,
            )
        )
        .first()[0]
    )
    if notify != "none":
        message = digest(
            notify,
            first_recipient(email),
            tables.read(SUBMISSIONS),
            new_posts,
            tables.read(INDIRECT),
            new_comments,
            report_url=settings.report_url,
        )
        tables.overwrite(message, DIGEST)

    _save_lists(root, watch, email)
    _save_reported(spark, root, {name: tables.latest(name) for name in (SUBMISSIONS, INDIRECT)})
    names = (SUBMISSIONS, DIRECT, INDIRECT, SILVER_COMMENTS, SILVER_SUBMISSIONS, GOLD_COMMENTS,
             GOLD_SUBMISSIONS, DIGEST)
    return RunReport(
        action, updates, flags["same_sub"], flags["same_key"], new_posts, new_comments, notify,
        {name: tables.latest(name) for name in names if tables.exists(name)},
    )


def _compare_lists(spark: SparkSession, root: str, watch: WatchList) -> dict[str, bool]:
    def stored(name: str) -> DataFrame | None:
        path = f"{root}/config/{name}"
        return read_stored_list(spark, path, name) if path_exists(spark, f"{path}/_SUCCESS") else None

    return (
        config_flags(stored("subreddits"), watch.subreddits, stored("keywords"), watch.keywords)
        .first()
        .asDict()
    )


def _refresh_silver_and_gold(
    spark: SparkSession, root: str, tables, lexicon: DataFrame, settings: Settings, anew: bool
) -> None:
    """Silver and gold, from the bronze rows that have changed since they were
    last made; from all rows if that is not known, or the word list or a setting
    they depend on is another."""
    base, zone = settings.base_url, settings.zone
    made_with = repr([base, zone, *changes.list_fingerprint(lexicon).first()])
    comments, submissions = [
        (SILVER_COMMENTS, lambda direct, indirect: silver.silver_comments(direct, indirect, base, zone)),
        (GOLD_COMMENTS, lambda rows: gold.as_stored(gold.gold_comments(rows, lexicon))),
    ], [
        (SILVER_SUBMISSIONS, lambda rows: silver.silver_submissions(rows, base, zone)),
        (GOLD_SUBMISSIONS, lambda rows: gold.as_stored(gold.gold_submissions(rows, lexicon))),
    ]
    made_from = {} if anew or not hasattr(tables, "changes") else _made_from(spark, root, made_with)
    for sources, keys, steps in (
        ([DIRECT, INDIRECT], ["comment_id"], comments),
        ([SUBMISSIONS], bronze.MERGE_KEYS, submissions),
    ):
        known = all(made_from.get(name) in tables.versions(name) for name in sources) if made_from else False
        if known and all(tables.exists(name) for name, _ in steps):
            incremental.update(tables, {name: made_from[name] for name in sources}, keys, steps)
            continue
        inputs = [tables.read(name) for name in sources]
        for name, step in steps:
            tables.overwrite(step(*inputs), name, same_schema=name in (GOLD_COMMENTS, GOLD_SUBMISSIONS))
            inputs = [tables.read(name)]
    rows = [(name, tables.latest(name), made_with) for name in (DIRECT, INDIRECT, SUBMISSIONS)]
    spark.createDataFrame(rows, _MADE_FROM).coalesce(1).write.mode("overwrite").parquet(f"{root}/config/made_from")


_MADE_FROM = "table string, version bigint, made_with string"


def _made_from(spark: SparkSession, root: str, made_with: str) -> dict[str, int]:
    """The bronze versions that silver and gold hold, if made with the same settings."""
    path = f"{root}/config/made_from"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        return {}
    rows = spark.read.schema(_MADE_FROM).parquet(path).collect()
    return {r["table"]: r["version"] for r in rows if r["made_with"] == made_with}


_REPORTED = "table string, version bigint"


def _reported(spark: SparkSession, root: str) -> dict[str, int] | None:
    """The versions that the last finished run has told of, if there was one."""
    path = f"{root}/config/reported"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        return None
    return {r["table"]: r["version"] for r in spark.read.schema(_REPORTED).parquet(path).collect()}


def _save_reported(spark: SparkSession, root: str, versions: dict[str, int]) -> None:
    frame = spark.createDataFrame(list(versions.items()), _REPORTED)
    frame.coalesce(1).write.mode("overwrite").parquet(f"{root}/config/reported")


def _save_lists(root: str, watch: WatchList, email: DataFrame) -> None:
    for name, frame in (("subreddits", watch.subreddits), ("keywords", watch.keywords), ("email", email)):
        write_list(frame, f"{root}/config/{name}")


def _refresh_submissions(
    spark: SparkSession, tables, posts: Posts, watch: WatchList, both_same: bool, settings: Settings
) -> str:
    n = settings.posts_per_subreddit
    exists = tables.exists(SUBMISSIONS)
    stored_rows = tables.read(SUBMISSIONS).count() if exists and both_same else 0
    new_count = 0
    if stored_rows:
        staged = bronze.submissions_incremental(posts, watch, tables.read(SUBMISSIONS), n)
        tables.overwrite(staged, STAGING)
        new_count = tables.read(STAGING).count()

    action = (
        spark.range(1)
        .select(refresh_action(F.lit(exists), F.lit(both_same), F.lit(stored_rows), F.lit(new_count)))
        .first()[0]
    )
    if action == "merge":
        tables.merge(tables.read(STAGING), SUBMISSIONS, bronze.MERGE_KEYS, max_source=new_count)
    elif action == "keep":
        tables.drop(STAGING)
    else:
        if action == "rebuild":
            for name in (SUBMISSIONS, DIRECT, INDIRECT):
                tables.drop(name)
        tables.overwrite(
            bronze.submissions_full(posts, watch, settings.cutoff, n), SUBMISSIONS
        )
    return action

"""How much the tables grew since the previous version."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.merge import new_rows
from tidewatch.plans.decisions import growth


def snapshot_growth(counts: DataFrame, version: int, before: int | None = None) -> DataFrame:
    """One row (n_curr, n_prev, growth) from (version, n) rows, against version
    `before` (default: the one before `version`)."""
    before = version - 1 if before is None else before
    at = lambda v: F.max(F.when(F.col("version") == v, F.col("n")))
    return counts.agg(at(version).alias("n_curr"), at(before).alias("n_prev")).withColumn(
        "growth", growth(F.col("n_curr"), F.col("n_prev"))
    )


def update_counts(
    tables, same: bool, updates: bool, posts: str = "submissions", comments: str = "comments_indirect",
    reported: dict[str, int] | None = None,
) -> tuple[int, int]:
    """(new posts, new comments) of a run: growth if the watch lists are
    unchanged, everything stored if not.

    `reported` holds the versions that the last finished run has told of; growth
    counts from them, so what a failed run stored is still news. Without them it
    counts from the version before.
    """
    found = {}
    for table in (posts, comments):
        version = tables.latest(table)
        before = (reported or {}).get(table)
        before = version - 1 if before is None or before > version else before
        row = snapshot_growth(tables.counts(table, [before, version]), version, before).first()
        found[table] = (row["growth"] if same else row["n_curr"]) or 0
    told = reported is not None and posts in reported
    return (found[posts] if updates or told or not same else 0), found[comments]


def snapshot_new_rows(tables, table: str, version: int, keys: list[str]) -> DataFrame:
    """The rows version `version` has and the one before lacks, by key.

    After an append these are the appended rows. Otherwise the two versions
    are compared.
    """
    if version - 1 not in tables.versions(table):
        return tables.read(table, version)
    if tables.same_base(table, version, version - 1):
        return tables.read(table, version, since=version - 1)
    return new_rows(tables.read(table, version), tables.read(table, version - 1), keys)

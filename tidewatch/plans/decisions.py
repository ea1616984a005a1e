"""Decision tables as column expressions over rows of flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def refresh_action(exists: Column, both_same: Column, stored_rows: Column, new_rows: Column) -> Column:
    """What a run does with the submissions table.

    full     nothing usable is stored: match everything
    rebuild  a watch list changed: drop the bronze tables, match everything
    merge    new matches were found: merge them
    keep     none were found
    """
    return (
        F.when(~exists, "full")
        .when(~both_same, "rebuild")
        .when(stored_rows == 0, "full")
        .when(new_rows > 0, "merge")
        .otherwise("keep")
    )


def has_updates(action: Column) -> Column:
    return action == "merge"


def notify_action(same: Column, new_items: Column, version: Column, compat: bool = False) -> Column:
    """Which digest a run gives: update, first or none.

    `compat` repeats the first digest on every quiet run until a merge makes
    version 1; by default a quiet run with unchanged lists gives none.
    """
    quiet = F.when((version == 0) & F.lit(compat), "first").otherwise("none")
    return (
        F.when(same & (new_items > 0), "update")
        .when(same, quiet)
        .when(version == 0, "first")
        .otherwise("none")
    )


def growth(current: Column, previous: Column) -> Column:
    """Rows gained since the previous version, never negative; NULL (no
    previous version) is no growth."""
    return F.coalesce(F.greatest(current - previous, F.lit(0)), F.lit(0))

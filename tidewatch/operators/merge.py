"""Merging new rows into stored ones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.sizes import broadcast_if

_SRC = "_src_"


def differs(pairs: list[tuple[Column, Column]], null_safe: bool = False) -> Column:
    """True if any pair differs. Plain inequality sees no difference from or
    to NULL; `null_safe` does."""
    tests = [~a.eqNullSafe(b) if null_safe else a != b for a, b in pairs]
    return F.coalesce(reduce(lambda a, b: a | b, tests, F.lit(False)), F.lit(False))


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    null_safe: bool = False,
    max_source: int | None = None,
) -> DataFrame:
    """Target rows, replaced where a source row with their key differs, plus
    the source rows whose key the target lacks.

    Raises, when run, if two source rows match one target row. Only keys meet
    all of the target: with a proven bound `max_source` on the source rows they
    are broadcast, and the target is not shuffled. The target rows whose key the
    source has are then joined to the source rows.
    """
    columns = target.columns
    values = [c for c in columns if c not in keys]
    # One row per key, however many copies the source has of it.
    wanted = broadcast_if(source.groupBy(*keys).agg(F.count("*").alias("_copies")), max_source)
    # The test names a target column, so that it cannot be moved to where the
    # copies are counted and raise for a key that the target lacks.
    met = F.length(F.concat_ws("", *[F.col(k).cast("string") for k in keys])) >= 0
    unambiguous = F.when(
        (F.col("_copies") > 1) & met,
        F.raise_error(F.lit("merge: two source rows match one target row")).cast("boolean"),
    ).otherwise(True)
    renamed = source.select(*[F.col(c).alias(_SRC + c) for c in columns])
    same_key = reduce(lambda a, b: a & b, [F.col(k) == F.col(_SRC + k) for k in keys])
    changed = differs([(F.col(c), F.col(_SRC + c)) for c in values], null_safe)

    untouched = target.join(wanted, keys, "left_anti")
    matched = target.join(wanted, keys).where(unambiguous)
    merged = matched.join(renamed, same_key).select(
        *[F.when(changed, F.col(_SRC + c)).otherwise(F.col(c)).alias(c) for c in columns]
    )
    stored = broadcast_if(matched_keys(target, source, keys, max_source).distinct(), max_source)
    new = source.select(*columns).join(stored, keys, "left_anti")
    return untouched.select(*columns).unionByName(merged).unionByName(new.select(*columns))


def matched_keys(
    target: DataFrame, source: DataFrame, keys: list[str], max_source: int | None = None
) -> DataFrame:
    """Keys of target rows that the source has too. Reads only the keys."""
    wanted = source.select(*keys).distinct()
    return target.select(*keys).join(broadcast_if(wanted, max_source), keys, "left_semi")


def new_rows(current: DataFrame, previous: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `current` whose key `previous` lacks (NULL keys count as equal)."""
    old = previous.select(*[F.col(k).alias(_SRC + k) for k in keys]).distinct()
    same_key = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(_SRC + k)) for k in keys])
    return current.join(old, same_key, "left_anti")

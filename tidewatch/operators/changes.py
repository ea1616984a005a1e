"""Detecting changes between two versions of a list or a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def multiset_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows one side has and the other lacks, surplus copies kept, with `side`
    telling which side has them."""
    removed = old.exceptAll(new).withColumn("side", F.lit("old"))
    added = new.exceptAll(old).withColumn("side", F.lit("new"))
    return removed.unionAll(added)


def diff_counts(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row per differing value with its surplus: positive if `old` has
    more copies, negative if `new` has. One pass, combined before the shuffle."""
    columns = old.columns
    signed = old.withColumn("_sign", F.lit(1)).unionAll(new.toDF(*columns).withColumn("_sign", F.lit(-1)))
    return (
        signed.groupBy(*columns)
        .agg(F.sum("_sign").alias("surplus"))
        .where(F.col("surplus") != 0)
    )


def same_flag(old: DataFrame, new: DataFrame, name: str) -> DataFrame:
    """One row, one boolean: the lists hold the same rows, order ignored."""
    return diff_counts(old, new).agg((F.count("*") == 0).alias(name))


def config_flags(
    old_sub: DataFrame | None, new_sub: DataFrame, old_key: DataFrame | None, new_key: DataFrame
) -> DataFrame:
    """One row (same_sub, same_key, both_same). A list saved for the first
    time has no old version and counts as changed."""
    flags = {}
    for name, old, new in (("same_sub", old_sub, new_sub), ("same_key", old_key, new_key)):
        flags[name] = F.lit(False) if old is None else same_flag(old, new, name).scalar()
    one = new_sub.sparkSession.range(1)
    return one.select(*[flag.alias(name) for name, flag in flags.items()]).withColumn(
        "both_same", F.col("same_sub") & F.col("same_key")
    )


def _row_hash(columns: list[str], seed: int) -> Column:
    """A hash of a row that tells NULL from every value, and columns apart."""
    parts = [part for c in columns for part in (F.col(c).isNull(), F.col(c))]
    # Sums of hashes may exceed 64 bits.
    return F.xxhash64(F.lit(seed), *parts).cast("decimal(38,0)")


def list_fingerprint(df: DataFrame) -> DataFrame:
    """One row (n, a, b) that is the same for lists of the same rows in any order:
    the number of rows and two sums of 64-bit hashes.

    One scan, added up before anything is shuffled; no value leaves its task. Two
    lists that differ have the same fingerprint with a chance of about 2 ** -128.
    """
    a, b = (F.coalesce(F.sum(_row_hash(df.columns, seed)), F.lit(0)).cast("string") for seed in (1, 2))
    return df.agg(F.count("*").alias("n"), a.alias("a"), b.alias("b"))


def same_fingerprint(old: DataFrame, new: DataFrame, name: str) -> DataFrame:
    """One row, one boolean: two fingerprints are the same."""
    left, right = old.toDF("n", "a", "b"), new.toDF("m", "c", "d")
    same = (F.col("n") == F.col("m")) & (F.col("a") == F.col("c")) & (F.col("b") == F.col("d"))
    return left.crossJoin(F.broadcast(right)).select(same.alias(name))


def row_changes(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """The keys whose rows differ between two versions of a table, with `change`:
    inserted, updated or deleted.

    One pass over both: each row sends its key and a hash, added up per task. A
    key that stands in several rows is updated if their multiset differs. NULL
    keys are equal to each other.
    """
    columns = before.columns
    if set(columns) != set(after.columns):
        raise ValueError(f"versions differ in their columns: {columns} and {after.columns}")

    def hashed(df: DataFrame, side: int) -> DataFrame:
        return df.select(*keys, F.lit(side).alias("_side"), _row_hash(columns, 1).alias("_a"), _row_hash(columns, 2).alias("_b"))

    old, new = F.col("_side") == 0, F.col("_side") == 1
    sums = {
        f"_{name}{i}": F.sum(F.when(side, F.col(name)).otherwise(F.lit(0).cast("decimal(38,0)")))
        for name in ("_a", "_b") for i, side in enumerate((old, new))
    }
    found = hashed(before, 0).unionAll(hashed(after, 1)).groupBy(*keys).agg(
        F.count_if(old).alias("_n0"), F.count_if(new).alias("_n1"), *[c.alias(name) for name, c in sums.items()]
    )
    differs = reduce(lambda a, b: a | b, [F.col(f"_{x}0") != F.col(f"_{x}1") for x in ("n", "_a", "_b")])
    change = F.when(F.col("_n0") == 0, "inserted").when(F.col("_n1") == 0, "deleted").otherwise("updated")
    return found.where(differs).select(*keys, change.alias("change"))

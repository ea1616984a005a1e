"""Training rows of the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def remainder(id_col: str, parts: int):
    """crc32 of the id as text, modulo `parts`; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts))


def training_rows(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    parts: int,
    held_out: int,
    limit: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """At most `limit` labelled rows (id, text, label) that may be learnt from.

    The rows with the smallest hashes of their ids are taken, half of them per
    class as far as there are, so the sample is the same on every run. Labels
    other than 0 and 1, null ids and rows held out are left out; an id labelled
    twice has its larger label, a document repeated its smallest text.
    """
    usable = (
        labels.select(F.col("doc_id").cast("bigint").alias("id"), F.col(label).cast("int").alias("label"))
        .where("id is not null and label in (0, 1)")
        .where(remainder("id", parts) != held_out)
        .groupBy("id").agg(F.max("label").alias("label"))
    )
    order = F.xxhash64("id", F.lit(17))
    halves = [usable.where(F.col("label") == y).orderBy(order, "id").limit(limit // 2) for y in (0, 1)]
    chosen = F.broadcast(halves[0].unionAll(halves[1]))  # at most `limit` rows of 12 bytes
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(chosen, "id").groupBy("id", "label").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))


def class_shares(labels: DataFrame, label: str, parts: int, held_out: int) -> float:
    """The share of label 1 among all rows that may be learnt from."""
    rows = labels.where(F.col(label).isin(0, 1) & (remainder("doc_id", parts) != held_out))
    return rows.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0

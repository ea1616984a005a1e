"""Exact deduplication by a content sort.

Rows are range-partitioned by (first bytes of the normalised text, a 64-bit
hash of it, id) at sampled splitters, sorted inside each partition by Spark's
external sort, and compared in full with their neighbours. As the id is part
of the key, a text with any number of copies is spread over as many partitions
as it needs; the runs at a partition's two ends are joined afterwards through
their digests, a few rows per partition.

Normalisation lower-cases A-Z only; a null text counts as empty.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.texts import SPARK_SEED, arrow_schema, digests, map_batches, map_texts, record_batch
from tidewatch.session import cut
from tidewatch.sizes import broadcast_if

PREFIX_BYTES = 16
# Rows of one run held back until its end is seen; a longer one is passed on
# in parts that are joined like the ends of a partition.
RUN_ROWS = 100_000
OUT_ROWS = 20_000


def _normalised(ids: pa.Array, texts: list[bytes]) -> dict:
    lowered = [x.lower() for x in texts]
    return {
        "id": ids,
        "raw": digests(texts, SPARK_SEED),
        "prefix": [x[:PREFIX_BYTES] for x in lowered],
        "key": digests(lowered),
        "body": lowered,
    }


_RUNS = "id bigint, raw bigint, digest string, part bigint, n bigint, keep_id bigint, keep boolean, open boolean"


class _Runs:
    """Runs of equal texts in one sorted partition, ready for output."""

    def __init__(self, schema: pa.Schema, largest: bool, partition: int):
        self.schema = schema
        self.largest = largest
        self.next_part = partition << 32
        self.rows = {name: [] for name in schema.names}

    def add(self, ids: list, raws: list, digest: str, is_open: bool) -> None:
        n, at = len(ids), len(ids) - 1 if self.largest else 0
        rows = self.rows
        rows["id"] += ids
        rows["raw"] += raws
        rows["digest"] += [digest] * n
        rows["part"] += [self.next_part] * n
        rows["n"] += [n] * n
        rows["keep_id"] += [ids[at]] * n
        rows["keep"] += [i == at for i in range(n)]
        rows["open"] += [is_open] * n
        self.next_part += 1

    def __len__(self) -> int:
        return len(self.rows["id"])

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, {name: [] for name in self.rows}
        return record_batch(rows, self.schema)


def _runs(batches, schema: pa.Schema, largest: bool):
    """Rows of a sorted partition with the size and the kept row of their run.

    `open` marks runs that may go on elsewhere: all with the (prefix, key) of
    the partition's first or last row, and the parts of a run cut for length.
    """
    out = _Runs(schema, largest, TaskContext.get().partitionId())
    first = place = text = None
    ids, raws, digest, was_cut = [], [], "", False
    held = []  # runs with the (prefix, key) now being read: open if it is the last one
    held_rows = 0
    for batch in batches:
        columns = (batch.column(i).to_pylist() for i in range(batch.num_columns))
        for doc, raw, prefix, key, body in zip(*columns, strict=True):
            new_place, new_text = (prefix, key) != place, body != text
            if ids and (new_place or new_text or len(ids) >= RUN_ROWS):
                was_cut |= not (new_place or new_text)
                held.append((ids, raws, digest, was_cut or place == first))
                held_rows += len(ids)
                ids, raws = [], []
            if new_place:
                for run in held:
                    out.add(*run)
                held, held_rows = [], 0
                place = prefix, key
                first = first or place
            elif held_rows >= RUN_ROWS:
                for run in held:
                    out.add(*run[:3], True)
                held, held_rows = [], 0
            if new_place or new_text:
                digest, was_cut, text = hashlib.sha256(body).hexdigest(), False, body
            ids.append(doc)
            raws.append(raw)
            if len(out) >= OUT_ROWS:
                yield out.batch()
    for run in [*held, (ids, raws, digest, True)] if ids else []:
        out.add(*run[:3], True)
    if len(out):
        yield out.batch()


def copy_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", largest: bool = True) -> DataFrame:
    """One row per row of `docs`: id, raw (hash of the text as it stands),
    digest (SHA-256 of the normalised text), n (rows of the group), keep_id,
    keep (true for the one row of the group that stays).

    Of equal texts the row with the largest id stays, or the smallest if
    `largest` is false. Ties: of repeated rows with that id exactly one stays.
    A null id orders below all others, so it stays only among null ids
    (above all others if `largest` is false). An empty table gives an empty one.
    """
    keyed = map_texts(docs, _normalised, "id bigint, raw bigint, prefix binary, key bigint, body binary", id_col, text_col)
    order = F.col("id").asc_nulls_first() if largest else F.col("id").asc_nulls_last()
    placed = keyed.repartitionByRange("prefix", "key", order).sortWithinPartitions("prefix", "key", "body", order, "raw")
    shape = docs.sparkSession.createDataFrame([], _RUNS).schema
    arrow = arrow_schema(shape)
    found = cut(map_batches(placed, lambda batches: _runs(batches, arrow, largest), shape))

    # Open runs are a few per partition, so their sums are a table with no more
    # rows than that, whatever the size of the data; they are counted all the same.
    best = F.max_by if largest else F.min_by
    rank = F.struct(F.coalesce(F.col("keep_id"), F.lit(-(1 << 63) if largest else (1 << 63) - 1)), F.col("part"))
    sums = cut(
        found.where("open and keep").groupBy("digest")
        .agg(F.sum("n").alias("all_n"), best("keep_id", rank).alias("all_keep"), best("part", rank).alias("all_part"),
             F.count("*").alias("parts"))
        .where("parts > 1").drop("parts")
    )
    joined = found.join(broadcast_if(sums, sums.count()), "digest", "left")
    alone = F.col("all_n").isNull()
    return joined.select(
        "id", "raw", "digest",
        F.when(alone, F.col("n")).otherwise(F.col("all_n")).alias("n"),
        F.when(alone, F.col("keep_id")).otherwise(F.col("all_keep")).alias("keep_id"),
        (F.col("keep") & (alone | (F.col("part") == F.col("all_part")))).alias("keep"),
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", largest: bool = True) -> DataFrame:
    """`docs` with one row of each group of equal texts, all columns as they are.

    Rows are told apart by id and text. Of rows repeated with both equal one
    stays. Null ids and texts are values like any other.
    """
    groups = copy_groups(docs, id_col, text_col, largest)
    kept = groups.groupBy("id", "raw").agg(F.max("keep").alias("keep"), F.count("*").alias("times"))
    kept = cut(kept.where("not keep or times > 1"))
    return less(docs, kept, id_col, text_col)


def less(docs: DataFrame, marks: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`docs` without the rows marked `keep` = false; rows marked `times` > 1 once."""
    mark = marks.select(*(F.col(c).alias(f"_mark_{c}") for c in ("id", "raw", "keep", "times")))
    raw = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    on = F.col(id_col).cast("bigint").eqNullSafe(F.col("_mark_id")) & (raw == F.col("_mark_raw"))
    n = mark.count()
    dropped = docs.join(broadcast_if(mark, n), on, "left_anti")
    repeated = mark.where("_mark_keep")
    if repeated.isEmpty():
        return dropped
    once = docs.join(broadcast_if(repeated.select("_mark_id", "_mark_raw"), n), on, "left_semi")
    return dropped.unionByName(once.dropDuplicates([id_col, text_col]))

"""Size checks that decide whether a side of a join may be broadcast."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Upper bounds for a broadcast side. Narrow key frames stay far below the
# byte bound at this many rows.
MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class Size:
    """Measured size of a frame; `rows` is exact up to MAX_BROADCAST_ROWS."""

    rows: int
    bytes: int

    @property
    def broadcastable(self) -> bool:
        return self.rows <= MAX_BROADCAST_ROWS and self.bytes <= MAX_BROADCAST_BYTES


def measure(*frames: DataFrame) -> list[Size]:
    """Rows and text bytes of each frame, reading no more than the bound.

    Meant for lists a person keeps (watch lists, lexicons), not for data. One
    job, whose single task sees at most MAX_BROADCAST_ROWS + 1 rows per frame.
    """
    widths = []
    for i, df in enumerate(frames):
        texts = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns]
        width = reduce(lambda a, b: a + b, texts).cast("bigint").alias("width")
        widths.append(df.limit(MAX_BROADCAST_ROWS + 1).select(F.lit(i).alias("frame"), width))
    found = (
        reduce(DataFrame.unionAll, widths)
        .coalesce(1)
        .groupBy("frame")
        .agg(F.count("*").alias("rows"), F.sum("width").alias("bytes"))
        .collect()
    )
    sizes = {row["frame"]: Size(row["rows"], row["bytes"]) for row in found}
    return [sizes.get(i, Size(0, 0)) for i in range(len(frames))]


def broadcast_if(df: DataFrame, max_rows: int | None) -> DataFrame:
    """Hint a broadcast when `max_rows`, a proven upper bound on the rows of
    the narrow frame `df`, is known and small. Otherwise leave the join to
    Spark (sort-merge with AQE skew handling)."""
    if max_rows is not None and max_rows <= MAX_BROADCAST_ROWS:
        return F.broadcast(df)
    return df

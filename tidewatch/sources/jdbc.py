"""Writing finished tables to a SQL database."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.sqltypes import column_types

BATCH_SIZE = 1000
MAX_CONNECTIONS = 16
# Column names that differ in the database.
RENAMES = {"key": "keyword"}


def sync_frame(df: DataFrame, renames: dict[str, str] = RENAMES) -> DataFrame:
    """The rows as the database gets them, columns renamed."""
    for old, new in renames.items():
        if old in df.columns:
            df = df.withColumnRenamed(old, new)
    return df


def sync_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    batchsize: int = BATCH_SIZE,
    max_connections: int = MAX_CONNECTIONS,
    truncate: bool = False,
) -> None:
    """Replace `table` with `df`. `truncate` keeps a table made beforehand
    (see `functions.sqltypes.create_table`) instead of recreating it.

    Spark writes one transaction per partition; `max_connections` bounds how
    many run at once. A task that is retried after its commit would insert its
    rows twice, so the stored count is compared with the frame's afterwards.
    `df` should be a stored table, as it is counted and written.
    """
    options = {"url": url, "dbtable": table, **(properties or {})}
    (
        df.write.format("jdbc")
        .options(**options, batchsize=batchsize, numPartitions=max_connections, truncate=truncate)
        .mode("overwrite")
        .save()
    )
    expected = df.count()
    stored = df.sparkSession.read.format("jdbc").options(**options).load().count()
    if stored != expected:
        raise RuntimeError(f"{table}: wrote {expected} rows, found {stored}")


def column_report(df: DataFrame, table: str, compat: bool = False) -> DataFrame:
    """One row per column: its target type and the longest text stored in it
    (NULL for other columns). Shows which texts a fixed width would cut."""
    kinds = column_types(df.schema, compat)
    texts = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    longest = df.agg(
        *[
            F.max(F.length(F.col(name)) if name in texts else F.lit(None).cast("int")).alias(f"_{i}")
            for i, (name, _) in enumerate(kinds)
        ]
    )
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("sql_type"),
            F.col(f"_{i}").alias("max_chars"),
        )
        for i, (name, kind) in enumerate(kinds)
    ]
    return longest.select(F.inline(F.array(*rows))).select(F.lit(table).alias("table_name"), "*")

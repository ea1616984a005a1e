"""The same versioned tables on Delta Lake, where its package is installed.

Offers the methods of `SnapshotTables` that the full run uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.merge import differs
from tidewatch.sources.files import path_exists, remove
from tidewatch.sources.tables import require_same_schema


def _delta_table():
    try:
        from delta.tables import DeltaTable
    except ImportError as error:
        raise RuntimeError("the delta-spark package is not installed") from error
    return DeltaTable


class DeltaTables:
    def __init__(self, spark: SparkSession, root: str):
        self.delta = _delta_table()
        self.spark = spark
        self.root = root.rstrip("/")

    def _folder(self, table: str) -> str:
        return f"{self.root}/{table}"

    def exists(self, table: str) -> bool:
        return self.delta.isDeltaTable(self.spark, self._folder(table))

    def latest(self, table: str) -> int | None:
        if not self.exists(table):
            return None
        return self.delta.forPath(self.spark, self._folder(table)).history(1).select("version").first()[0]

    def read(self, table: str, version: int | None = None) -> DataFrame:
        reader = self.spark.read.format("delta")
        if version is not None:
            reader = reader.option("versionAsOf", version)
        return reader.load(self._folder(table))

    def overwrite(self, df: DataFrame, table: str, same_schema: bool = False) -> int:
        if same_schema and self.exists(table):
            require_same_schema(self.read(table).schema, df.schema, table)
        df.write.format("delta").mode("overwrite").option("overwriteSchema", not same_schema).save(
            self._folder(table)
        )
        return self.latest(table)

    def merge(
        self,
        source: DataFrame,
        table: str,
        keys: list[str],
        null_safe: bool = False,
        max_source: int | None = None,
    ) -> int:
        values = [c for c in source.columns if c not in keys]
        on = " AND ".join(f"target.`{k}` = source.`{k}`" for k in keys)
        changed = differs([(F.col(f"target.`{c}`"), F.col(f"source.`{c}`")) for c in values], null_safe)
        (
            self.delta.forPath(self.spark, self._folder(table))
            .alias("target")
            .merge(source.alias("source"), on)
            .whenMatchedUpdate(condition=changed, set={c: f"source.`{c}`" for c in values})
            .whenNotMatchedInsertAll()
            .execute()
        )
        return self.latest(table)

    def drop(self, table: str) -> None:
        if path_exists(self.spark, self._folder(table)):
            remove(self.spark, self._folder(table))

    def counts(self, table: str, versions: list[int]) -> DataFrame:
        latest = self.latest(table)
        rows = [
            (v, self.read(table, v).count()) for v in versions if latest is not None and 0 <= v <= latest
        ]
        return self.spark.createDataFrame(rows, "version bigint, n bigint")

"""Numbered versions of tables as plain Parquet folders.

    <root>/<table>/base=<b>/part=<v>/

An overwrite to version v starts a new base with part v. An append to version
v adds part v to the current base. Version v is all parts <= v of its base, so
reading one version lists only its own folders, and adding rows does not
rewrite the table.

A version counts once Spark's commit marker is in its folder. A write that
dies half way leaves no marker; the next write takes the same number and
replaces the remains. Two writers at once on one table are not safe.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.changes import row_changes
from tidewatch.operators.merge import matched_keys, merge_upsert
from tidewatch.sources.files import list_glob, path_exists, remove
from tidewatch.sources.tables import require_same_schema

_PART = re.compile(r"/base=(\d+)/part=(\d+)/_SUCCESS$")


class SnapshotTables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _folder(self, table: str) -> str:
        return f"{self.root}/{table}"

    def versions(self, table: str) -> dict[int, int]:
        """Committed versions, each with its base."""
        found = {}
        for path in list_glob(self.spark, f"{self._folder(table)}/base=*/part=*/_SUCCESS"):
            base, part = map(int, _PART.search(path).groups())
            found[part] = base
        return dict(sorted(found.items()))

    def exists(self, table: str) -> bool:
        return bool(self.versions(table))

    def latest(self, table: str) -> int | None:
        return max(self.versions(table), default=None)

    def history(self, table: str) -> DataFrame:
        """(version, base), one row per committed version."""
        rows = list(self.versions(table).items())
        return self.spark.createDataFrame(rows, "version bigint, base bigint")

    def read(self, table: str, version: int | None = None, since: int | None = None) -> DataFrame:
        """The table as of `version` (default: latest). With `since`, only the
        rows added after that version, which must share the base."""
        versions = self.versions(table)
        if not versions:
            raise ValueError(f"no such table: {table}")
        version = max(versions) if version is None else version
        if version not in versions:
            raise ValueError(f"{table} has no version {version}")
        base = versions[version]
        if since is not None and versions.get(since) != base:
            raise ValueError(f"{table}: versions {since} and {version} do not share a base")
        parts = [v for v, b in versions.items() if b == base and v <= version]
        added = [v for v in parts if since is None or v > since]
        df = self.spark.read.parquet(*[self._part(table, base, v) for v in added or parts[:1]])
        return df if added else df.limit(0)

    def same_base(self, table: str, one: int, other: int) -> bool:
        versions = self.versions(table)
        return one in versions and versions.get(one) == versions.get(other)

    def changes(self, table: str, before: int, after: int, keys: list[str]) -> DataFrame:
        """The keys that version `after` has inserted, updated or deleted since
        `before`, with `change`. Of versions that share a base only the rows
        between them are read, which are new ones; others are compared."""
        if before <= after and self.same_base(table, before, after):
            return self.read(table, after, since=before).select(*keys, F.lit("inserted").alias("change"))
        return row_changes(self.read(table, before), self.read(table, after), keys)

    def _part(self, table: str, base: int, part: int) -> str:
        return f"{self._folder(table)}/base={base}/part={part}"

    def _next(self, table: str) -> int:
        latest = self.latest(table)
        return 0 if latest is None else latest + 1

    def overwrite(self, df: DataFrame, table: str, same_schema: bool = False) -> int:
        """Write `df` as the next version. Safe while `df` reads the table."""
        if same_schema and self.exists(table):
            require_same_schema(self.read(table).schema, df.schema, table)
        version = self._next(table)
        df.write.mode("overwrite").parquet(self._part(table, version, version))
        return version

    def append(self, df: DataFrame, table: str) -> int:
        """Add the rows of `df` as the next version."""
        versions = self.versions(table)
        current = self.read(table)
        df = df.select(*current.columns)
        require_same_schema(current.schema, df.schema, table)
        version = max(versions) + 1
        df.write.mode("overwrite").parquet(self._part(table, versions[max(versions)], version))
        return version

    def merge(
        self,
        source: DataFrame,
        table: str,
        keys: list[str],
        null_safe: bool = False,
        max_source: int | None = None,
    ) -> int:
        """Merge `source` by key into the next version.

        If no key is stored yet, which is the usual case, only the new rows
        are written. `source` should be a stored table: it is read twice.
        """
        current = self.read(table)
        if matched_keys(current, source, keys, max_source).isEmpty():
            return self.append(source, table)
        merged = merge_upsert(current, source.select(*current.columns), keys, null_safe, max_source)
        return self.overwrite(merged, table)

    def drop(self, table: str) -> None:
        """Remove a table with all its versions; numbering starts again at 0."""
        if path_exists(self.spark, self._folder(table)):
            remove(self.spark, self._folder(table))

    def counts(self, table: str, versions: list[int]) -> DataFrame:
        """(version, n) for the given versions that exist. Reads no columns."""
        known = self.versions(table)
        frames = [
            self.read(table, v).agg(F.count("*").alias("n")).select(F.lit(v).cast("bigint").alias("version"), "n")
            for v in versions
            if v in known
        ]
        if not frames:
            return self.spark.createDataFrame([], "version bigint, n bigint")
        out = frames[0]
        for frame in frames[1:]:
            out = out.unionAll(frame)
        return out

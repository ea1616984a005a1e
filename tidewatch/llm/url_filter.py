"""URL filter over a sorted digest array.

The list's keys (host and path prefix in one string) are kept as a sorted array
of 64-bit xxHash digests, memory-mapped from a file that Spark hands to every
executor. A url's possible keys, its host and parent domains with the path cut
to the lengths that the list knows, are looked up by one vectorised binary
search per batch; a hit counts only if the stored string is the same.

A list beyond MAX_LIST_BYTES is not handed out; its keys are joined instead.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.texts import arrow_schema, map_batches, record_batch
from tidewatch.session import cut

MAX_LIST_BYTES = 256 << 20
ALLOW, BLOCK = "allow", "block"


def host_of(url: Column) -> Column:
    """What stands after the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case."""
    found = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What stands after the host up to `?`, `#` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


@dataclass
class DigestArray:
    """Sorted digests, where each one's string lies in `strings`, and its verdict."""

    digests: np.ndarray
    offsets: np.ndarray
    blocks: np.ndarray
    strings: np.ndarray
    lengths: list[int]

    @staticmethod
    def write(rows: list[tuple[bytes, int, bool]], target: str) -> None:
        """rows: (key, bytes of its path, whether it blocks)."""
        made = sorted((xxhash.xxh64_intdigest(key), key, block) for key, _, block in rows)
        lengths = sorted({n for _, n, _ in rows})
        head = np.array([len(made), len(lengths)], np.int64)
        offsets = np.cumsum([0, *(len(key) for _, key, _ in made)], dtype=np.int64)
        with open(target, "wb") as out:
            for part in (
                head,
                np.array(lengths, np.int64),
                np.array([d for d, _, _ in made], np.uint64),
                offsets,
                np.array([block for _, _, block in made], np.uint8),
            ):
                out.write(part.tobytes())
            out.writelines(key for _, key, _ in made)

    @classmethod
    def open(cls, path: str) -> DigestArray:
        data = np.memmap(path, np.uint8, "r")
        n, k = data[:16].view(np.int64)
        at = 16 + 8 * k
        digests = data[at : at + 8 * n].view(np.uint64)
        at += 8 * n
        offsets = data[at : at + 8 * (n + 1)].view(np.int64)
        at += 8 * (n + 1)
        return cls(digests, offsets, data[at : at + n], data[at + n :], data[16 : 16 + 8 * k].view(np.int64).tolist())

    def key(self, i: int) -> bytes:
        return self.strings[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def longest(self, hosts: list[bytes], paths: list[bytes]) -> tuple[list[bytes | None], list[bool]]:
        """The longest fitting key of each url (of equal ones that with the longer host), and whether it blocks."""
        owners, probes = [], []
        for owner, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            for domain in domains(host):
                own = [domain + path[:n] for n in self.lengths if n <= len(path)]
                probes += own
                owners += [owner] * len(own)
        rules: list[bytes | None] = [None] * len(hosts)
        blocks = [False] * len(hosts)
        if not probes or not len(self.digests):
            return rules, blocks
        digests = np.fromiter(map(xxhash.xxh64_intdigest, probes), np.uint64, len(probes))
        low = np.searchsorted(self.digests, digests)
        hits = np.flatnonzero(self.digests[np.minimum(low, len(self.digests) - 1)] == digests)
        for probe in hits:
            at = low[probe]
            while at < len(self.digests) and self.digests[at] == digests[probe]:
                if self.key(at) == probes[probe]:
                    owner = owners[probe]
                    if rules[owner] is None or len(rules[owner]) < len(probes[probe]):
                        rules[owner], blocks[owner] = probes[probe], bool(self.blocks[at])
                    break
                at += 1
        return rules, blocks


def domains(host: bytes) -> list[bytes]:
    """The host and its parent domains, longest first."""
    labels = host.split(b".")
    return [b".".join(labels[i:]) for i in range(len(labels))]


def url_filter(
    pages: DataFrame,
    rules: DataFrame,
    default: str = ALLOW,
    id_col: str = "page_id",
    url_col: str = "url",
    max_list_bytes: int = MAX_LIST_BYTES,
) -> DataFrame:
    """Per row of `pages`: id, host, path, rule (the longest rule that fits,
    else null) and verdict (the rule's, else `default`).

    rules: host, path, verdict ('allow' or 'block'). A rule fits its host and
    all subdomains if the url's path starts with the rule's. Of rules stated
    twice with different verdicts block counts; rules with a null are left out.
    A null url, or one without `://`, has an empty host and path. An empty list
    leaves every page to `default`.
    """
    spark = pages.sparkSession
    urls = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    parsed = pages.select(F.col(id_col).cast("bigint").alias("id"), host_of(urls).alias("host"), path_of(urls).alias("path"))
    listed = (
        rules.select("host", "path", "verdict").dropna()
        .groupBy("host", "path").agg(F.max(F.col("verdict") == BLOCK).alias("block"))
    )
    size = listed.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 24)).first()[0] or 0
    if size > max_list_bytes:
        return _joined(parsed, listed, default)
    rows = [(r["host"].encode() + r["path"].encode(), len(r["path"].encode()), r["block"]) for r in listed.toLocalIterator()]
    name = f"digests-{uuid.uuid4().hex}"
    local = os.path.join(tempfile.mkdtemp(prefix="tidewatch-list-"), name)
    DigestArray.write(rows, local)
    spark.sparkContext.addFile(local)  # Spark's file server takes it to the executors
    shape = spark.createDataFrame([], "id bigint, host string, path string, rule string, verdict string").schema
    arrow = arrow_schema(shape)

    def run(batches):
        array = DigestArray.open(SparkFiles.get(name))
        for batch in batches:
            hosts = batch.column(1).cast(pa.binary()).to_pylist()
            paths = batch.column(2).cast(pa.binary()).to_pylist()
            found, blocks = array.longest(hosts, paths)
            yield record_batch(
                {
                    "id": batch.column(0),
                    "host": batch.column(1),
                    "path": batch.column(2),
                    "rule": [None if r is None else r.decode() for r in found],
                    "verdict": [default if r is None else BLOCK if b else ALLOW for r, b in zip(found, blocks, strict=True)],
                },
                arrow,
            )

    return map_batches(parsed, run, shape)


def _joined(parsed: DataFrame, listed: DataFrame, default: str) -> DataFrame:
    """The same by an equi-join of the possible keys, for a list of any size."""
    pages = cut(parsed.withColumn("row", F.monotonically_increasing_id()))
    lengths = [r[0] for r in listed.select(F.length("path")).distinct().collect()]
    labels = F.split("host", r"\.")
    probes = (
        pages.select("row", "path", F.posexplode(labels).alias("from", "label"), labels.alias("labels"))
        .select("row", F.array_join(F.slice("labels", F.col("from") + 1, F.size("labels")), ".").alias("host"), "path",
                F.explode(F.array(*(F.lit(n) for n in lengths))).alias("n"))
        .where("n <= length(path)")
        .select("row", "host", F.substring("path", F.lit(1), F.col("n")).alias("path"))
    )
    fitting = probes.join(listed, ["host", "path"]).select(
        "row", "block", F.concat("host", "path").alias("rule"), F.length("host").alias("host_length")
    )
    order = F.struct(F.octet_length("rule"), F.col("host_length"))
    best = fitting.groupBy("row").agg(F.max_by("rule", order).alias("rule"), F.max_by("block", order).alias("block"))
    verdict = F.when(F.col("rule").isNull(), default).otherwise(F.when(F.col("block"), BLOCK).otherwise(ALLOW))
    return pages.join(best, "row", "left").select("id", "host", "path", "rule", verdict.alias("verdict"))

"""Texts as arrays: Arrow batches in slices, words, word hashes and shingles.

Texts are handled as UTF-8 bytes. Lower-casing A-Z, both word patterns and all
bytes of a multi-byte character (0x80 and above) can be told from single bytes,
so a text never has to be decoded. Null counts as empty.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.ship import ship

_LIBC = ctypes.CDLL(None)

# Bytes of text handled at a time; one longer text makes a slice of its own.
SLICE_BYTES = 2 << 20
# Bytes hashed at a time, or one longer word: few enough to stay in a core's cache.
HASH_BYTES = 1 << 17

_CODES = np.arange(256)
# Words of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ in lower-cased text.
LETTERS = ((_CODES >= 48) & (_CODES <= 57)) | ((_CODES >= 97) & (_CODES <= 122)) | (_CODES >= 128)
# Words of [^\x20\x09-\x0D]+.
NOT_BLANK = ~((_CODES == 32) | ((_CODES >= 9) & (_CODES <= 13)))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finalizer of SplitMix64)."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


# The seed of Spark's own xxhash64.
SPARK_SEED = 42


def digests(texts: list[bytes], seed: int = 0) -> np.ndarray:
    """64-bit xxHash of each text, as signed integers."""
    return np.fromiter((xxhash.xxh64_intdigest(x, seed) for x in texts), np.uint64, len(texts)).view(np.int64)


_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0xD1342543DE82EF95
_powers = {False: np.ones(1, np.uint64), True: np.ones(1, np.uint64)}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of an odd base, or of its inverse, modulo 2**64."""
    if len(_powers[inverse]) < n:
        size = max(256, 1 << (n - 1).bit_length())
        base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
        _powers[inverse] = np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)])
        np.multiply.accumulate(_powers[inverse], out=_powers[inverse])
    return _powers[inverse][:n]


def hashed_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the non-empty byte ranges [starts, ends) of `data`, in order
    and apart: sums of byte values by powers of the place in the range, read off
    running sums over a stretch of `data`."""
    out = np.empty(len(starts), np.uint64)
    low = 0
    while low < len(starts):
        base = int(starts[low])
        high = max(low + 1, int(np.searchsorted(ends, base + HASH_BYTES, "right")))
        first, last = starts[low:high] - base, ends[low:high] - base
        sums = np.zeros(last[-1] + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(np.take(_BYTE_VALUES, data[base : base + last[-1]]) * powers(int(last[-1])), out=sums[1:])
            # The inverse powers turn the place in the stretch into that in the range.
            out[low:high] = (sums[last] - sums[first]) * powers(int(first[-1]) + 1, True)[first] + (last - first).astype(np.uint64)
        low = high
    return mixed(out)


@dataclass
class Words:
    """The words of some lower-cased texts.

    `data` holds the texts' bytes one after another; word w is
    data[starts[w]:ends[w]]; text i has words bounds[i] to bounds[i + 1].
    """

    raw: bytes
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes], letters: np.ndarray) -> Words:
        raw = b"\n".join(texts).lower() + b"\n"
        data = np.frombuffer(raw, np.uint8)
        inside = letters[data]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            edges = np.concatenate([[0], edges])
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        starts, ends = edges[0::2], edges[1::2]
        return cls(raw, data, offsets, starts, ends, np.searchsorted(starts, offsets))

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def hashes(self) -> np.ndarray:
        return hashed_ranges(self.data, self.starts, self.ends) if len(self) else np.empty(0, np.uint64)

    def word(self, i: int) -> bytes:
        return self.raw[self.starts[i] : self.ends[i]]

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Order-sensitive hashes of every `size` consecutive word hashes."""
    if len(hashes) < size:
        return np.empty(0, np.uint64)
    out, done = None, 0
    with np.errstate(over="ignore"):
        # Those of 1, 2, 4 ... hashes, put together to `size` of them.
        part, width = hashes * np.uint64(_BASE), 1
        while True:
            factor = np.uint64(pow(_BASE, width, 1 << 64))
            if size & width:
                n = len(hashes) - done - width + 1
                out = part if out is None else out[:n] * factor + part[done : done + n]
                done += width
            if done == size:
                return mixed(out)
            part = part[:-width] * factor + part[width:]
            width *= 2


def slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, list[bytes]]]:
    """Row ranges of a batch of at most SLICE_BYTES of text (or one row), with their texts."""
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    lens = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
    total = np.cumsum(lens)
    low = 0
    while low < len(lens):
        done = total[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(total, done + SLICE_BYTES, "right")))
        yield low, high, [x or b"" for x in texts.slice(low, high - low).to_pylist()]
        low = high


def map_texts(
    docs: DataFrame,
    work: Callable[[pa.Array, list[bytes]], dict | None],
    schema: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Apply work(ids, texts) to slices of the id and text columns of `docs`.

    Only these two columns are read. `work` returns the columns of `schema`,
    of any one length, or None.
    """
    narrow = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    shape = docs.sparkSession.createDataFrame([], schema).schema
    arrow = arrow_schema(shape)

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for low, high, texts in slices(batch, "text"):
                columns = work(ids.slice(low, high - low), texts)
                if columns is not None:
                    yield record_batch(columns, arrow)

    return map_batches(narrow, run, shape)


def map_batches(df: DataFrame, work: Callable, schema) -> DataFrame:
    """mapInArrow by a function of this package."""
    ship(df.sparkSession)
    return df.mapInArrow(releasing(work), schema)


def releasing(work: Callable) -> Callable:
    """`work`, after which the memory that it no longer uses goes back to the system:
    a Python worker outlives its task and waits for others beside new ones."""

    def run(batches):
        try:
            yield from work(batches)
        finally:
            release_memory()

    return run


def release_memory() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(_LIBC, "malloc_trim", None)  # other libraries than glibc have none
    if trim is not None:
        trim(0)


def arrow_schema(shape) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(shape)


def record_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    arrays = []
    for field in schema:
        values = columns[field.name]
        if isinstance(values, np.ndarray) and values.dtype == np.uint64:
            values = values.view(np.int64)
        arrays.append(values.cast(field.type) if isinstance(values, pa.Array) else pa.array(values, type=field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def list_array(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """Rows of counts[i] consecutive values each."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    if values.dtype == np.uint64:
        values = values.view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))

"""Token counts by a map-side two-tier lookup.

A text is cut into pre-tokens that no token can cross, so its count is the sum
of theirs. The counts of the most frequent pre-tokens of the corpus are in a
hash table that is broadcast; the rest is encoded by the library and kept in a
bounded cache of the worker. Pre-tokens are never shuffled: the frequent ones
come from short lists, one per task, of what the task saw most.

For the SentencePiece model a space is part of the word behind it, so a text
may be cut before each run of spaces, and also before each line break as long
as no piece of the vocabulary holds one.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.texts import map_batches, map_texts, record_batch, slices

# Entries of the broadcast table; with keys of up to MAX_KEY bytes it takes
# less than 20 MB.
TABLE_ROWS = 50_000
# Rows each task names for the table, out of a running count that is thinned
# when it exceeds COUNTED entries.
TASK_ROWS = 2_000
COUNTED = 300_000
MAX_KEY = 64
# Entries of a worker's cache, about 60 MB.
CACHE_ROWS = 400_000

SPACE_MARK = "▁".encode()

_models: dict[str, sentencepiece.SentencePieceProcessor] = {}
_caches: dict[str, dict[bytes, int]] = {}
_tables: dict[str, tuple[Lengths, re.Pattern]] = {}


def model(path: str) -> sentencepiece.SentencePieceProcessor:
    """The model, read once a process."""
    if path not in _models:
        _models[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _models[path]


def pattern(path: str) -> re.Pattern:
    """Pre-tokens of b" " + text."""
    found = model(path)
    pieces = (found.id_to_piece(i) for i in range(found.vocab_size()))
    pieces = [p for p in pieces if "▁" in p.lstrip("▁") or "\n" in p]
    if any("▁" in p.lstrip("▁") for p in pieces):
        raise ValueError("a piece of this model spans words")
    return re.compile(rb" +[^ ]*" if pieces else rb" +[^ \n]*|\n[^ \n]*")


def pre_tokens(text: bytes, cut: re.Pattern) -> list[bytes]:
    if not text:
        return []
    return cut.findall(b" " + text.replace(SPACE_MARK, b" "))


def pre_token_length(token: bytes, encoder: sentencepiece.SentencePieceProcessor) -> int:
    """Tokens of one pre-token. The library puts a space before what it
    encodes; a pre-token that starts with one gives it up for that."""
    if token == b" ":
        return 1
    if token.startswith(b" "):
        return len(encoder.encode(token[1:].decode("utf-8", "replace")))
    return len(encoder.encode(token.decode("utf-8", "replace"))) - 1


class Lengths(dict):
    """The frequent pre-tokens' counts; others through the worker's cache."""

    def __init__(self, frequent: dict[bytes, int], path: str):
        super().__init__(frequent)
        self.encoder = model(path)
        self.cache = _caches.setdefault(path, {})

    def __missing__(self, token: bytes) -> int:
        found = self.cache.get(token)
        if found is None:
            found = pre_token_length(token, self.encoder)
            if len(token) <= MAX_KEY:
                if len(self.cache) >= CACHE_ROWS:
                    self.cache.clear()
                self.cache[token] = found
        return found


def frequent_lengths(docs: DataFrame, path: str, text_col: str = "text", rows: int = TABLE_ROWS) -> dict[bytes, int]:
    """Token counts of about the `rows` most frequent pre-tokens of all texts."""
    schema = pa.schema([("token", pa.binary()), ("n", pa.int64())])

    def thinned(counts: Counter, size: int) -> Counter:
        return Counter(dict(counts.most_common(size)))

    def run(batches):
        cut = pattern(path)
        counts: Counter = Counter()
        for batch in batches:
            for _, _, texts in slices(batch, "text"):
                for text in texts:
                    counts.update(pre_tokens(text, cut))
                    if len(counts) > COUNTED:
                        counts = thinned(counts, COUNTED // 2)
        top = [(t, n) for t, n in counts.most_common(TASK_ROWS) if len(t) <= MAX_KEY]
        yield record_batch({"token": [t for t, _ in top], "n": [n for _, n in top]}, schema)

    narrow = docs.select(F.col(text_col).cast("string").alias("text"))
    lists = map_batches(narrow, run, "token binary, n bigint")
    best = lists.groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(rows)
    encoder = model(path)
    return {bytes(row["token"]): pre_token_length(bytes(row["token"]), encoder) for row in best.collect()}


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: id, n_bytes (UTF-8), n_tokens. `path`: the model file,
    at the same place on every machine. Null and empty texts have no tokens;
    repeated rows and null ids are counted like any other."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, text_col))
    run_id = uuid.uuid4().hex

    def work(ids: pa.Array, texts: list[bytes]) -> dict:
        if run_id not in _tables:  # a worker serves one query after another
            _tables.clear()
            _tables[run_id] = Lengths(shared.value, path), pattern(path)
        lengths, cut = _tables[run_id]
        count = lengths.__getitem__
        return {
            "id": ids,
            "n_bytes": [len(t) for t in texts],
            "n_tokens": [sum(map(count, pre_tokens(t, cut))) for t in texts],
        }

    return map_texts(docs, work, "id bigint, n_bytes bigint, n_tokens bigint", id_col, text_col)

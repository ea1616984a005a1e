"""SentencePiece encoding and decoding with an Aho-Corasick automaton.

The automaton over all pieces reads a text once. At each position the output
links list the pieces that end there, longest first, and the best way to the
position is relaxed with them. For a unigram model the best way is the one with
the highest sum of scores (Viterbi). For a BPE model (as the given one) the
scores state an order of merges and no sum, so a piece extends the way to its
start only if merging keeps it and the way's last piece apart; exactly one way
to each position has that property, and it is what merging the text gives.

Texts are cut into pre-tokens, which no piece can span, and the ids of short
ones are kept in a bounded cache of the worker.
"""

from __future__ import annotations

import hashlib
from collections import deque
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewatch.llm.texts import arrow_schema, list_array, map_batches, map_texts, slices
from tidewatch.llm.token_counts import MAX_KEY, SPACE_MARK, pattern, pre_tokens

# Of each of the two generations of the cache; both take about 100 MB.
CACHE_ROWS = 300_000
PAIRS = 1_000_000
STEPS = 1_000_000
BPE, UNIGRAM = "bpe", "unigram"


@dataclass
class Pieces:
    """The pieces of a model and the automaton over them."""

    kind: str
    ids: dict[str, int]  # pieces that texts can hold
    scores: list[float]
    spelled: list[bytes]  # what each id stands for
    byte_ids: list[int]
    moves: list[dict[str, int]] = field(default_factory=lambda: [{}])
    fails: list[int] = field(default_factory=lambda: [0])
    ends: list[tuple[int, int]] = field(default_factory=lambda: [(-1, 0)])  # id and length of the longest piece
    outputs: list[int] = field(default_factory=lambda: [0])  # next shorter state with a piece
    cache: dict[bytes, bytes] = field(default_factory=dict)
    pairs: dict[tuple[str, str], bool] = field(default_factory=dict)
    unknown: float = 0.0  # score of a character without a piece
    names: dict[int, str] = field(default_factory=dict)
    steps: dict[tuple[int, str], int] = field(default_factory=dict)  # moves found over failure links
    ending: dict[int, list[str]] = field(default_factory=dict)
    older: dict[bytes, bytes] = field(default_factory=dict)

    @classmethod
    def load(cls, path: str, kind: str = BPE) -> Pieces:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids, spelled, byte_ids, scores = {}, [], [0] * 256, []
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            scores.append(model.get_score(i))
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                spelled.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i):
                spelled.append(b"")
            elif model.is_unknown(i):
                spelled.append(" ⁇ ".encode())
            else:
                ids[piece] = i
                spelled.append(piece.replace("▁", " ").encode())
        self = cls(kind, ids, scores, spelled, byte_ids, unknown=min(scores) - 10.0)
        self._build()
        return self

    def _build(self) -> None:
        self.names = {i: piece for piece, i in self.ids.items()}
        for piece, i in self.ids.items():
            state = 0
            for char in piece:
                if char not in self.moves[state]:
                    self.moves[state][char] = len(self.moves)
                    self.moves.append({})
                    self.fails.append(0)
                    self.ends.append((-1, 0))
                    self.outputs.append(0)
                state = self.moves[state][char]
            self.ends[state] = (i, len(piece))
        queue = deque(self.moves[0].values())
        while queue:
            state = queue.popleft()
            for char, target in self.moves[state].items():
                back = self.fails[state]
                while back and char not in self.moves[back]:
                    back = self.fails[back]
                self.fails[target] = self.moves[back].get(char, 0) if state else 0
                queue.append(target)
            back = self.fails[state]
            self.outputs[state] = back if self.ends[back][0] >= 0 else self.outputs[back]

    def merged(self, text: str) -> list[str]:
        """The text's symbols after all merges, best score first, leftmost of equal ones."""
        parts = list(text)
        while True:
            best = None
            for at in range(len(parts) - 1):
                i = self.ids.get(parts[at] + parts[at + 1])
                if i is not None and (best is None or self.scores[i] > best[0]):
                    best = self.scores[i], at
            if best is None:
                return parts
            at = best[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _apart(self, left: str, right: str) -> bool:
        found = self.pairs.get((left, right))
        if found is None:
            found = self.merged(left + right) == ([left, right] if left else [right])
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            self.pairs[left, right] = found
        return found

    def _next(self, state: int, char: str) -> int:
        moves, fails, start = self.moves, self.fails, state
        while state and char not in moves[state]:
            state = fails[state]
        state = moves[state].get(char, 0)
        if len(self.steps) >= STEPS:
            self.steps.clear()
        self.steps[start, char] = state
        return state

    def _ending(self, state: int) -> list[str]:
        """The pieces that end in a state, longest first, along the output links."""
        at = state if self.ends[state][0] >= 0 else self.outputs[state]
        found = []
        while at:
            found.append(self.ends[at][0])
            at = self.outputs[at]
        return [self.names[i] for i in found]

    def ways(self, text: str) -> list[str]:
        """The text cut into pieces, unknown characters on their own."""
        last = [""] * (len(text) + 1)  # the last symbol of the best way to each position
        ending, steps = self.ending, self.steps
        if self.kind == BPE:
            self._relaxed_by_merges(text, last, ending, steps)
        else:
            self._relaxed_by_sums(text, last, ending, steps)
        if text and not last[-1]:
            return self.merged(text)
        parts, end = [], len(text)
        while end:
            parts.append(last[end])
            end -= len(last[end])
        return parts[::-1]

    def _relaxed_by_merges(self, text: str, last: list[str], ending: dict, steps: dict) -> None:
        pairs, state = self.pairs, 0
        for end, char in enumerate(text, 1):
            new = steps.get((state, char))
            state = self._next(state, char) if new is None else new
            pieces = ending.get(state)
            if pieces is None:
                pieces = ending[state] = self._ending(state)
            # A character that is no piece stands on its own unless merged.
            for piece in pieces if pieces and len(pieces[-1]) == 1 else [*pieces, char]:
                start = end - len(piece)
                left = last[start]
                if left or not start:
                    apart = pairs.get((left, piece))
                    if self._apart(left, piece) if apart is None else apart:
                        last[end] = piece
                        break

    def _relaxed_by_sums(self, text: str, last: list[str], ending: dict, steps: dict) -> None:
        sums = [0.0] + [-np.inf] * len(text)
        state = 0
        for end, char in enumerate(text, 1):
            new = steps.get((state, char))
            state = self._next(state, char) if new is None else new
            pieces = ending.get(state)
            if pieces is None:
                pieces = ending[state] = self._ending(state)
            for piece in pieces if pieces and len(pieces[-1]) == 1 else [*pieces, char]:
                i = self.ids.get(piece)
                total = sums[end - len(piece)] + (self.unknown if i is None else self.scores[i])
                if total > sums[end]:
                    sums[end], last[end] = total, piece

    def encoded(self, token: bytes) -> bytes:
        """The ids of a pre-token as 32-bit numbers."""
        found = self.cache.get(token)
        if found is None:
            found = self.older.get(token)
            if found is None:
                found = self._encoded(token)
            if len(token) <= MAX_KEY:
                if len(self.cache) >= CACHE_ROWS:
                    self.older, self.cache = self.cache, {}
                self.cache[token] = found
        return found

    def _encoded(self, token: bytes) -> bytes:
        ids: list[int] = []
        for part in self.ways(token.decode("utf-8", "replace").replace(" ", "▁")):
            i = self.ids.get(part)
            ids += [i] if i is not None else [self.byte_ids[b] for b in part.encode()]
        return np.array(ids, "<i4").tobytes()

    def decoded(self, ids: list[int]) -> bytes:
        """The text of some ids: without the space put before it, bytes that are no UTF-8 replaced."""
        text = b"".join(map(self.spelled.__getitem__, ids)).removeprefix(b" ")
        try:
            text.decode()
        except UnicodeDecodeError:
            text = text.decode("utf-8", "replace").encode()
        return text


_loaded: dict[tuple[str, str], tuple[Pieces, object]] = {}


def loaded(path: str, kind: str = BPE) -> tuple[Pieces, object]:
    """Pieces and pre-token pattern, built once a worker."""
    if (path, kind) not in _loaded:
        _loaded[path, kind] = Pieces.load(path, kind), pattern(path)
    return _loaded[path, kind]


def text_ids(text: bytes, pieces: Pieces, cut) -> np.ndarray:
    return np.frombuffer(b"".join(map(pieces.encoded, pre_tokens(text, cut))), "<i4")


def with_ids(docs: DataFrame, path: str, kind: str = BPE, text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
    """`docs` with the ids of each text as an array column; a null or empty text
    has an empty array. A column of that name that is there already is replaced."""
    kept = docs.drop(ids_col)
    schema = T.StructType([*kept.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType(), False), False)])
    arrow = arrow_schema(schema)

    def run(batches):
        pieces, cut = loaded(path, kind)
        for batch in batches:
            for low, high, texts in slices(batch, text_col):
                ids = [text_ids(t, pieces, cut) for t in texts]
                joined = np.concatenate(ids) if ids else np.empty(0, np.int32)
                column = list_array(joined, np.array([len(x) for x in ids], np.int64))
                columns = [*batch.slice(low, high - low).columns, column.cast(arrow.field(ids_col).type)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return map_batches(kept, run, schema)


def with_text(coded: DataFrame, path: str, ids_col: str = "token_ids", text_col: str = "text") -> DataFrame:
    """`coded` with the text of its ids in `text_col`, added or replaced; null ids give an empty text."""
    kept = coded.drop(text_col)
    schema = T.StructType([*kept.schema.fields, T.StructField(text_col, T.StringType(), True)])
    arrow = arrow_schema(schema)
    at = kept.columns.index(ids_col)

    def run(batches):
        pieces, _ = loaded(path)
        for batch in batches:
            texts = [pieces.decoded(x.values.tolist() if x.is_valid else []) for x in batch.column(at)]
            column = pa.array([t.decode() for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], schema=arrow)

    return map_batches(kept, run, schema)


def round_trips(docs: DataFrame, path: str, kind: str = BPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: id, n_bytes, n_tokens, ids_sha256 (of the ids as
    32-bit little-endian numbers), text_sha256 (of the decoded text) and
    round_trip (whether that is the text, U+2581 read as a space). Null counts as empty."""

    def work(ids: pa.Array, texts: list[bytes]) -> dict:
        pieces, cut = loaded(path, kind)
        found = [text_ids(t, pieces, cut) for t in texts]
        back = [pieces.decoded(x.tolist()) for x in found]
        return {
            "id": ids,
            "n_bytes": [len(t) for t in texts],
            "n_tokens": [len(x) for x in found],
            "ids_sha256": [hashlib.sha256(x.tobytes()).hexdigest() for x in found],
            "text_sha256": [hashlib.sha256(t).hexdigest() for t in back],
            "round_trip": [a.replace(SPACE_MARK, b" ") == b for a, b in zip(texts, back, strict=True)],
        }

    return map_texts(
        docs, work,
        "id bigint, n_bytes bigint, n_tokens bigint, ids_sha256 string, text_sha256 string, round_trip boolean",
        id_col, text_col,
    )

"""Benchmark decontamination with a generalised suffix automaton.

The words of all benchmark items make one suffix automaton (Blumer et al.).
A document is streamed through it; after each word the state gives the longest
suffix that occurs in some item. Where that length reaches a window (`window`
words, or a whole shorter item), the window's words are hit.

Only stretches of a document whose every pair of neighbouring words stands
somewhere in the benchmark can hold a window, so the automaton reads these
stretches and no other words. They are found with sorted arrays of 64-bit
hashes; inside them the words themselves are looked up.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.texts import LETTERS, Words, arrow_schema, map_batches, map_texts, shingle_hashes, slices

WINDOW = 10
# Words of the items in one automaton. More items make more automata, each
# broadcast on its own; an automaton of this size takes about 1 GB to build
# and 200 MB to read, so a benchmark of 100,000 items fits one.
WORDS_PER_AUTOMATON = 1_000_000


@dataclass
class Automaton:
    """Transitions by (state, word), suffix links, longest lengths, and what a
    state means: the items its windows stand in, and the short items it ends."""

    vocabulary: dict[bytes, int]
    words: np.ndarray  # sorted hashes of single words that are whole items
    pairs: np.ndarray  # sorted hashes of neighbouring words
    shortest: int
    moves: list[dict[int, int]]
    links: list[int]
    lengths: list[int]
    items: dict[int, tuple[int, ...]]  # of states that hold the windows
    short: dict[int, tuple[int, tuple[int, ...]]]  # state of a whole short item: length, items
    window: int

    @classmethod
    def of(cls, items: list[tuple[int, bytes]], window: int) -> Automaton:
        vocabulary: dict[bytes, int] = {}
        sequences = []
        single, pairs = [], [np.empty(0, np.uint64)]
        for item, text in items:
            found = Words.of([text], LETTERS)
            if not len(found):
                continue
            words = [vocabulary.setdefault(found.word(i), len(vocabulary)) for i in range(len(found))]
            hashes = found.hashes()
            pairs.append(shingle_hashes(hashes, 2))
            if len(words) == 1:
                single.append(hashes[0])
            sequences.append((item, words))
        self = cls(vocabulary, np.unique(np.array(single, np.uint64)), np.unique(np.concatenate(pairs)),
                   min((min(len(w), window) for _, w in sequences), default=window), [{}], [-1], [0], {}, {}, window)
        for _, words in sequences:
            last = 0
            for word in words:
                last = self._extended(last, word)
        items_of: dict[int, set[int]] = {}
        short: dict[int, tuple[int, set[int]]] = {}
        for item, words in sequences:
            if len(words) < window:
                state = 0
                for word in words:
                    state = self.moves[state][word]
                short.setdefault(state, (len(words), set()))[1].add(item)
                continue
            for end, state in enumerate(self._states(words), 1):
                if end >= window:
                    while self.lengths[self.links[state]] >= window:
                        state = self.links[state]
                    items_of.setdefault(state, set()).add(item)
        self.items = {state: tuple(found) for state, found in items_of.items()}
        self.short = {state: (n, tuple(found)) for state, (n, found) in short.items()}
        return self

    def _new(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.moves.append(moves)
        self.lengths.append(length)
        self.links.append(link)
        return len(self.links) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """The state of the longest string that reaches `target` from `state`, made if needed."""
        if self.lengths[target] == self.lengths[state] + 1:
            return target
        copy = self._new(self.lengths[state] + 1, self.links[target], dict(self.moves[target]))
        self.links[target] = copy
        while state >= 0 and self.moves[state].get(word) == target:
            self.moves[state][word] = copy
            state = self.links[state]
        return copy

    def _extended(self, last: int, word: int) -> int:
        target = self.moves[last].get(word)
        if target is not None:
            return self._split(last, word, target)
        made = self._new(self.lengths[last] + 1, 0, {})
        while last >= 0 and word not in self.moves[last]:
            self.moves[last][word] = made
            last = self.links[last]
        if last >= 0:
            self.links[made] = self._split(last, word, self.moves[last][word])
        return made

    def _states(self, words: list[int]):
        state = 0
        for word in words:
            state = self.moves[state][word]
            yield state

    def hits(self, words: list[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit ranges [start, end) in a stretch of words, and the items that hit."""
        ranges, found = [], set()
        state = length = 0
        moves, links, lengths = self.moves, self.links, self.lengths
        for end, word in enumerate(words, 1):
            while state and word not in moves[state]:
                state = links[state]
                length = lengths[state]
            state = moves[state].get(word, 0)
            length = length + 1 if state else 0
            at = state
            if length >= self.window:
                while lengths[links[at]] >= self.window:
                    at = links[at]
                ranges.append((end - self.window, end))
                found.update(self.items[at])
            if self.short:
                at = state
                while at > 0:
                    if at in self.short and self.short[at][0] <= (length if at == state else lengths[at]):
                        n, items = self.short[at]
                        ranges.append((end - n, end))
                        found.update(items)
                    at = links[at]
        return ranges, found

    def search(self, words: Words) -> tuple[np.ndarray, list[set[int]]]:
        """Which words are hit, and the items found in each text."""
        hit = np.zeros(len(words), bool)
        found: list[set[int]] = [set() for _ in range(len(words.counts))]
        hashes = words.hashes()
        if len(self.words):
            for i in np.flatnonzero(_among(hashes, self.words)):
                self._read(words, i, i + 1, hit, found)
        if len(words) > 1 and len(self.pairs):
            joined = _among(shingle_hashes(hashes, 2), self.pairs)
            joined[words.bounds[1:-1][(words.bounds[1:-1] > 0) & (words.bounds[1:-1] < len(words))] - 1] = False
            edges = np.flatnonzero(np.diff(np.concatenate([[False], joined, [False]]).astype(np.int8)))
            least = max(1, self.shortest - 1)
            for start, end in zip(edges[0::2], edges[1::2], strict=True):
                if end - start >= least:
                    self._read(words, start, end + 1, hit, found)
        return hit, found

    def _read(self, words: Words, start: int, end: int, hit: np.ndarray, found: list[set[int]]) -> None:
        get = self.vocabulary.get
        ranges, items = self.hits([get(words.word(i), -1) for i in range(start, end)])
        for low, high in ranges:
            hit[start + low : start + high] = True
        if items:
            found[int(np.searchsorted(words.bounds, start, "right")) - 1] |= items


def _among(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = np.searchsorted(keys, values)
    at[at == len(keys)] = 0
    return keys[at] == values


def automata(benchmark: DataFrame, window: int, id_col: str = "item_id", text_col: str = "text") -> list:
    """Broadcast automata over all items. Items are sized first, so that each
    automaton, and what the driver reads at a time, is bounded."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(id_col).cast("bigint").alias("item"),
                             F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # A word takes two bytes or more with its separator.
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-total // (2 * WORDS_PER_AUTOMATON)))
    made = []
    for group in range(groups):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(groups)) == group).toLocalIterator()
        pairs = [(row["item"], row["text"].encode()) for row in rows]
        made.append(spark.sparkContext.broadcast(Automaton.of(pairs, window)))
    return made


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of `docs`: id, n_words, n_hit (words inside an occurrence of a
    window), n_items and items (the items with occurring windows, an array).

    A null or wordless text has no words; an empty benchmark hits nothing;
    repeated items count once by their id, those without an id together as one
    that n_items counts and that adds no name to items.
    """
    made = automata(benchmark, window)

    def work(ids: pa.Array, texts: list[bytes]) -> dict:
        words = Words.of(texts, LETTERS)
        hit = np.zeros(len(words), bool)
        found: list[set] = [set() for _ in texts]
        for automaton in made:
            more, items = automaton.value.search(words)
            hit |= more
            for own, new in zip(found, items, strict=True):
                own |= new
        summed = np.concatenate([[0], np.cumsum(hit)])
        names = [sorted(str(i) for i in own if i is not None) for own in found]
        return {
            "id": ids,
            "n_words": words.counts,
            "n_hit": np.diff(summed[words.bounds]),
            "n_items": [len(own) for own in found],
            "items": names,
            "items_sha256": [hashlib.sha256(",".join(x).encode()).hexdigest() for x in names],
        }

    return map_texts(
        docs, work, "id bigint, n_words bigint, n_hit bigint, n_items bigint, items array<string>, items_sha256 string",
        id_col, text_col,
    )


def decontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    max_coverage: float = 0.5,
    text_col: str = "text",
    size_col: str | None = None,
) -> DataFrame:
    """`docs` without the hit spans; documents of which more than
    `max_coverage` of the words are hit go. All columns are kept; texts that
    are not hit stay as they are, byte for byte. `size_col`, if `docs` has a
    numeric column of that name, gets the characters of a text that was cut.

    A span is cut from the start of its first word to the end of its last. A
    null text has no words and stays null.
    """
    made = automata(benchmark, window)
    schema = docs.schema
    arrow = arrow_schema(schema)
    at = docs.columns.index(text_col)
    size_at = docs.columns.index(size_col) if size_col in docs.columns else None

    def cleaned(batch: pa.RecordBatch):
        for low, high, texts in slices(batch, text_col):
            words = Words.of(texts, LETTERS)
            hit = np.zeros(len(words), bool)
            for automaton in made:
                hit |= automaton.value.search(words)[0]
            part = batch.slice(low, high - low)
            if hit.any():
                summed = np.concatenate([[0], np.cumsum(hit)])
                share = np.diff(summed[words.bounds]) / np.maximum(1, words.counts)
                new = part.column(at).to_pylist()
                sizes = part.column(size_at).to_pylist() if size_at is not None else []
                for i in np.flatnonzero(share > 0):
                    new[i] = _without(texts[i], words, i, hit)
                    if size_at is not None:
                        sizes[i] = len(new[i])
                part = part.set_column(at, arrow.field(at), pa.array(new, arrow.field(at).type))
                if size_at is not None:
                    part = part.set_column(size_at, arrow.field(size_at), pa.array(sizes, arrow.field(size_at).type))
                part = part.filter(pa.array(share <= max_coverage))
            yield part

    def run(batches):
        for batch in batches:
            yield from cleaned(batch)

    return map_batches(docs, run, schema)


def _without(text: bytes, words: Words, i: int, hit: np.ndarray) -> str:
    low, high = words.bounds[i], words.bounds[i + 1]
    base = words.offsets[i]
    own = np.concatenate([[False], hit[low:high], [False]]).astype(np.int8)
    edges = np.flatnonzero(np.diff(own))
    parts, done = [], 0
    for start, end in zip(edges[0::2], edges[1::2], strict=True):
        parts.append(text[done : words.starts[low + start] - base])
        done = words.ends[low + end - 1] - base
    parts.append(text[done:])
    return b"".join(parts).decode("utf-8")

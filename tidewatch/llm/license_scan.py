"""License scan: an exact set-similarity join of text blocks with templates.

A text is cut into overlapping blocks of words. A block meets a template when
it holds at least `containment` of the template's distinct words. The join
follows the prefix-filter family: words are ordered by their frequency in the
whole corpus, rare ones first; a block that meets a template holds one of the
first |T| - required + 1 words of it (prefix), at least `required` words of all
templates (length), and enough words not before the shared one (position).
What passes is verified by an exact intersection.

Base phrases take the same way with containment 1 and the whole text as the
block; their places, where the words stand next to each other, follow from it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewatch.llm.texts import LETTERS, Words, map_texts

BASE_PHRASES = {
    "cc-by": "cc by",
    "gpl": "general public license",
    "reserved": "all rights reserved",
}
# The wording of public license notices.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted"
    " provided that the following conditions are met",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "gpl-3": "licensed under the gnu general public license version 3",
    "mit": "released under the mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software"
    " and associated documentation files to deal in the software without restriction",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license version 2 0",
}
CONTAINMENT = 0.9
# A block starts every `step` words and holds twice as many, so step + 1
# consecutive words are always inside one block. Templates of up to STEP + 1
# words share blocks of STEP; a longer one has blocks of the next doubling of it.
STEP = 64


def step_of(n_words: int) -> int:
    """The step of the blocks for a template of so many words."""
    step = STEP
    while step + 1 < n_words:
        step *= 2
    return step


@dataclass
class Templates:
    """Templates and phrases over words numbered by corpus frequency."""

    vocabulary: list[bytes]  # rare first
    keys: np.ndarray  # sorted word hashes
    numbers: np.ndarray  # the word's number for each key
    names: list[str]
    sets: list[np.ndarray]  # sorted numbers
    required: list[int]
    prefixes: dict[int, dict[int, list[tuple[int, int]]]]  # step, word: (template, position in it)
    phrases: list[tuple[str, list[int], int]]  # label, words, place of the rarest

    @classmethod
    def of(cls, templates: dict, phrases: dict, containment: float, counts: dict[bytes, int]) -> Templates:
        vocabulary = sorted(_vocabulary(templates, phrases), key=lambda w: (counts.get(w, 0), w))
        number = {word: i for i, word in enumerate(vocabulary)}
        keys, numbers = _keyed(vocabulary)
        names, sets, required, prefixes = [], [], [], {}
        for name, text in templates.items():
            words = _split(text)
            own = np.unique([number[w] for w in words])
            if not len(own):
                continue
            first = prefixes.setdefault(step_of(len(words)), {})
            need = max(1, math.ceil(containment * len(own) - 1e-9))
            for position in range(len(own) - need + 1):
                first.setdefault(int(own[position]), []).append((len(names), position))
            names.append(name)
            sets.append(own)
            required.append(need)
        found = []
        for label, text in phrases.items():
            words = [number[w] for w in _split(text)]
            if words:
                found.append((label, words, words.index(min(words))))
        return cls(vocabulary, keys, numbers, names, sets, required, prefixes, found)

    def numbered(self, words: Words) -> np.ndarray:
        """The number of each word, or -1, by 64-bit hashes."""
        return _numbered(words, self.keys, self.numbers)

    def matches(self, step: int, block: np.ndarray, seen: list[int]) -> dict[int, float]:
        """Containment of the templates of `step` that a block meets. block: its
        distinct numbers, sorted; seen: those in a prefix."""
        found, tried = {}, set()
        for word in seen:
            for template, position in self.prefixes[step][word]:
                need, own = self.required[template], self.sets[template]
                if template in tried or len(block) < need:
                    continue
                # The rarest shared word: all others stand behind it in both.
                tried.add(template)
                at = int(np.searchsorted(block, word))
                if min(len(own) - position, len(block) - at) < need:
                    continue
                shared = len(np.intersect1d(block, own, assume_unique=True))
                if shared >= need:
                    found[template] = shared / len(own)
        return found


def _split(text: str) -> list[bytes]:
    words = Words.of([text.encode()], LETTERS)
    return [words.word(i) for i in range(len(words))]


def _vocabulary(templates: dict, phrases: dict) -> set[bytes]:
    return {w for text in [*templates.values(), *phrases.values()] for w in _split(text)}


def _keyed(vocabulary: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    if not vocabulary:
        return np.zeros(1, np.uint64), np.full(1, -1)
    hashes = Words.of([b" ".join(vocabulary)], LETTERS).hashes()
    order = np.argsort(hashes)
    return hashes[order], order


def _numbered(words: Words, keys: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    hashes = words.hashes()
    at = np.searchsorted(keys, hashes)
    at[at == len(keys)] = 0
    return np.where(keys[at] == hashes, numbers[at], -1)


def word_counts(docs: DataFrame, vocabulary: set[bytes], id_col: str, text_col: str) -> dict[bytes, int]:
    """Texts that hold each word of a bounded vocabulary, over all of `docs`."""
    listed = sorted(vocabulary)
    keys, numbers = _keyed(listed)

    def work(_: pa.Array, texts: list[bytes]) -> dict:
        words = Words.of(texts, LETTERS)
        found = _numbered(words, keys, numbers)
        at = np.flatnonzero(found >= 0)
        pairs = np.unique(words.owners()[at] * len(listed) + found[at])
        word, n = np.unique(pairs % max(1, len(listed)), return_counts=True)
        return {"word": word, "n": n}

    counts = map_texts(docs, work, "word bigint, n bigint", id_col, text_col)
    return {listed[r["word"]]: r["n"] for r in counts.groupBy("word").sum("n").toDF("word", "n").collect()}


def license_scan(
    docs: DataFrame,
    templates: dict[str, str] = TEMPLATES,
    phrases: dict[str, str] = BASE_PHRASES,
    containment: float = CONTAINMENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row of `docs`: id, n_words, n_base (places of base phrases),
    first_word and last_word (smallest and largest start of those places),
    base_labels and labels (distinct, sorted, comma-joined; labels with those of
    the templates), score (1 with a base phrase, else the highest containment
    of a template that is met, else 0) and matches (block start, template,
    containment).

    Templates are a list a person keeps, of any length: whole licence texts have
    longer blocks. A null, empty or wordless text
    has no places, empty labels and score 0.
    """
    counts = word_counts(docs, _vocabulary(templates, phrases), id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(Templates.of(templates, phrases, containment, counts))

    def work(ids: pa.Array, texts: list[bytes]) -> dict:
        return {"id": ids, **_scanned(Words.of(texts, LETTERS), shared.value)}

    return map_texts(
        docs,
        work,
        "id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string,"
        " labels string, score double, matches array<struct<start:bigint,template:string,containment:double>>",
        id_col,
        text_col,
    )


def _scanned(words: Words, known: Templates) -> dict:
    numbers = known.numbered(words)
    owners = words.owners()
    n = len(words.counts)
    places: list[list[int]] = [[] for _ in range(n)]
    base: list[set[str]] = [set() for _ in range(n)]
    for label, phrase, rarest in known.phrases:
        starts = np.flatnonzero(numbers == phrase[rarest]) - rarest
        starts = starts[(starts >= 0) & (starts + len(phrase) <= len(words))]
        for k, word in enumerate(phrase):
            starts = starts[(numbers[starts + k] == word) & (owners[starts + k] == owners[starts])]
        for start in starts:
            if any(words.word(start + k) != known.vocabulary[word] for k, word in enumerate(phrase)):
                continue  # other words with the same hash
            places[owners[start]].append(int(start - words.bounds[owners[start]]))
            base[owners[start]].add(label)

    matches: list[list[dict]] = [[] for _ in range(n)]
    for step, prefixes in known.prefixes.items():
        in_prefix = np.zeros(len(known.vocabulary) + 1, bool)
        in_prefix[list(prefixes)] = True
        blocks: dict[tuple[int, int], set[int]] = {}
        for i in np.flatnonzero(in_prefix[numbers]):
            owner = int(owners[i])
            block = int(i - words.bounds[owner]) // step
            for number in {block, max(0, block - 1)}:
                blocks.setdefault((owner, number), set()).add(int(numbers[i]))
        for (owner, block), seen in sorted(blocks.items()):
            low = words.bounds[owner] + block * step
            inside = range(low, min(low + 2 * step, words.bounds[owner + 1]))
            own = {int(numbers[i]) for i in inside if numbers[i] >= 0 and words.word(i) == known.vocabulary[numbers[i]]}
            own = np.array(sorted(own), np.int64)
            for template, share in sorted(known.matches(step, own, sorted(seen.intersection(own.tolist()))).items()):
                matches[owner].append({"start": block * step, "template": known.names[template], "containment": share})
    labels = [own | {m["template"] for m in met} for own, met in zip(base, matches, strict=True)]
    return {
        "n_words": words.counts,
        "n_base": [len(p) for p in places],
        "first_word": [min(p, default=None) for p in places],
        "last_word": [max(p, default=None) for p in places],
        "base_labels": [",".join(sorted(x)) for x in base],
        "labels": [",".join(sorted(x)) for x in labels],
        "score": [1.0 if own else max((m["containment"] for m in met), default=0.0)
                  for own, met in zip(base, matches, strict=True)],
        "matches": matches,
    }

"""Spelling variants by variable-length grams."""

import random
import zlib
from collections import Counter

import brute
import pytest
import re

from tidewatch.llm import spelling

LETTERS = "abcé÷"


def counted(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = brute.fold(run)
            code = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if code % 199 == 0:
                word = word[: code % len(word)] + word[code % len(word) + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(words):
    near = {w: [o for o in words if one_apart(w, o)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(((-words[o], o) for o in near[w]), default=None)
        form[w] = best[1] if best and -best[0] >= 5 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def check(frame, rows):
    got = [tuple(r) for r in spelling.spelling_variants(frame(rows)).collect()]
    assert len(got) == len(set(got))
    want = variants(counted(rows))
    assert set(got) == want
    return want


def mutated(rng, word):
    at, letter = rng.randrange(len(word) + 1), rng.choice(LETTERS)
    return rng.choice([word[:at] + letter + word[at:], word[:at] + word[at + 1 :], word[:at] + letter + word[at + 1 :]])


def some_words(rng, n):
    """Words of few letters, many of them one edit from another."""
    words = []
    for _ in range(n):
        if words and rng.random() < 0.7:
            words.append(mutated(rng, rng.choice(words)))
        else:
            words.append("".join(rng.choice(LETTERS) for _ in range(rng.randint(5, 12))))
    return words


def test_odd_rows(frame, odd):
    rows = odd + [(20, "Reading READING rEading " * 3), (21, "readng reading\nreadings " * 5), (None, "readxing " * 5), (22, "x" * 300_000)]
    check(frame, [*rows, *[(30 + i, "y" * 5000) for i in range(6)]])


def test_corpus(frame, corpus):
    want = check(frame, corpus + [(i + 10_000, t) for i, t in corpus[:50]])
    assert len(want) > 500


@pytest.mark.parametrize("seed", range(3))
def test_pairs_equal_brute_force(spark, seed, monkeypatch):
    """Words of few letters, where grams are frequent and bounds often say nothing."""
    monkeypatch.setattr(spelling, "FREQUENT", [3, 20, 10**9][seed])
    words = sorted({w for w in some_words(random.Random(seed), 700) if len(w) >= 6})
    found = spelling.near_words(spark.createDataFrame([(w, 5) for w in words], "word string, n bigint"))
    got = Counter(frozenset((r["a"], r["b"])) for r in found.collect())
    want = {frozenset((a, b)) for a in words for b in words if a < b and one_apart(a, b)}
    assert len(want) > 100 and got == Counter(want)


@pytest.mark.parametrize("seed", range(4))
def test_no_edit_affects_more_grams_than_the_bound(seed):
    rng = random.Random(seed)
    words = some_words(rng, 400)
    grams = Counter(spelling.framed(w)[i : i + n] for w in words for n in range(3, 7) for i in range(len(w) + 3 - n))
    frequent = {g: n for g, n in grams.items() if n > (2, 5, 15, 40)[seed]}
    for word in words:
        text = spelling.framed(word)
        own = spelling.decomposed(text, frequent)
        most = spelling.most_affected(text, own, frequent)
        for _ in range(20):
            other = spelling.framed(mutated(rng, word))
            # What is lost, whatever the places.
            left = Counter(text[a:b] for a, b in own) - Counter(other[a:b] for a, b in spelling.decomposed(other, frequent))
            assert left.total() <= most


def test_chains_of_forms(frame):
    sizes = {"abcdef": 5, "abcdeg": 25, "abcdhg": 125, "abcihg": 625, "abjihg": 3125, "zzzzzz": 5, "zzzzzy": 24}
    rows = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(sizes.items())]
    got = {r["word"]: (r["form"], r["root"]) for r in spelling.spelling_variants(frame(rows)).collect()}
    assert got["abcdef"] == ("abcdeg", "abjihg") and got["abjihg"] == (None, "abjihg")
    assert got["zzzzzz"] == (None, "zzzzzz")


def test_texts_in_parts(monkeypatch):
    text = "Wörter-and some longer words; überall " * 40
    whole = Counter(dict(spelling.words_of("7", text.encode())))
    monkeypatch.setattr(spelling, "PART", 5)
    assert Counter(dict(spelling.words_of("7", text.encode()))) == whole


def test_of_nothing(frame):
    assert spelling.spelling_variants(frame([])).collect() == []
    assert spelling.spelling_variants(frame([(1, None), (2, "once only")])).collect() == []

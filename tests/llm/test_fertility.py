"""Quality rules by tokeniser fertility."""

import base64
import math
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
import tiktoken

from tidewatch.llm import fertility

PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATHS = (PIECES, RANKS, public_tokenizers.PATTERN)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_rules(text):
    """The counting rules, plainly."""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(inside), failed,
    )


@pytest.fixture(scope="module")
def plain():
    """Measures by the libraries, over a text's pre-tokens one by one."""
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    by_byte = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def measure(text):
        ids = pieces.encode(text)
        cut = re.findall(r" +[^ \n]*|\n[^ \n]*", " " + text.replace("▁", " "))  # the mark is a space to the model
        n, counts = len(ids), Counter(ids)
        return (
            n, len(text) / n, len(text) / sum(len(by_byte.encode_ordinary(t)) for t in cut),
            sum(map(pieces.is_byte, ids)) / n, -sum(c / n * math.log2(c / n) for c in counts.values()),
        )

    return measure


def collected(frame, rows, **options):
    return fertility.quality_rules(frame(rows), *PATHS, **options).collect()


@pytest.mark.parametrize("which", ["odd", "corpus"])
def test_base_rules(frame, which, request):
    rows = request.getfixturevalue(which) + [
        (100, "a b c a b c " * 30), (101, "#x|\n#x|\n \n\n#x|\t\n" + "q " * 50), (102, "Aa aA " * 20),
        (103, " ".join(f"w{i}" for i in range(50))), (104, "one two three one two three " + " ".join(f"w{i}" for i in range(6))),
    ]
    got = Counter(tuple(r)[1:8] for r in ((r["id"], r["id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                                           r["n_repeat_words"], r["base_failed"]) for r in collected(frame, rows, lang_col=None)))
    assert got == Counter((i, *base_rules(t)) for i, t in rows)


def test_measures_equal_the_libraries(frame, corpus, plain):
    rows = corpus + [(1000, "  two  blanks \n\n\nlines \t tab"), (1001, "日本語 текст ελ שלום 한국어 \U0001f600"), (1002, "▁a b▁")]
    got = {r["id"]: r for r in collected(frame, rows, lang_col=None)}
    for i, text in rows:
        if text:
            r, want = got[i], plain(text)
            assert r["n_tokens"] == want[0]
            measures = [r[m] for m in ("chars_per_piece", "chars_per_byte_token", "fallback_share", "token_entropy")]
            assert measures == pytest.approx(want[1:], abs=1e-9)


def test_long_texts_are_measured_whole(frame, plain, monkeypatch):
    text = "Plain words, and more\nof them. " * 40 + "  \n end"
    whole = collected(frame, [(1, text), (2, "é" * 40), (3, "é" * 5000)], lang_col=None)
    known = fertility.Vocabularies(*PATHS)
    monkeypatch.setattr(fertility, "PART_BYTES", 64)
    monkeypatch.setattr(fertility, "CACHE_ROWS", 5)  # the cache is emptied between parts
    parts = fertility.fertility([text.encode(), ("é" * 40).encode()], known)
    rows = {r["id"]: r for r in whole}
    assert parts.tokens.tolist() == [rows[1]["n_tokens"], rows[2]["n_tokens"]]
    assert parts.entropy.tolist() == pytest.approx([rows[1]["token_entropy"], rows[2]["token_entropy"]])
    assert rows[1]["n_tokens"] == plain(text)[0]
    assert 2000 < rows[3]["n_tokens"] <= 5001  # runs of LONGEST bytes, none left out


def test_scripts_and_verdicts(frame):
    prose = "the quick brown fox jumps over one lazy dog while seven wizards box about quietly near some village pond "
    rows = [
        (1, prose * 1 + " ".join(f"{w} then" for w in prose.split()) + " again with many other plain words to read here now"),
        (2, "\x01\x02\x03\x04 " * 60),  # no letters
        (3, " ".join(chr(0x4E00 + 37 * i) * 2 for i in range(60))),
        (4, "".join(chr(0x10000 + i) + (" " if i % 3 == 0 else "") for i in range(200))),
        (5, " ".join("zqxjkvbp"[i % 8] * (2 + i % 5) + str(i * 7919) for i in range(60))),
        (6, None), (7, "too short"),
    ]
    got = {r["id"]: (r["script"], r["kept"]) for r in collected(frame, rows, lang_col=None)}
    assert got[1] == ("latin", True) and got[2] == ("none", False) and got[3][0] == "cjk"
    assert got[4][0] == "other" and got[6] == ("none", False) and got[7] == ("latin", False)
    assert not got[5][1]


def test_language_fences(spark):
    """The bands of languages against plain quartiles, over the small table."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = docs.unionAll(docs.where("doc_id % 10 = 0").selectExpr("doc_id + 1000", "upper(text)", "lang", "source", "n_chars"))
    docs = docs.unionAll(docs.selectExpr("null", "text", "null", "source", "n_chars").limit(5))
    found = fertility.measured(docs, *PATHS, lang_col="lang").collect()
    limits, texts = {}, Counter(r["language"] for r in found if r["kept"])
    for language, n in texts.items():
        for m in fertility.FENCED:
            if n >= fertility.LEAST_TEXTS:
                own = [(r[m], r["n_tokens"]) for r in found if r["kept"] and r["language"] == language]
                steps = sorted(round(v / fertility.STEP) * fertility.STEP for v, _ in own)
                median = steps[math.ceil(n * 0.5) - 1]
                apart = sorted(round((v - median) * math.sqrt(min(k, 1024) / 1024) / fertility.STEP) for v, k in own)
                q1, q3 = (apart[math.ceil(n * p) - 1] * fertility.STEP for p in (0.25, 0.75))
                width = 3 * max(q3 - q1, 0.02 * median)
                limits[language, m] = median, q1 - width, q3 + width
    assert limits

    def inside(r, m):
        if (r["language"], m) not in limits:
            return True
        median, low, high = limits[r["language"], m]
        return low <= (r[m] - median) * math.sqrt(min(r["n_tokens"], 1024) / 1024) <= high

    want = Counter((r["id"], r["script"], r["kept"] and all(inside(r, m) for m in fertility.FENCED)) for r in found)
    got = fertility.quality_rules(docs, *PATHS).collect()
    assert Counter((r["id"], r["script"], r["kept"]) for r in got) == want
    assert sum(r["kept"] for r in got) < sum(r["kept"] for r in found)  # capitals cost more tokens
    assert "" in texts and len(got) == docs.count()


def test_of_nothing(frame):
    assert collected(frame, [], lang_col=None) == []
    assert np.all(fertility.fertility([b"", b""], fertility.Vocabularies(*PATHS)).tokens == 0)

"""Quality rules by tokeniser fertility.

Two public vocabularies encode every text: a piece vocabulary with byte
fallback and a byte-level one. Prose of a language costs about as many tokens
as other prose in its language; junk costs more or fewer, falls back to bytes, or
repeats few tokens. Four measures are held against bands: characters per token
in both vocabularies, the share of byte-fallback tokens, and the entropy of the
tokens. A script has wide fixed bands; a language has narrow ones, taken from
all its texts. Plain counting rules come first.

A text is measured by its pre-tokens (a run of spaces with the word behind it,
or a line break with the word behind it), which no piece crosses. Each distinct
one is encoded once and kept in a bounded cache of the worker; a text's numbers
are sums over them. Pre-tokens of more than LONGEST bytes are encoded in runs of
that length, so a text without blanks is measured whole, in linear time.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import chain
from operator import and_

import numpy as np
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.llm.texts import NOT_BLANK, Words, arrow_schema, map_batches, record_batch, shingle_hashes, slices
from tidewatch.llm.token_counts import SPACE_MARK, model, pattern
from tidewatch.session import cut
from tidewatch.sizes import broadcast_if

# Bytes of text measured at a time; a longer text is measured in several goes.
PART_BYTES = 1 << 20
LONGEST = 4096
# Pre-tokens and ids in a worker's cache, about 60 MB.
CACHE_ROWS = 400_000
CACHE_IDS = 4_000_000

LEAST_WORDS = 50
MAX_REPEATED = (50, 100)
REPEAT_WORDS = 3
SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Band:
    """What a text of one script may measure, ends included."""

    piece: tuple[float, float]  # characters per token, piece vocabulary
    byte: tuple[float, float]  # characters per token, byte-level vocabulary
    fallback: float  # largest share of byte-fallback tokens
    entropy: tuple[float, float]  # bits per token


# Wide limits around what prose of a script costs in vocabularies that were
# made mostly from English: letters in the vocabulary take one to two tokens a
# syllable, others two or three bytes each.
BANDS = {
    "latin": Band((1.5, 6.5), (1.3, 6.5), 0.15, (4.5, 12.0)),
    "greek": Band((0.8, 4.0), (0.5, 4.0), 0.40, (3.5, 12.0)),
    "cyrillic": Band((1.0, 5.0), (0.5, 4.0), 0.30, (4.0, 12.0)),
    "hebrew": Band((0.6, 4.0), (0.4, 4.0), 0.60, (3.5, 12.0)),
    "arabic": Band((0.6, 4.0), (0.4, 4.0), 0.60, (3.5, 12.0)),
    "indic": Band((0.3, 4.0), (0.2, 4.0), 0.95, (3.0, 12.0)),
    "cjk": Band((0.3, 3.0), (0.2, 3.0), 0.95, (3.5, 12.0)),
    "hangul": Band((0.3, 3.0), (0.2, 3.0), 0.95, (3.5, 12.0)),
    "other": Band((0.2, 6.5), (0.2, 6.5), 0.99, (3.0, 12.0)),
}
# The bands of a language: its quartiles, and three times what lies between
# them to both sides (the outer fences of a box plot). The deviation of a text
# from the median is first scaled by the root of its tokens, up to FULL_TOKENS,
# as that of a short text is mostly chance.
FENCED = ("chars_per_piece", "chars_per_byte_token")
FENCE = 3.0
FULL_TOKENS = 1024
# What lies between the quartiles counts as this share of the median at least,
# so that a language of many copies keeps a band; one of fewer texts has none.
LEAST_SPREAD = 0.02
LEAST_TEXTS = 100
# Values are counted in steps of this size.
STEP = 0.001

# A text without letters has a script of its own, and no band.
NO_SCRIPT = "none"
SCRIPTS = [NO_SCRIPT, *BANDS]


def _scripts() -> np.ndarray:
    """The script that a byte of UTF-8 stands for: that of a letter's first byte."""
    table = np.zeros(256, np.uint8)
    number = {name: i for i, name in enumerate(SCRIPTS)}
    for low, high, name in (
        (0x41, 0x5A, "latin"), (0x61, 0x7A, "latin"), (0xC3, 0xCA, "latin"), (0xCD, 0xCF, "greek"),
        (0xD0, 0xD4, "cyrillic"), (0xD6, 0xD7, "hebrew"), (0xD8, 0xDF, "arabic"), (0xE0, 0xE0, "indic"),
        (0xE1, 0xE1, "other"), (0xE3, 0xE9, "cjk"), (0xEA, 0xED, "hangul"), (0xF0, 0xF0, "other"),
    ):
        table[low : high + 1] = number[name]
    return table


_SCRIPT = _scripts()
_CODES = np.arange(256)
_FIRST = (_CODES & 0xC0) != 0x80  # the first byte of a character
_SYMBOL = np.isin(_CODES, list(SYMBOLS))
_WORD_CHAR = NOT_BLANK & _FIRST


class Vocabularies:
    """Both vocabularies of a worker, and the pre-tokens encoded so far."""

    def __init__(self, piece_path: str, rank_path: str, split: str):
        with open(rank_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.bytes = tiktoken.Encoding("ranks", pat_str=split, mergeable_ranks=ranks, special_tokens={})
        self.pieces = model(piece_path)
        self.cut = pattern(piece_path)
        self.size = self.pieces.vocab_size()
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.size)])
        self.space = self.pieces.piece_to_id("▁")
        self.clear()

    def clear(self) -> None:
        self.places: dict[bytes, int] = {}
        self.ids = np.empty(0, np.int32)  # of all pre-tokens, one after another
        self.lens = np.empty(0, np.int64)
        self.byte_lens = np.empty(0, np.int64)

    def encoded(self, tokens: list[bytes]) -> tuple[list[list[int]], list[int]]:
        """Ids by pieces and number of byte-level tokens of each pre-token."""
        texts = [t.decode("utf-8", "replace") for t in tokens]
        # The library puts a space before what it encodes: a pre-token that
        # starts with one gives it up for that, any other gives the added one back.
        ids = self.pieces.encode([t.removeprefix(" ") for t in texts], num_threads=1)
        for i, text in enumerate(texts):
            if text == " ":
                ids[i] = [self.space]
            elif text[0] != " ":
                del ids[i][0]
        return ids, [len(self.bytes.encode_ordinary(t)) for t in texts]

    def numbered(self, tokens: list[bytes]) -> np.ndarray:
        """The place of each pre-token among those encoded, new ones included."""
        places = self.places
        fresh = [t for t in dict.fromkeys(tokens) if t not in places]
        if fresh:
            places.update(zip(fresh, range(len(places), len(places) + len(fresh)), strict=True))
            ids, byte_lens = self.encoded(fresh)
            lens = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(chain.from_iterable(ids), np.int32, lens.sum())
            self.ids = np.concatenate([self.ids, flat])
            self.lens = np.concatenate([self.lens, lens])
            self.byte_lens = np.concatenate([self.byte_lens, np.array(byte_lens, np.int64)])
        return np.fromiter(map(places.__getitem__, tokens), np.int64, len(tokens))

    def trim(self) -> None:
        """Forget everything once there is too much of it."""
        if len(self.places) > CACHE_ROWS or len(self.ids) > CACHE_IDS:
            self.clear()


def _runs(tokens: list[bytes]) -> list[bytes]:
    """The pre-tokens, long ones in runs of about LONGEST bytes cut between characters."""
    if max(map(len, tokens), default=0) <= LONGEST:
        return tokens
    out = []
    for token in tokens:
        low = 0
        while len(token) - low > LONGEST:
            high = low + LONGEST
            while high > low + 1 and token[high] & 0xC0 == 0x80:
                high -= 1
            out.append(token[low:high])
            low = high
        out.append(token[low:])
    return out


def _parts(texts: list[bytes]) -> Iterator[list[tuple[int, bytes]]]:
    """Texts, with their place, in groups of about PART_BYTES. A longer text is
    cut before runs of spaces, and its parts are groups of their own."""
    group, size = [], 0
    for i, text in enumerate(texts):
        if not text:
            continue
        text = b" " + text.replace(SPACE_MARK, b" ")
        if len(text) > PART_BYTES:
            low = 0
            while low < len(text):
                high = text.find(b" ", low + PART_BYTES)
                high = len(text) if high < 0 else len(text[low:high].rstrip(b" ")) + low
                high = max(high, low + 1)
                yield [(i, text[low:high])]
                low = high
            continue
        if group and size + len(text) > PART_BYTES:
            yield group
            group, size = [], 0
        group.append((i, text))
        size += len(text)
    if group:
        yield group


@dataclass
class Fertility:
    """Sums over the tokens of some texts."""

    tokens: np.ndarray
    byte_tokens: np.ndarray
    fallback: np.ndarray
    entropy: np.ndarray = field(default_factory=lambda: np.empty(0))


def fertility(texts: list[bytes], known: Vocabularies) -> Fertility:
    n = len(texts)
    out = Fertility(*(np.zeros(n, np.int64) for _ in range(3)))
    surprise = np.zeros(n)  # sum of c * log2(c) over the counts c of a text's tokens
    whole, of_whole = None, -1  # counts of a text that is measured in parts
    for group in _parts(texts):
        owners, tokens = [], []
        for i, text in group:
            found = _runs(known.cut.findall(text))
            owners.append(np.full(len(found), i))
            tokens += found
        place, owner = known.numbered(tokens), np.concatenate(owners)
        ids, lens, byte_lens = known.ids, known.lens, known.byte_lens
        starts = np.cumsum(lens) - lens
        sizes = lens[place]
        first = np.cumsum(sizes) - sizes
        at = np.repeat(starts[place] - first, sizes) + np.arange(sizes.sum())
        own_ids, own = ids[at], np.repeat(owner, sizes)
        out.tokens += np.bincount(own, minlength=n)
        out.fallback += np.bincount(own, known.is_byte[own_ids], minlength=n).astype(np.int64)
        out.byte_tokens += np.bincount(owner, byte_lens[place], minlength=n).astype(np.int64)
        i = group[0][0]
        if len(group) == 1 and len(texts[i]) >= PART_BYTES:
            if of_whole != i:
                whole, of_whole = np.zeros(known.size, np.int64), i
            whole += np.bincount(own_ids, minlength=known.size)
            counts = whole[whole > 0]
            surprise[i] = (counts * np.log2(counts)).sum()
        else:
            pairs, counts = np.unique(own * known.size + own_ids, return_counts=True)
            surprise += np.bincount(pairs // known.size, counts * np.log2(counts), minlength=n)
        known.trim()
    total = np.maximum(out.tokens, 1)
    out.entropy = np.maximum(0.0, np.log2(total) - surprise / total)
    return out


def _as_written(texts: list[bytes]) -> Words:
    """The words [^\\x20\\x09-\\x0D]+ of texts whose letters keep their case."""
    raw = b"\n".join(texts) + b"\n"
    data = np.frombuffer(raw, np.uint8)
    inside = np.concatenate([[False], NOT_BLANK[data]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)])
    return Words(raw, data, offsets, edges[0::2], edges[1::2], np.searchsorted(edges[0::2], offsets))


def repeated_words(words: Words, size: int = REPEAT_WORDS) -> np.ndarray:
    """Per text, its words that stand in a window of `size` words found twice or more in it."""
    n, owners = len(words.bounds) - 1, words.owners()
    windows = shingle_hashes(words.hashes(), size)
    if not len(windows):
        return np.zeros(n, np.int64)
    starts = np.flatnonzero(owners[: len(windows)] == owners[size - 1 :])
    order = np.lexsort((windows[starts], owners[starts]))
    key, of = windows[starts][order], owners[starts][order]
    same = (key[1:] == key[:-1]) & (of[1:] == of[:-1])
    twice = starts[order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]]
    inside = np.zeros(len(words), bool)
    for k in range(size):
        inside[twice + k] = True
    return np.bincount(owners[inside], minlength=n)


def repeated_lines(text: bytes) -> int:
    """Lines holding a word that equal an earlier one."""
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def _per_text(marks: np.ndarray, words: Words) -> np.ndarray:
    """Marked bytes of each text."""
    total = np.concatenate([[0], np.cumsum(marks)])
    return np.diff(total[words.offsets])


def rules(texts: list[bytes], known: Vocabularies, bands: dict[str, Band] = BANDS) -> dict:
    """The columns of SCHEMA, but for the id, for some texts."""
    words = _as_written(texts)
    n_words, repeat = words.counts, repeated_words(words)
    failed = (n_words < LEAST_WORDS) | (MAX_REPEATED[1] * repeat > MAX_REPEATED[0] * n_words)
    script = np.zeros(len(texts), np.int64)
    most = np.zeros(len(texts), np.int64)
    kinds = _SCRIPT[words.data]
    for number in range(1, len(SCRIPTS)):
        letters = _per_text(kinds == number, words)
        script[letters > most] = number
        most = np.maximum(most, letters)
    chars = _per_text(_FIRST[words.data], words) - 1  # without the byte put behind each text
    found = fertility(texts, known)
    tokens = np.maximum(found.tokens, 1)
    per_piece, per_byte = chars / tokens, chars / np.maximum(found.byte_tokens, 1)
    share = found.fallback / tokens
    names = [SCRIPTS[i] for i in script]
    kept = []
    for i, name in enumerate(names):
        band = bands.get(name)
        kept.append(bool(
            not failed[i] and band is not None
            and band.piece[0] <= per_piece[i] <= band.piece[1]
            and band.byte[0] <= per_byte[i] <= band.byte[1]
            and share[i] <= band.fallback
            and band.entropy[0] <= found.entropy[i] <= band.entropy[1]
        ))
    return {
        "n_words": n_words,
        "word_chars": _per_text(_WORD_CHAR[words.data], words),
        "n_symbols": _per_text(_SYMBOL[words.data], words),
        "n_dup_lines": [repeated_lines(t) for t in texts],
        "n_repeat_words": repeat,
        "base_failed": failed,
        "kept": kept,
        "script": names,
        "n_tokens": found.tokens,
        "chars_per_piece": per_piece,
        "chars_per_byte_token": per_byte,
        "fallback_share": share,
        "token_entropy": found.entropy,
    }


SCHEMA = (
    "id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint,"
    " base_failed boolean, kept boolean, script string, n_tokens bigint, chars_per_piece double,"
    " chars_per_byte_token double, fallback_share double, token_entropy double"
)

_known: dict[tuple[str, str, str], Vocabularies] = {}


def measured(
    docs: DataFrame,
    piece_path: str,
    rank_path: str,
    split: str,
    bands: dict[str, Band] = BANDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = None,
) -> DataFrame:
    """The columns of SCHEMA and `language` ('' if unknown), judged by the bands of scripts alone."""
    language = F.coalesce(F.col(lang_col).cast("string"), F.lit("")) if lang_col else F.lit("")
    narrow = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"), language.alias("language")
    )
    shape = docs.sparkSession.createDataFrame([], SCHEMA + ", language string").schema
    arrow = arrow_schema(shape)

    def run(batches):
        key = piece_path, rank_path, split
        if key not in _known:
            _known[key] = Vocabularies(*key)
        for batch in batches:
            for low, high, texts in slices(batch, "text"):
                own = batch.slice(low, high - low)
                found = rules(texts, _known[key], bands)
                yield record_batch({"id": own.column(0), "language": own.column(2), **found}, arrow)

    return map_batches(narrow, run, shape)


def _quantiles(values: DataFrame, shares: dict[str, float]) -> DataFrame:
    """Per language and measure: n, and the values that the given shares do not
    exceed, from counts of steps. `values`: language, measure, value."""
    counts = values.groupBy("language", "measure", F.round(F.col("value") / STEP).alias("step")).agg(F.count("*").alias("c"))
    of = Window.partitionBy("language", "measure")
    below = counts.withColumn("below", F.sum("c").over(of.orderBy("step"))).withColumn("n", F.sum("c").over(of))
    return below.groupBy("language", "measure").agg(
        F.max("n").alias("n"),
        *[(F.min(F.when(F.col("below") >= F.col("n") * p, F.col("step"))) * STEP).alias(name) for name, p in shares.items()],
    )


def fences(found: DataFrame) -> DataFrame:
    """Per language with enough texts, a row of each measure's median, low and
    high limit of the scaled deviation. Copies and all other texts count, but
    for those that the base rules or a script's band reject."""
    sound = found.where("kept").select(
        "language", "n_tokens", F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in FENCED])).alias("m")
    ).select("language", "n_tokens", "m.*")
    medians = cut(_quantiles(sound, {"median": 0.5}).where(F.col("n") >= LEAST_TEXTS).drop("n"))
    narrow = broadcast_if(medians, medians.count())  # a language may hold most texts
    apart = sound.join(narrow, ["language", "measure"]).withColumn("value", _deviation("value", "median"))
    spread = _quantiles(apart.select("language", "measure", "value"), {"q1": 0.25, "q3": 0.75})
    width = F.greatest(F.col("q3") - F.col("q1"), F.col("median") * LEAST_SPREAD) * FENCE
    limits = spread.join(medians, ["language", "measure"]).select(
        "language", "measure", F.struct("median", (F.col("q1") - width).alias("low"), (F.col("q3") + width).alias("high")).alias("f")
    )
    return limits.groupBy("language").agg(*[F.max(F.when(F.col("measure") == m, F.col("f"))).alias("of_" + m) for m in FENCED])


def _deviation(value: str, median: str) -> Column:
    weight = F.sqrt(F.least(F.col("n_tokens"), F.lit(FULL_TOKENS)) / FULL_TOKENS)
    return (F.col(value) - F.col(median)) * weight


def quality_rules(
    docs: DataFrame,
    piece_path: str,
    rank_path: str,
    split: str,
    bands: dict[str, Band] = BANDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = "lang",
) -> DataFrame:
    """Per row of `docs`: id, n_words, word_chars (characters in words),
    n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, script, n_tokens,
    the four measures and language.

    base_failed: fewer than LEAST_WORDS words, or more than half of them in
    three-word windows that the text repeats. kept: not base_failed, and every
    measure in the band of the script that most letters of the text have (ties:
    the first of SCRIPTS) and in those of its language, if that has LEAST_TEXTS
    such texts; a script without a band is rejected. `piece_path` is a
    SentencePiece model and `rank_path` a byte-level vocabulary as ranks, with
    its pattern `split`; both lie at the same place on every machine.

    A null, empty or blank text has no words, measures 0 and is not kept. A null
    language is one of its own, as is every text's without `lang_col`. Repeated
    rows and null ids are judged like any other row; other columns of `docs` are
    not read; an empty table gives no rows.
    """
    found = cut(measured(docs, piece_path, rank_path, split, bands, id_col, text_col, lang_col))
    limits = cut(fences(found))
    inside = [
        F.coalesce(_deviation(m, f"of_{m}.median").between(F.col(f"of_{m}.low"), F.col(f"of_{m}.high")), F.lit(True))
        for m in FENCED
    ]
    judged = found.join(broadcast_if(limits, limits.count()), "language", "left")
    return judged.withColumn("kept", F.col("kept") & reduce(and_, inside)).drop(*[f"of_{m}" for m in FENCED])

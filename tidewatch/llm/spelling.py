"""Spelling variants by a variable-length gram index (after VGRAM, Li et al., 2007).

Words are counted over all texts. A dictionary holds the grams of the words that
are frequent; from every place of a word a gram is taken, extended while it is
frequent, and left out where an earlier one covers it. So rare grams stay short
and frequent ones grow, up to MOST characters.

One edit changes only the grams around it. For every word the largest number of
grams that an edit can affect is worked out from the dictionary: two words one
edit apart share at least (its grams - that number), for either word. So of the
grams in a fixed order, rare ones first, only that number and one more need to be
looked up: the lists of equal grams at equal or neighbouring places of words of
equal or neighbouring length are merged, what the bounds allow is verified.
A word whose bound says nothing (all its grams can be affected at once) is also
listed by its plain grams of LEAST characters, of which an edit affects three.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.texts import arrow_schema, map_batches, record_batch, slices
from tidewatch.session import cut

RUN_OF = "a-zÀ-ÿ"
LEAST_LENGTH = 6
LEAST_COUNT = 5
# One distinct word of a text in MISSPELT loses a character.
MISSPELT = 199
# A word belongs to a near one that is so many times as frequent.
FORM_RATIO = 5

# Characters of a gram.
LEAST, MOST = 3, 6
# A gram that stands in the words more often is extended, as long as that
# leaves at most MAX_GRAMS frequent ones, which are broadcast (about 100 MB).
FREQUENT = 50
MAX_GRAMS = 1_000_000

# Characters of a text searched at a time, and words a task counts before it hands them on.
PART = 1 << 20
COUNTED = 200_000

_RUN = re.compile(f"[{RUN_OF}]{{{LEAST_LENGTH},}}")
_OUTSIDE = re.compile(f"[^{RUN_OF}]")


def _runs(text: str) -> Iterator[list[str]]:
    """The runs of letters that are long enough, whatever the length of the text."""
    low = 0
    while low < len(text):
        high = len(text)
        if high - low > PART:
            outside = _OUTSIDE.search(text, low + PART)
            high = outside.start() if outside else high
        yield _RUN.findall(text, low, high)
        low = high


def words_of(name: str, text: bytes) -> Iterator[tuple[str, int]]:
    """The words of a text with their numbers, some with a character lost."""
    own: Counter[str] = Counter()
    for found in _runs(text.lower().decode()):
        own.update(found)
    start = zlib.crc32(f"{name}:".encode())
    for word, n in own.items():
        code = zlib.crc32(word.encode(), start)
        if code % MISSPELT == 0:
            at = code % len(word)
            word = word[:at] + word[at + 1 :]
            if len(word) < LEAST_LENGTH:
                continue
        yield word, n


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all words found LEAST_COUNT times or more in `docs`.

    Each task adds up what it reads; only those sums are shuffled.
    """
    narrow = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    shape = docs.sparkSession.createDataFrame([], "word string, n bigint").schema
    arrow = arrow_schema(shape)

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return record_batch({"word": list(counts), "n": list(counts.values())}, arrow)

    def run(batches):
        counts: Counter[str] = Counter()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for low, high, texts in slices(batch, "text"):
                for own, text in zip(ids[low:high], texts, strict=True):
                    for word, n in words_of("" if own is None else str(own), text):
                        counts[word] += n
                    if len(counts) > COUNTED:
                        yield batch_of(counts)
                        counts = Counter()
        yield batch_of(counts)

    counts = map_batches(narrow, run, shape).groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= LEAST_COUNT)


def framed(word: str) -> str:
    """A word between marks that no word holds."""
    return f"^{word}$"


def frequent_grams(words: DataFrame) -> dict[str, int]:
    """The gram dictionary: grams of LEAST to MOST characters that stand in the
    framed words more than a bound, with their numbers. The bound is FREQUENT,
    or what leaves no more than MAX_GRAMS of them."""
    lengths = F.sequence(F.lit(LEAST), F.lit(MOST))
    text = words.select(F.concat(F.lit("^"), "word", F.lit("$")).alias("text"))
    sized = text.select("text", F.explode(lengths).alias("size")).where(F.length("text") >= F.col("size"))
    starts = F.sequence(F.lit(1), F.length("text") - F.col("size") + 1)
    grams = sized.select(F.explode(F.transform(starts, lambda i: F.substring("text", i, F.col("size")))).alias("gram"))
    total = sized.agg(F.sum(F.length("text") - F.col("size") + 1)).first()[0] or 0
    bound = max(FREQUENT, -(-total // MAX_GRAMS))
    counts = grams.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > bound).toArrow()
    return dict(zip(counts["gram"].to_pylist(), counts["n"].to_pylist(), strict=True))


def decomposed(text: str, frequent: dict[str, int]) -> list[tuple[int, int]]:
    """The variable grams of a framed word, as ranges."""
    out, reach = [], 0
    for start in range(len(text) - LEAST + 1):
        end = start + LEAST
        while end < len(text) and end - start < MOST and text[start:end] in frequent:
            end += 1
        if end > reach:
            out.append((start, end))
            reach = end
    return out


def most_affected(text: str, grams: list[tuple[int, int]], frequent: dict[str, int]) -> int:
    """The most grams that one edit can take from the decomposition.

    An edit of the character at c (or behind it) changes the grams that hold
    it. Those before it stay: how far a gram reaches depends on its own
    characters only. One behind it, up to `end`, stays unless a new gram across
    the edit covers it, and that one must be frequent up to `end` - 1.
    """
    counts = [0] * len(text)
    for start, end in grams:
        for c in range(start, end):
            counts[c] += 1
        for c in range(max(0, end - MOST), start):
            if end - 2 - c < LEAST or text[c + 1 : end - 1] in frequent:
                counts[c] += 1
    return max(counts[:-1], default=0)


def _keys(kind: int, gram: str, length: int, place: int) -> int:
    return xxhash.xxh64_intdigest(f"{kind} {length} {place} {gram}")


def listed(word: str, frequent: dict[str, int]) -> Iterator[tuple[int, str, int, int, int, int]]:
    """What a word is looked up by: kind, gram, place, rank, number of grams, and how many must be shared."""
    text = framed(word)
    grams = decomposed(text, frequent)
    affected = most_affected(text, grams, frequent)
    ways = [(0, grams, affected)]
    if len(grams) <= affected:
        plain = [(i, i + LEAST) for i in range(len(text) - LEAST + 1)]
        ways.append((1, plain, LEAST))
    for kind, ranges, most in ways:
        order = sorted((frequent.get(text[a:b], 0), text[a:b], a) for a, b in ranges)
        for rank, (_, gram, place) in enumerate(order[: most + 1]):
            yield kind, gram, place, rank, len(order), len(order) - most


def _index(words: DataFrame, frequent: dict[str, int], probes: bool) -> DataFrame:
    """The gram lists: a row per word and gram that it is looked up by. `probes`:
    a row for each place where a word of the same length, or one longer, has it."""
    shape = words.sparkSession.createDataFrame(
        [], "key bigint, same boolean, word string, n bigint, rest int, needed int"
    ).schema
    arrow = arrow_schema(shape)
    shared = words.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        known = shared.value
        for batch in batches:
            columns: dict[str, list] = {name: [] for name in arrow.names}
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for kind, gram, place, rank, size, needed in listed(word, known):
                    here = _keys(kind, gram, len(word), place)
                    rows = [(here, True)]
                    if probes:
                        rows += [(_keys(kind, gram, len(word) + 1, place + k), False) for k in (0, 1)]
                    for key, same in rows:
                        values = (key - (key >> 63 << 64), same, word, n, size - rank, needed)
                        for name, value in zip(arrow.names, values, strict=True):
                            columns[name].append(value)
            yield record_batch(columns, arrow)

    return map_batches(words.select("word", "n"), run, shape)


def near_words(words: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b): the pairs of distinct `words` (word, n) one edit apart, each once."""
    frequent = frequent_grams(words)
    a = _index(words, frequent, True).select("key", "same", *[F.col(c).alias(c + "_a") for c in ("word", "n", "rest", "needed")])
    b = _index(words, frequent, False).select("key", *[F.col(c).alias(c + "_b") for c in ("word", "n", "rest", "needed")])
    merged = a.join(b, "key").where(
        (~F.col("same") | (F.col("word_a") < F.col("word_b")))
        # Behind a shared gram both words have enough others.
        & (F.least("rest_a", "rest_b") >= F.greatest("needed_a", "needed_b"))
        & (F.levenshtein("word_a", "word_b", 1) == 1)
    )
    names = {"word_a": "a", "word_b": "b", "n_a": "n_a", "n_b": "n_b"}
    return merged.select(*[F.col(c).alias(name) for c, name in names.items()]).distinct()


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """(word, root) of all words that have a form, by pointer jumping. A form is
    FORM_RATIO times as frequent as its word, so chains are as short as the
    logarithm of `most`, the largest number of a word."""
    roots = forms.select("word", F.col("form").alias("root"))
    steps = int(math.log(max(most, 1), FORM_RATIO)) + 1
    for _ in range(steps.bit_length()):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = cut(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
    return roots


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per word of `docs`: word, form, root, n, n_near, form_n.

    Words are the runs of letters a-z (A-Z folded) and U+00C0 to U+00FF of at
    least LEAST_LENGTH characters that occur LEAST_COUNT times; of each text's
    distinct words one in MISSPELT loses a character first, by a checksum of id
    and word. form: of the words one inserted, deleted or replaced character
    away the most frequent one (ties: the smallest by code points), if it is
    FORM_RATIO times as frequent; root: where following forms ends.

    A null text has no words and a null id is the empty text in the checksum.
    Repeated rows count again. Other columns of `docs` are not read. An empty
    table, and one without frequent words, gives no rows.
    """
    words = cut(word_counts(docs, id_col, text_col))
    pairs = near_words(words)
    both = pairs.unionAll(pairs.select(F.col("b"), F.col("a"), F.col("n_b"), F.col("n_a")).toDF("a", "b", "n_a", "n_b"))
    best = both.groupBy("a").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("n"), F.col("b").alias("word"))).alias("best")
    )
    joined = words.join(best.withColumnRenamed("a", "word"), "word", "left")
    chosen = -F.col("best.n") >= F.col("n") * FORM_RATIO
    found = cut(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(chosen, F.col("best.word")).alias("form"), F.when(chosen, -F.col("best.n")).alias("form_n"),
    ))
    roots = _roots(found.where("form is not null"), found.agg(F.max("n")).first()[0] or 0)
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )

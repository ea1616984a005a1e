"""Sentiment polarity from a word list.

The word list is input data: (word, polarity), optionally with `is_negation`
and `intensity`, which scale the polarity of the word that follows. A text
scores the mean polarity of its tokens found in the list, 0.0 if none is
found, NULL if the text is NULL. A word listed twice has the mean of its
entries.

Polarities may have any scale; nothing is cut to a range.

A short list is folded into one expression over the tokens, so that scoring is
part of the scan: no shuffle, no second read of the texts. Its cost grows with
the list, so a longer one is joined to the tokens instead. Both give the same
scores.
"""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.sizes import measure

TOKEN = r"\p{L}+"
NEGATION_FACTOR = -0.5
# Polarities are summed as whole billionths, so that a score does not depend
# on the order in which partial sums meet.
UNIT = 1_000_000_000

# Measured break-even, about: beyond it the join is faster (README).
MAX_INLINE_WORDS = 100
MAX_INLINE_VALUES = 50


def _entries(lexicon: DataFrame) -> DataFrame:
    """One row per word, case folded: its polarity (NULL for a mere modifier) and the
    factor it puts on the next word (NULL for none)."""
    factor = F.lit(None).cast("double")
    if {"is_negation", "intensity"} <= set(lexicon.columns):
        negated = F.max(F.coalesce("is_negation", F.lit(False)))
        intensity = F.avg("intensity")
        factor = F.when(
            negated | intensity.isNotNull(),
            F.coalesce(intensity, F.lit(1.0)) * F.when(negated, NEGATION_FACTOR).otherwise(1.0),
        )
    words = lexicon.where(F.col("word").isNotNull()).withColumn("word", F.lower("word"))
    return words.groupBy("word").agg(F.avg("polarity").alias("polarity"), factor.alias("factor"))


def _tokens(text: str) -> Column:
    return F.regexp_extract_all(F.lower(F.col(text)), F.lit(TOKEN), F.lit(0))


def _units(polarity: Column, factor: Column) -> Column:
    """Polarity times factor in whole units."""
    return F.round(polarity * F.coalesce(factor, F.lit(1.0)) * UNIT).cast("bigint")


def _mean(total: Column, n: Column) -> Column:
    return F.round(total / (n * F.lit(UNIT)).cast("double"), 6) + F.lit(0.0)


def with_sentiment(
    df: DataFrame,
    keys: list[str],
    text: str,
    lexicon: DataFrame,
    out: str,
    max_inline_words: int = MAX_INLINE_WORDS,
) -> DataFrame:
    """`df` with the column `out`, the polarity of `text`. `keys` identify a
    row; rows that share them must share the text."""
    entries = _entries(lexicon).limit(max_inline_words + 1).collect()
    values = {(e["polarity"], e["factor"]) for e in entries}
    if len(entries) <= max_inline_words and len(values) <= MAX_INLINE_VALUES:
        return _score_in_place(df, text, entries, out)
    return _score_by_join(df, keys, text, lexicon, out)


def _word_set(words: list[str]) -> str:
    quoted = (word.replace("\\", "\\\\").replace("'", "\\'") for word in words)
    return "(" + ", ".join(f"'{word}'" for word in quoted) + ")"


def _lookup(entries: list, column: str) -> tuple[str, str]:
    """SQL for whether token `t` has a value of `column`, and for the value.

    Words of equal value form one set, so that a lookup is a few hash probes,
    and only one for a token that is not in the list. The text form is parsed
    at once, where thousands of literals would be handed over one by one.
    """
    known = sorted((e[column], e["word"]) for e in entries if e[column] is not None)
    if not known:
        return "false", "cast(null as double)"
    cases = " ".join(
        f"when t in {_word_set([word for _, word in words])} then {float(value)!r}D"
        for value, words in groupby(known, key=lambda e: e[0])
    )
    found = f"t in {_word_set([word for _, word in known])}"
    return found, f"if({found}, case {cases} end, null)"


def _score_in_place(df: DataFrame, text: str, entries: list, out: str) -> DataFrame:
    hit, polarity = _lookup(entries, "polarity")
    _, factor = _lookup(entries, "factor")
    scaled = f"{polarity} * coalesce(seen.factor, 1D)"
    score = F.expr(
        f"""aggregate(_tokens,
          named_struct('total', 0L, 'n', 0L, 'factor', cast(null as double)),
          (seen, t) -> named_struct(
            'total', seen.total + if({hit}, cast(round({scaled} * {UNIT}) as bigint), 0L),
            'n', seen.n + if({hit}, 1L, 0L),
            'factor', {factor}),
          seen -> if(seen.n > 0, round(seen.total / cast(seen.n * {UNIT}L as double), 6) + 0D, 0D))"""
    )
    return df.withColumn("_tokens", _tokens(text)).withColumn(out, score).drop("_tokens")


def _score_by_join(df: DataFrame, keys: list[str], text: str, lexicon: DataFrame, out: str) -> DataFrame:
    """Only keys and tokens leave the scan. Tokens of a row sit in one task,
    so the partial aggregate brings them down to one narrow row per key before
    the shuffle, whatever words are frequent."""
    entries = _entries(lexicon)
    fits = measure(lexicon)[0].broadcastable
    polarities = entries.where("polarity is not null").select("word", "polarity")
    factors = entries.where("factor is not null").select(F.col("word").alias("before"), "factor")
    if fits:
        polarities, factors = F.broadcast(polarities), F.broadcast(factors)

    # Before the first token stands a text that is no token and differs from
    # row to row, so that it is no frequent key of the join.
    none = F.concat(F.lit("\x00"), F.pmod(F.xxhash64(*keys), F.lit(4096)).cast("string"))
    before = F.concat(F.array(none), "_tokens")
    words = df.select(*keys, _tokens(text).alias("_tokens")).select(
        *keys, F.inline(F.arrays_zip(F.col("_tokens").alias("word"), before.alias("before")))
    )
    hits = words.join(polarities, "word").join(factors, "before", "left")
    units = _units(F.col("polarity"), F.col("factor"))
    scores = (
        hits.groupBy(*keys)
        .agg(F.sum(units).alias("_total"), F.count(units).alias("_n"))
        .select(*keys, _mean(F.col("_total"), F.col("_n")).alias("_score"))
    )
    score = F.when(F.col(text).isNotNull(), F.coalesce("_score", F.lit(0.0)))
    return df.join(scores, keys, "left").select(*[F.col(c) for c in df.columns], score.alias(out))

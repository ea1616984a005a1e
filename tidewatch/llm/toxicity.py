"""Toxicity by a factorization machine over hashed terms (Rendle, 2010).

A text is the set of its words and of their first 3 to 8 bytes (inflected
languages carry an insult as a stem), hashed to TERM_BITS bits. The score is

    sigmoid(w0 + sum_i w_i x_i + sum_i<j <v_i, v_j> x_i x_j)

so that a pair of terms, such as an insult and the mention of a group, weighs
more or less than the two alone. The pair sum takes one pass over the terms:
half of (sum v x)^2 - sum (v x)^2. The fit runs on a bounded sample of the
labelled rows, whose terms executors have hashed. Every term seen often enough takes
part; a penalty chosen on a part of the rows decides which keep a weight.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.labels import class_shares, training_rows
from tidewatch.llm.texts import LETTERS, Words, arrow_schema, list_array, map_batches, map_texts, mixed, record_batch
from tidewatch.session import cut

# Labelled rows to learn from, at most; half of them per class if there are.
SAMPLE_ROWS = 8_000
TERM_BITS = 20
PREFIXES = (3, 4, 5, 6, 7, 8)
# Terms that fewer sampled texts hold have no weight.
LEAST_TEXTS = 3
# More places of a term in one text count as this many.
MOST_COUNTED = 8
FACTORS = 4
# What a term's pull must exceed, in units of chance; the one that does best is taken.
PENALTIES = (2.0, 1.0, 0.5)
# What is left of it for the terms chosen.
FREED = (0.2, 0.05)
STEPS = 40
PAIR_STEPS = 40
RATE = 0.05
PENALTY = 5e-4
# Slopes below this hardly move a factor.
FLOOR = 1e-5

PARTS, HELD_OUT = 5, 0


def terms(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashed terms of all words, one row per kind of term, and which of them exist."""
    n, width = len(words), max(PREFIXES)
    sizes = words.ends - words.starts
    head = np.zeros(n, np.uint64)
    heads = []
    last = len(words.data) - 1
    for k in range(width):
        byte = np.where(k < sizes, words.data[np.minimum(words.starts + k, last)], 0).astype(np.uint64)
        head = head | (byte << np.uint64(8 * k))
        if k + 1 in PREFIXES:
            heads.append(head.copy())
    shift = np.uint64(64 - TERM_BITS)
    kinds = [words.hashes()] + [mixed(h + np.uint64(0x632BE59BD9B4E019 * (i + 1) % (1 << 64))) for i, h in enumerate(heads)]
    exist = [np.ones(n, bool)] + [sizes > k for k in PREFIXES]
    return np.stack([(k >> shift).astype(np.int64) for k in kinds]), np.stack(exist)


def term_counts(words: Words, slots: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count) of the distinct terms of each text. slots: the number of
    each hashed term that counts, -1 for others."""
    if not len(words):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    hashed, exist = terms(words)
    owners = np.broadcast_to(words.owners(), hashed.shape)[exist]
    values = hashed[exist]
    if slots is not None:
        values = slots[values]
        owners, values = owners[values >= 0], values[values >= 0]
    pairs, counts = np.unique((owners << TERM_BITS) | values, return_counts=True)
    return pairs >> TERM_BITS, pairs & ((1 << TERM_BITS) - 1), counts


def strength(counts: np.ndarray) -> np.ndarray:
    """The value of a term that stands in a text so many times."""
    return np.minimum(1.0 + np.log(np.clip(counts, 1, MOST_COUNTED)), 3.0)


@dataclass
class Machine:
    slots: np.ndarray  # of each hashed term its weight's place, or -1
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def scores(self, words: Words) -> np.ndarray:
        """Between 0 and 1 for each text."""
        n = len(words.counts)
        owners, slots, counts = term_counts(words, self.slots)
        x = strength(counts)
        total = self.bias + np.bincount(owners, self.weights[slots] * x, n)
        for k in range(self.factors.shape[1]):
            part = self.factors[slots, k] * x
            total += 0.5 * (np.bincount(owners, part, n) ** 2 - np.bincount(owners, part**2, n))
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


class Terms:
    """The terms of rows, by row and by term: sums over either are runs of one array.

    Place 0 of every row is the bias, a term of value 1.
    """

    def __init__(self, row: np.ndarray, term: np.ndarray, x: np.ndarray, rows: int, n: int):
        row = np.concatenate([np.arange(rows, dtype=np.int32), row.astype(np.int32)])
        term = np.concatenate([np.zeros(rows, np.int32), term.astype(np.int32) + 1])
        x = np.concatenate([np.ones(rows, np.float32), x.astype(np.float32)])
        order = np.argsort(row, kind="stable").astype(np.int32)
        self.term, self.by_row = term[order], x[order]
        self.row_starts = np.searchsorted(row[order], np.arange(rows))
        order = np.argsort(term, kind="stable").astype(np.int32)
        self.row, self.by_term = row[order], x[order]
        self.present, self.term_starts = np.unique(term[order], return_index=True)
        self.n = n + 1

    def times(self, values: np.ndarray, power: int = 1) -> np.ndarray:
        """Of each row the sum of values times x."""
        found = values.astype(np.float32)[self.term]
        for _ in range(power):
            found *= self.by_row
        return np.add.reduceat(found, self.row_starts).astype(float)

    def back(self, values: np.ndarray, power: int = 1) -> np.ndarray:
        """Of each term the sum of values times x."""
        out = np.zeros(self.n)
        if len(self.row):
            found = values.astype(np.float32)[self.row]
            for _ in range(power):
                found *= self.by_term
            out[self.present] = np.add.reduceat(found, self.term_starts)
        return out

    def part(self, rows: np.ndarray | None = None, terms_used: np.ndarray | None = None) -> Terms:
        """Of these rows or terms only; rows are numbered anew, terms are not."""
        place = np.arange(len(self.row_starts))
        if rows is not None:
            place[:] = -1
            place[rows] = np.arange(len(rows))
        own = place[self.row]
        term = np.repeat(self.present, np.diff(np.append(self.term_starts, len(self.row))))
        kept = (own >= 0) & (term > 0)
        if terms_used is not None:
            kept &= terms_used[term]
        return Terms(own[kept], term[kept] - 1, self.by_term[kept], int((place >= 0).sum()), self.n - 1)

    def margins(self, weights: np.ndarray, factors: np.ndarray) -> np.ndarray:
        out = self.times(weights)
        for v in factors.T:
            out += 0.5 * (self.times(v) ** 2 - self.times(v**2, 2))
        return out


def _probability(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -30, 30)))


def _loss(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """Weighted mean of the logistic loss."""
    return float((weight * np.logaddexp(0, np.where(y > 0, -margin, margin))).sum() / weight.sum())


def _weighed(x: Terms, y, weight, start: np.ndarray, penalty: float, steps: int) -> np.ndarray:
    """Weights by accelerated proximal steps. A term's weight stays 0 unless its pull
    exceeds `penalty` times what chance gives a term of its frequency."""
    prior = (weight * y).sum() / weight.sum()
    bar = penalty * np.sqrt(x.back((weight * (prior - y)) ** 2, 2))
    bar[0] = 0
    room = 0.25 * x.back(weight * x.times(np.ones(x.n))) + 1e-9
    w, ahead, pace = start.copy(), start.copy(), 1.0
    for _ in range(steps):
        moved = ahead - x.back((_probability(x.times(ahead)) - y) * weight) / room
        new = np.sign(moved) * np.maximum(0, np.abs(moved) - bar / room)
        faster = (1 + np.sqrt(1 + 4 * pace**2)) / 2
        ahead = new + (pace - 1) / faster * (new - w)
        w, pace = new, faster
    return w


def _refitted(x: Terms, y, weight, w: np.ndarray, penalty: float) -> np.ndarray:
    """Weights of the terms that have one, freed of most of the penalty that chose them."""
    return _weighed(x.part(terms_used=w != 0), y, weight, w, penalty, STEPS)


def _cut(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The margin that divides the classes with the least weight of errors: the
    middle of the widest gap between rows that does."""
    order = np.argsort(margin, kind="stable")
    margin, missed = margin[order], (weight * (y == 1))[order]
    false = (weight * (y == 0))[order]
    errors = np.concatenate([[0], np.cumsum(missed)])[1:-1] + np.cumsum(false[::-1])[::-1][1:]
    best = np.flatnonzero(errors <= errors.min() + 1e-9)
    at = best[np.argmax(margin[best + 1] - margin[best])]
    return float(margin[at] + margin[at + 1]) / 2


def _paired(x: Terms, y, weight, w: np.ndarray, steps: int, judge=None) -> tuple[np.ndarray, int]:
    """Factors beside the weights `w` after `steps`, or after the number of steps that
    `judge` finds best (0: factors of 0); and that number."""
    factors = np.random.default_rng(5).normal(0, 0.01, (x.n, FACTORS))
    factors[0] = 0
    if not steps:
        return np.zeros_like(factors), 0
    none = np.zeros_like(factors)
    best = (judge(none), 0, none) if judge else None
    linear = x.times(w)
    mean, square = np.zeros_like(factors), np.zeros_like(factors)
    for step in range(1, steps + 1):
        sums = [x.times(v) for v in factors.T]
        margin = linear + sum(0.5 * (s**2 - x.times(v**2, 2)) for s, v in zip(sums, factors.T, strict=True))
        error = (_probability(margin) - y) * weight
        own = x.back(error, 2)
        gradient = np.stack([x.back(error * s) for s in sums], 1) - own[:, None] * factors
        gradient = gradient / weight.sum() + PENALTY * factors
        gradient[0] = 0
        mean += 0.1 * (gradient - mean)
        square += 0.01 * (gradient**2 - square)
        factors -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + FLOOR)
        if judge and step % 5 == 0 and (found := judge(factors)) < best[0]:
            best = found, step, factors.copy()
    return (best[2], best[1]) if judge else (factors, steps)


def fitted(rows: list[tuple[int, np.ndarray, np.ndarray]], share: float) -> Machine:
    """rows: (label, hashed terms, counts). share: of label 1 among all labelled rows."""
    y = np.array([r[0] for r in rows], float)
    sizes = [len(r[1]) for r in rows]
    none = np.empty(0, np.int64)
    term = np.concatenate([none, *(r[1] for r in rows)])
    counts = np.concatenate([none, *(r[2] for r in rows)])
    return learnt(y, np.repeat(np.arange(len(rows)), sizes), term, counts, share)


def learnt(y: np.ndarray, row: np.ndarray, term: np.ndarray, counts: np.ndarray, share: float) -> Machine:
    """A machine over all terms that stand in LEAST_TEXTS rows. Penalties, steps and the
    cut between the classes are those that do best on every fifth row, after a fit to
    the others; the machine is then fitted to all rows with them."""
    size = 1 << TERM_BITS
    slots = np.full(size, -1, np.int32)
    if not len(y) or y.min() == y.max():
        prior = np.clip(share, 1e-3, 1 - 1e-3)
        return Machine(slots, float(np.log(prior / (1 - prior))), np.zeros(1), np.zeros((1, FACTORS)))
    chosen = np.flatnonzero(np.bincount(term, minlength=size) >= LEAST_TEXTS)
    slots[chosen] = np.arange(len(chosen))
    kept = slots[term] >= 0
    # Twelve bytes a term; the caller's arrays are given up.
    row, slot = row[kept].astype(np.int32), slots[term[kept]]
    value = strength(np.arange(MOST_COUNTED + 1)).astype(np.float32)[np.minimum(counts[kept], MOST_COUNTED)]
    del term, counts, kept

    def terms_of(rows: np.ndarray) -> Terms:
        place = np.full(len(y), -1, np.int32)
        place[rows] = np.arange(len(rows))
        own = place[row]
        return Terms(own[own >= 0], slot[own >= 0], value[own >= 0], len(rows), len(chosen))

    # Each class weighs as it does among all labelled rows.
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    start = np.zeros(len(chosen) + 1)
    start[0] = np.log(share / (1 - share))

    judged = np.arange(len(y)) % 5 == 4
    penalty, freed, paired, cut_at = PENALTIES[-1], FREED[0], 0, 0.0
    if 0 < y[judged].sum() < judged.sum():
        test, learn = terms_of(np.flatnonzero(judged)), terms_of(np.flatnonzero(~judged))
        rest = y[~judged], weight[~judged]
        w, best = start, np.inf
        for tried in PENALTIES:
            w = _weighed(learn, *rest, w, tried, STEPS)
            for lesser in FREED:
                refitted = _refitted(learn, *rest, w, lesser)
                loss = _loss(test.times(refitted), y[judged], weight[judged])
                if loss < best:
                    best, penalty, freed, weights = loss, tried, lesser, refitted
        factors, paired = _paired(
            learn, *rest, weights, PAIR_STEPS,
            lambda v: _loss(test.margins(weights, v), y[judged], weight[judged]),
        )
        cut_at = _cut(test.margins(weights, factors), y[judged], weight[judged])
        del test, learn
    x = terms_of(np.arange(len(y)))
    del row, slot, value
    w = _refitted(x, y, weight, _weighed(x, y, weight, start, penalty, 2 * STEPS), freed)
    factors, _ = _paired(x, y, weight, w, paired)
    return Machine(slots, float(w[0]) - cut_at, np.append(w[1:], 0), np.vstack([factors[1:], np.zeros((1, FACTORS))]))


def trained(docs: DataFrame, labels: DataFrame, parts: int = PARTS, held_out: int = HELD_OUT,
            rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Machine:
    """A machine fitted on at most `rows` labelled rows with crc32(id) mod `parts`
    not `held_out`. Without labels of both classes it gives the share of label 1."""
    sample = training_rows(docs, labels, "toxic", parts, held_out, rows, id_col, text_col)
    # The label travels in the id's place: the terms of a text need no id.
    sample = sample.withColumnRenamed("label", "y")

    def work(y: pa.Array, texts: list[bytes]) -> dict:
        owners, found, counts = term_counts(Words.of(texts, LETTERS))
        sizes = np.bincount(owners, minlength=len(texts))
        return {
            "y": y,
            "terms": list_array(found.astype(np.int32), sizes),
            "counts": list_array(np.minimum(counts, MOST_COUNTED).astype(np.int8), sizes),
        }

    schema = "y bigint, terms array<int>, counts array<tinyint>"
    found = cut(map_texts(sample, work, schema, "y", "text"))
    seen = found.select(F.explode("terms").alias("term")).groupBy("term").count().where(F.col("count") >= LEAST_TEXTS)
    often = np.zeros(1 << TERM_BITS, bool)
    often[np.asarray(seen.select("term").toArrow().column(0))] = True
    y, terms_of, counts_of, sizes = _collected(found, often)
    ends = np.cumsum(sizes)
    each = [slice(e - n, e) for e, n in zip(ends, sizes, strict=True)]
    # The same fit whatever the order of rows.
    order = sorted(range(len(y)), key=lambda i: (y[i], sizes[i], xxhash.xxh64_intdigest(terms_of[each[i]].tobytes())))
    none = np.empty(0, np.int32)
    return learnt(
        y[order].astype(float),
        np.repeat(np.arange(len(y), dtype=np.int32), sizes[order]),
        np.concatenate([none, *(terms_of[each[i]] for i in order)]),
        np.concatenate([none, *(counts_of[each[i]] for i in order)]),
        class_shares(labels, "toxic", parts, held_out),
    )


def _collected(found: DataFrame, often: np.ndarray) -> tuple[np.ndarray, ...]:
    """Labels, terms and counts of the stored rows, without terms that are not in
    `often`, five bytes a term; and the number of terms of each row."""
    shared = found.sparkSession.sparkContext.broadcast(often)
    arrow = arrow_schema(found.schema)

    def run(batches):
        for batch in batches:
            listed = batch.column(1)
            values, counts = (np.asarray(batch.column(k).flatten()) for k in (1, 2))
            kept = shared.value[values]
            row = np.repeat(np.arange(len(listed)), np.asarray(pc.list_value_length(listed)))
            sizes = np.bincount(row[kept], minlength=len(listed))
            yield record_batch(
                {"y": batch.column(0), "terms": list_array(values[kept], sizes), "counts": list_array(counts[kept], sizes)},
                arrow,
            )

    table = map_batches(found, run, found.schema).toArrow().combine_chunks()
    if not len(table):
        return tuple(np.empty(0, np.int64) for _ in range(4))
    y, terms_of, counts_of = (table.column(k).chunk(0) for k in range(3))
    sizes = np.asarray(pc.list_value_length(terms_of)).astype(np.int64)
    return np.asarray(y), np.asarray(terms_of.flatten()), np.asarray(counts_of.flatten()), sizes


def toxicity(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: id and score, 0 to 1, of the whole text. A null, empty
    or wordless text has the score of the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def work(ids: pa.Array, texts: list[bytes]) -> dict:
        return {"id": ids, "score": shared.value.scores(Words.of(texts, LETTERS))}

    return map_texts(docs, work, "id bigint, score double", id_col, text_col)

"""Quality by attention-based multiple-instance learning (Ilse et al., 2018).

A text is a bag of passages of PASSAGE words. Every passage is encoded from its
own measures (signs, capitals, digits, repetition, word lengths); gated
attention, learnt from document labels only, weighs the passages, and the
weighted sum of their encodings is scored:

    h_k = tanh(E f_k),  a_k = softmax_k(w . (tanh(V h_k) * sigmoid(U h_k)))
    score = sigmoid(c . sum_k a_k h_k + b)

The fit runs on a bounded sample of the labelled rows, all passages of each. They
are measured by executors; gradients are summed over blocks of them, on the driver
up to DRIVER_PASSAGES and by the executors that hold them beyond.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.labels import training_rows
from tidewatch.llm.texts import NOT_BLANK, Words, list_array, map_batches, map_texts, slices
from tidewatch.session import cut

PASSAGE = 64
# Labelled rows to learn from, at most; half of them per class if there are.
SAMPLE_ROWS = 3_000
# Passages of the sampled rows that the driver takes in (43 MB); more stay with the executors.
DRIVER_PASSAGES = 400_000
# Passages whose gradients are summed at a time, whole texts.
BLOCK = 20_000
WIDTH, GATE = 12, 8
STEPS = 150
RATE = 0.03
PENALTY = 1e-4

PARTS, HELD_OUT = 4, 2
KEEP = 0.7

_CODES = np.arange(256)
_SIGNS = (_CODES > 32) & (_CODES < 127) & ~((_CODES >= 48) & (_CODES <= 57))
_SIGNS &= ~((_CODES >= 65) & (_CODES <= 90)) & ~((_CODES >= 97) & (_CODES <= 122))
_PROSE = np.isin(_CODES, [ord(c) for c in ".,;:'\"-()?"])
# Kinds of bytes whose share is measured.
_KINDS = np.stack(
    [
        (_CODES >= 65) & (_CODES <= 90),
        (_CODES >= 97) & (_CODES <= 122),
        (_CODES >= 48) & (_CODES <= 57),
        _CODES >= 128,
        _SIGNS & _PROSE,
        _SIGNS & ~_PROSE,
        *(_CODES == ord(c) for c in "!|.,<>{}/\\=_#"),
    ]
)
MEASURES = len(_KINDS) + 8


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Measures of all passages, and the number of passages of each text.

    A text without words is one passage of zeros.
    """
    words = Words.of(texts, NOT_BLANK)
    counts = np.maximum(1, -(-words.counts // PASSAGE))
    first = np.cumsum(counts) - counts
    total = int(counts.sum())
    out = np.zeros((total, MEASURES))
    if not len(words):
        return out, counts
    owners = words.owners()
    place = np.arange(len(words)) - words.bounds[owners]
    passage = first[owners] + place // PASSAGE
    starts = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
    used = passage[starts]
    ends = np.concatenate([starts[1:], [len(words)]]) - 1
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)  # capitals as they are
    low, high = words.starts[starts], words.ends[ends]
    size = (high - low).astype(float)
    for k, kind in enumerate(_KINDS):
        summed = np.concatenate([[0], np.cumsum(kind[raw], dtype=np.int64)])
        out[used, k] = (summed[high] - summed[low]) / size
    n = (ends - starts + 1).astype(float)
    lens = (words.ends - words.starts).astype(float)
    hashes = words.hashes()
    again = np.concatenate([[False], hashes[1:] == hashes[:-1]]) & (place > 0)
    order = np.lexsort((hashes, passage))
    fresh = np.ones(len(words), bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (passage[order][1:] != passage[order][:-1])
    signed = (_SIGNS & ~_PROSE)[raw[words.ends - 1]]
    k = len(_KINDS)
    mean = np.bincount(passage, lens, total)[used] / n
    out[used, k] = np.bincount(passage, again, total)[used] / n
    out[used, k + 1] = np.bincount(passage[order], fresh, total)[used] / n
    out[used, k + 2] = np.bincount(passage, signed, total)[used] / n
    out[used, k + 3] = np.log1p(mean)
    out[used, k + 4] = np.sqrt(np.maximum(0, np.bincount(passage, lens**2, total)[used] / n - mean**2)) / 10
    out[used, k + 5] = np.bincount(passage, lens <= 3, total)[used] / n
    out[used, k + 6] = np.log(n) / np.log(PASSAGE)
    out[used, k + 7] = 1.0  # there are words
    return out, counts


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Attention:
    mean: np.ndarray
    scale: np.ndarray
    parts: dict[str, np.ndarray]

    def scores(self, texts: list[bytes]) -> np.ndarray:
        measures, counts = passages(texts)
        return self.forward((measures - self.mean) / self.scale, counts)["score"]

    def forward(self, f: np.ndarray, counts: np.ndarray) -> dict:
        p = self.parts
        first = np.cumsum(counts) - counts
        owner = np.repeat(np.arange(len(counts)), counts)
        h = np.tanh(f @ p["E"] + p["e"])
        t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        logit = (t * s) @ p["w"]
        power = np.exp(logit - np.maximum.reduceat(logit, first)[owner])
        a = power / np.add.reduceat(power, first)[owner]
        z = np.add.reduceat(a[:, None] * h, first, axis=0)
        return {"h": h, "t": t, "s": s, "a": a, "z": z, "owner": owner, "first": first,
                "score": _sigmoid(z @ p["c"] + p["b"][0])}

    def gradients(self, f: np.ndarray, counts: np.ndarray, error: np.ndarray) -> dict[str, np.ndarray]:
        """Of the loss whose slope by the score's logit is `error`."""
        p, o = self.parts, self.forward(f, counts)
        h, t, s, a, owner = o["h"], o["t"], o["s"], o["a"], o["owner"]
        error = error(o["score"])
        pull = error[owner][:, None] * p["c"]
        by_a = (pull * h).sum(1)
        by_logit = a * (by_a - np.add.reduceat(a * by_a, o["first"])[owner])
        gate = by_logit[:, None] * p["w"]
        by_t, by_s = gate * s * (1 - t**2), gate * t * s * (1 - s)
        by_h = (a[:, None] * pull + by_t @ p["V"].T + by_s @ p["U"].T) * (1 - h**2)
        return {
            "E": f.T @ by_h, "e": by_h.sum(0), "V": h.T @ by_t, "U": h.T @ by_s,
            "w": (t * s).T @ by_logit, "c": o["z"].T @ error, "b": np.array([error.sum()]),
        }


SHAPES = {"E": (MEASURES, WIDTH), "e": (WIDTH,), "V": (WIDTH, GATE), "U": (WIDTH, GATE), "w": (GATE,), "c": (WIDTH,), "b": (1,)}


def _blocks(measures: np.ndarray, counts: np.ndarray, y: np.ndarray):
    """Whole rows, BLOCK passages at a time or one row of more."""
    ends = np.cumsum(counts)
    low = 0
    while low < len(y):
        done = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + BLOCK, "right")))
        yield measures[done : ends[high - 1]].astype(float), counts[low:high], y[low:high]
        low = high


def _moments(measures: np.ndarray, counts: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Rows of either class, passages, and sums of the measures and of their squares."""
    out = np.zeros(3 + 2 * MEASURES)
    for f, own, label in _blocks(measures, counts, y):
        out += np.concatenate([[(label == 0).sum(), (label == 1).sum(), own.sum()], f.sum(0), (f**2).sum(0)])
    return out


def _slopes(model: Attention, weights: np.ndarray, measures: np.ndarray, counts: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The gradients of the loss, one after another, each row weighed by its class."""
    out = np.zeros(sum(int(np.prod(s)) for s in SHAPES.values()))
    for f, own, label in _blocks(measures, counts, y):
        weight = weights[label.astype(int)]
        found = model.gradients((f - model.mean) / model.scale, own, lambda score, y=label, w=weight: (score - y) * w)
        out += np.concatenate([found[k].ravel() for k in SHAPES])
    return out


def fitted(measures: np.ndarray, counts: np.ndarray, y: np.ndarray, steps: int = STEPS) -> Attention:
    """A model of rows held here: the measures of all passages, the number of each row, labels."""
    return _descended(lambda work: work(measures, counts, y), steps)


def _descended(summed: Callable, steps: int) -> Attention:
    """summed(work): the sum of work(measures, counts, y) over all rows, wherever they
    are. Both classes weigh the same. Without rows of both classes every score is 1/2."""
    random = np.random.default_rng(11)
    moments = summed(_moments)
    rows, n = moments[:2], moments[2]
    if not rows.all():
        return Attention(np.zeros(MEASURES), np.ones(MEASURES), {k: np.zeros(s) for k, s in SHAPES.items()})
    parts = {k: random.normal(0, 0.3, s) if len(s) == 2 or k in "wc" else np.zeros(s) for k, s in SHAPES.items()}
    mean = moments[3 : 3 + MEASURES] / n
    spread = np.sqrt(np.maximum(0, moments[3 + MEASURES :] / n - mean**2))
    model = Attention(mean, spread + 1e-3, parts)
    state = {k: (np.zeros(s), np.zeros(s)) for k, s in SHAPES.items()}
    cuts = np.cumsum([int(np.prod(s)) for s in SHAPES.values()])[:-1]
    for step in range(1, steps + 1):
        flat = summed(partial(_slopes, model, 0.5 / rows))
        for (k, value), part in zip(parts.items(), np.split(flat, cuts), strict=True):
            mean, square = state[k]
            gradient = part.reshape(value.shape) + PENALTY * value
            mean += 0.1 * (gradient - mean)
            square += 0.01 * (gradient**2 - square)
            value -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return model


def _rows(y: pa.Array, measures: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    counts = np.asarray(pc.list_value_length(measures)).astype(np.int64) // MEASURES
    return np.asarray(measures.flatten()).reshape(-1, MEASURES), counts, np.asarray(y).astype(float)


def trained(docs: DataFrame, labels: DataFrame, parts: int = PARTS, held_out: int = HELD_OUT,
            rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text",
            steps: int = STEPS, driver_passages: int = DRIVER_PASSAGES) -> Attention:
    """Fitted on at most `rows` labelled rows with crc32(id) mod `parts` not `held_out`,
    whole texts. Up to `driver_passages` passages are descended over on the driver;
    with more, every step is a job over the measures where they are stored."""
    sample = training_rows(docs, labels, "quality", parts, held_out, rows, id_col, text_col)
    sample = sample.withColumnRenamed("label", "y")

    def work(y: pa.Array, texts: list[bytes]) -> dict:
        measures, counts = passages(texts)
        return {"y": y, "measures": list_array(measures.astype(np.float32).ravel(), counts * MEASURES)}

    found = cut(map_texts(sample, work, "y bigint, measures array<float>", "y", "text"))
    total = found.agg(F.sum(F.size("measures"))).first()[0] or 0
    if total > driver_passages * MEASURES:
        return _descended(partial(_summed, found), steps)
    table = found.toArrow()
    y, measures = (table.column(i).combine_chunks() for i in range(2))
    flat, counts, y = _rows(y, measures)
    # The same sums whatever the order of rows.
    cuts = np.cumsum(counts)[:-1]
    split = np.split(flat, cuts) if len(y) else []
    order = sorted(range(len(y)), key=lambda i: (y[i], counts[i], xxhash.xxh64_intdigest(split[i].tobytes())))
    flat = np.concatenate([split[i] for i in order]) if order else flat
    return fitted(flat, counts[order], y[order], steps)


def _summed(found: DataFrame, work: Callable) -> np.ndarray:
    """The sum of `work` over the stored rows: some hundred numbers per partition come back."""

    def run(batches):
        out = 0
        for batch in batches:
            out = out + work(*_rows(batch.column(0), batch.column(1)))
        if not isinstance(out, int):
            yield pa.RecordBatch.from_pydict({"sums": pa.array([out.tolist()], pa.list_(pa.float64()))})

    parts = map_batches(found, run, "sums array<double>").collect()
    empty = np.zeros((0, MEASURES), np.float32), np.zeros(0, np.int64), np.zeros(0)
    return np.sum([work(*empty), *(np.array(r["sums"]) for r in parts)], axis=0)


def quality(docs: DataFrame, model: Attention, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: id and score, 0 to 1, of the whole text. A null, empty
    or wordless text is one passage without words and scored as that."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(ids: pa.Array, texts: list[bytes]) -> dict:
        return {"id": ids, "score": shared.value.scores(texts)}

    return map_texts(docs, work, "id bigint, score double", id_col, text_col)


def good(docs: DataFrame, model: Attention, keep: float = KEEP, text_col: str = "text") -> DataFrame:
    """`docs` without the rows that score below `keep`, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for low, high, texts in slices(batch, text_col):
                part = batch.slice(low, high - low)
                yield part.filter(pa.array(shared.value.scores(texts) >= keep))

    return map_batches(docs, run, docs.schema)

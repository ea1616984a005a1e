import zlib

import numpy as np
import pytest

from tidewatch.llm import quality, toxicity
from tidewatch.llm.labels import training_rows
from tidewatch.llm.texts import LETTERS, Words

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def accuracy(scores, labels, name, threshold, parts, held):
    truth = {r["doc_id"]: r[name] for r in labels.collect()}
    rows = [(r["score"], truth[r["id"]]) for r in scores.collect()
            if r["id"] in truth and zlib.crc32(str(r["id"]).encode()) % parts == held]
    return np.mean([(s >= threshold) == bool(y) for s, y in rows])


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    scores = quality.quality(docs, quality.trained(docs, labels))
    assert accuracy(scores, labels, "quality", quality.KEEP, 4, 2) > 0.95


def test_toxicity_on_held_out_rows(tables):
    docs, labels = tables
    scores = toxicity.toxicity(docs, toxicity.trained(docs, labels))
    assert accuracy(scores, labels, "toxic", 0.5, 5, 0) > 0.9


def test_held_out_labels_change_nothing(spark, tables):
    docs, labels = tables
    held = training_rows(docs, labels, "quality", 4, 2, 500)
    ids = {r["id"] for r in held.collect()}
    assert ids and all(zlib.crc32(str(i).encode()) % 4 != 2 for i in ids) and len(ids) <= 500


def test_odd_rows_are_scored(frame, odd, tables):
    docs, labels = tables
    model, machine = quality.trained(docs, labels), toxicity.trained(docs, labels)
    for found in (quality.quality(frame(odd), model), toxicity.toxicity(frame(odd), machine)):
        rows = found.collect()
        assert len(rows) == len(odd) and all(0 <= r["score"] <= 1 for r in rows)
    kept = quality.good(frame(odd), model)
    assert kept.columns == frame(odd).columns and kept.count() <= len(odd)
    assert quality.quality(frame([]), model).collect() == [] == quality.good(frame([]), model).collect()


def test_no_labels(spark, frame):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    docs = frame([(1, "some text"), (2, None)])
    assert {r["score"] for r in quality.quality(docs, quality.trained(docs, labels)).collect()} == {0.5}
    assert all(r["score"] < 0.01 for r in toxicity.toxicity(docs, toxicity.trained(docs, labels)).collect())


def test_odd_labels(spark, frame):
    rows = [(i, "good words here" if i % 2 else "BAD!! BAD!! BAD!!") for i in range(40)] + [(None, "x"), (3, "y")]
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)] + [(None, 1, 1), (5, None, None), (7, 9, 9), (9, 0, 0)],
                                   "doc_id bigint, quality int, toxic int")
    docs = frame(rows)
    scores = {r["id"]: r["score"] for r in quality.quality(docs, quality.trained(docs, labels)).collect()}
    assert scores[11] > scores[12]


def test_attention_gradients():
    choose = np.random.default_rng(1)
    counts = np.array([3, 1, 4])
    f = choose.normal(size=(8, quality.MEASURES))
    y = np.array([1.0, 0.0, 1.0])
    model = quality.fitted(f, counts, y)
    model.parts = {k: choose.normal(0, 0.3, v.shape) for k, v in model.parts.items()}

    def loss():
        s = model.forward(f, counts)["score"]
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).sum()

    gradients = model.gradients(f, counts, lambda s: s - y)
    for name, value in model.parts.items():
        at = tuple(choose.integers(0, n) for n in value.shape)
        old, step = value[at], 1e-6
        value[at] = old + step
        up = loss()
        value[at] = old - step
        down = loss()
        value[at] = old
        assert gradients[name][at] == pytest.approx((up - down) / (2 * step), abs=1e-5)


def test_attention_equals_plain_loops():
    choose = np.random.default_rng(4)
    texts = [b"some words " * 90, b"", b"A!! 12 | x " * 200, b"one"]
    f, counts = quality.passages(texts)
    parts = {k: choose.normal(0, 0.5, s) for k, s in quality.SHAPES.items()}
    model = quality.Attention(f.mean(0), f.std(0) + 0.1, parts)
    at, wanted = 0, []
    for n in counts:
        codes, powers = [], []
        for row in f[at : at + n]:
            x = [(v - m) / s for v, m, s in zip(row, model.mean, model.scale, strict=True)]
            h = [np.tanh(sum(x[i] * parts["E"][i, j] for i in range(len(x))) + parts["e"][j]) for j in range(quality.WIDTH)]
            gate = 0.0
            for g in range(quality.GATE):
                v = sum(h[j] * parts["V"][j, g] for j in range(quality.WIDTH))
                u = sum(h[j] * parts["U"][j, g] for j in range(quality.WIDTH))
                gate += parts["w"][g] * np.tanh(v) / (1 + np.exp(-u))
            codes.append(h)
            powers.append(np.exp(gate))
        z = [sum(p * h[j] for p, h in zip(powers, codes, strict=True)) / sum(powers) for j in range(quality.WIDTH)]
        wanted.append(1 / (1 + np.exp(-(sum(z[j] * parts["c"][j] for j in range(quality.WIDTH)) + parts["b"][0]))))
        at += n
    assert model.scores(texts) == pytest.approx(wanted, abs=1e-9)


def test_one_bad_passage_of_a_long_text_is_learnt_wherever_it_is():
    choose = np.random.default_rng(3)
    bad = b" ".join([b"$$$ ||| <<>> #@ 77 {x}"] * 11)

    def texts(n):
        made = []
        for i in range(n):
            words = choose.choice([b"river", b"stone", b"the", b"walks", b"of", b"Morning", b"quietly"], 20_000)
            parts = [b" ".join(words[k : k + 64]) for k in range(0, 20_000, 64)]
            if i % 2:
                parts[choose.integers(len(parts))] = bad
            made.append(b" ".join(parts))
        return made, np.arange(n) % 2 == 0

    train, y = texts(60)
    model = quality.fitted(*quality.passages(train), y.astype(float))
    new, y = texts(30)
    assert ((model.scores(new) >= 0.5) == y).mean() > 0.95


def test_blocks_and_executors_give_the_same_fit(spark, tables, monkeypatch):
    docs, labels = tables
    texts = [r["text"].encode() for r in docs.where("text is not null").limit(20).collect()]
    here = quality.trained(docs, labels, rows=100, steps=6).scores(texts)
    there = quality.trained(docs, labels, rows=100, steps=6, driver_passages=0).scores(texts)
    assert here == pytest.approx(there, abs=1e-6)
    monkeypatch.setattr(quality, "BLOCK", 7)
    assert here == pytest.approx(quality.trained(docs, labels, rows=100, steps=6).scores(texts), abs=1e-6)
    empty = labels.where("false")
    assert set(quality.trained(docs, empty, driver_passages=-1).scores(texts)) == {0.5}


def test_pairs_of_terms_are_learnt():
    """An insult alone and a group alone are clean; together they are not."""
    choose = np.random.default_rng(2)
    fill = [f"filler{i}" for i in range(30)]
    texts, y = [], []
    for i in range(600):
        insult, group = i % 2 == 0, i % 4 < 2
        words = list(choose.choice(fill, 6)) + ["insult"] * insult + ["group"] * group
        texts.append(" ".join(words).encode())
        y.append(int(insult and group))
    words = Words.of(texts, LETTERS)
    owners, found, counts = toxicity.term_counts(words)
    cuts = np.searchsorted(owners, np.arange(1, len(texts)))
    rows = list(zip(y, np.split(found, cuts), np.split(counts, cuts), strict=True))
    machine = toxicity.fitted(rows, float(np.mean(y)))
    scores = machine.scores(words)
    assert ((scores >= 0.5) == np.array(y, bool)).mean() > 0.97


def test_pair_sum_equals_a_double_loop():
    choose = np.random.default_rng(6)
    texts = [b"one two two three four", b"", b"two five one one one", b"zz"]
    words = Words.of(texts, LETTERS)
    size = 1 << toxicity.TERM_BITS
    slots = choose.integers(-1, 50, size).astype(np.int32)
    machine = toxicity.Machine(slots, 0.3, choose.normal(size=50), choose.normal(size=(50, 4)))
    owners, found, counts = toxicity.term_counts(words)
    for i, score in enumerate(machine.scores(words)):
        held = {}  # terms that share a slot are one term
        for t, n in zip(found[owners == i], counts[owners == i], strict=True):
            if slots[t] >= 0:
                held[slots[t]] = held.get(slots[t], 0) + n
        x = [(s, toxicity.strength(np.array([n]))[0]) for s, n in held.items()]
        total = 0.3 + sum(machine.weights[s] * v for s, v in x)
        for a in range(len(x)):
            for b in range(a):
                total += sum(machine.factors[x[a][0]] * machine.factors[x[b][0]]) * x[a][1] * x[b][1]
        assert score == pytest.approx(1 / (1 + np.exp(-np.clip(total, -30, 30))), abs=1e-9)


def test_margins_of_the_fit_equal_the_scores():
    texts = [b"bad thing here", b"good thing", b"", b"bad bad good"]
    words = Words.of(texts, LETTERS)
    owners, found, counts = toxicity.term_counts(words)
    n = int(found.max()) + 1
    choose = np.random.default_rng(8)
    weights, factors = choose.normal(size=n + 1), choose.normal(size=(n + 1, 4))
    factors[0] = 0
    terms = toxicity.Terms(owners, found, toxicity.strength(counts), len(texts), n)
    slots = np.full(1 << toxicity.TERM_BITS, -1, np.int32)
    slots[:n] = np.arange(n)
    machine = toxicity.Machine(slots, weights[0], weights[1:], factors[1:])
    assert machine.scores(words) == pytest.approx(1 / (1 + np.exp(-terms.margins(weights, factors))), abs=1e-4)
    some = terms.part(np.array([1, 3]))
    assert some.margins(weights, factors) == pytest.approx(terms.margins(weights, factors)[[1, 3]], abs=1e-4)


def test_many_toxic_words_are_learnt(spark):
    """600 words, each of them in few texts, one in a text."""
    choose = np.random.default_rng(7)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    words = sorted({"".join(choose.choice(letters, choose.integers(5, 10))) for _ in range(2_700)})
    choose.shuffle(words)
    toxic, clean = words[:600], words[600:]

    def rows(n, low):
        made = []
        for i in range(n):
            text = list(choose.choice(clean, choose.integers(20, 50)))
            if i % 2:
                text.insert(choose.integers(len(text)), choose.choice(toxic))
            made.append((low + i, " ".join(text), i % 2))
        return made

    train, new = rows(10_000, 0), rows(2_000, 100_000)
    docs = spark.createDataFrame(train + new, "doc_id bigint, text string, toxic int")
    machine = toxicity.trained(docs, docs.where("doc_id < 100000"))
    truth = {r[0]: r[2] for r in new}
    scores = {r["id"]: r["score"] for r in toxicity.toxicity(docs.where("doc_id >= 100000"), machine).collect()}
    found = [scores[i] >= 0.5 for i, y in truth.items() if y]
    false = [scores[i] >= 0.5 for i, y in truth.items() if not y]
    assert np.mean(found) > 0.9 and np.mean(false) < 0.02
    assert toxicity.toxicity(docs.where("false"), machine).collect() == []


def test_terms_neutral_alone_are_learnt_as_a_pair():
    """Either of two words alone is toxic; both or none are clean."""
    choose = np.random.default_rng(3)
    fill = [f"w{i}q" for i in range(300)]
    texts, y = [], []
    for _ in range(4_000):
        a, b = (choose.random(2) < 0.5).tolist()
        texts.append(" ".join(list(choose.choice(fill, 25)) + ["zorgal"] * a + ["mipsen"] * b).encode())
        y.append(int(a != b))
    y = np.array(y, float)
    owners, found, counts = toxicity.term_counts(Words.of(texts, LETTERS))
    known = owners < 3_000
    machine = toxicity.learnt(y[:3_000], owners[known], found[known], counts[known], 0.5)
    scores = machine.scores(Words.of(texts[3_000:], LETTERS))
    assert ((scores >= 0.5) == y[3_000:]).mean() > 0.97

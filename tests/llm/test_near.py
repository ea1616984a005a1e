"""Near copies and repeated passages."""

import glob
import random
import tempfile
import time
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest

from tidewatch.llm import near_copies, substring_dedup
from tidewatch.llm.graph import components
from tidewatch.llm.near_copies import Likeness
from tidewatch.llm.texts import LETTERS, Words, mixed, shingle_hashes


def edited(words, edits, choose):
    out = list(words)
    for _ in range(edits):
        out[choose.randrange(len(out))] = f"z{choose.randrange(10**6)}"
    return out


def near_rows():
    choose = random.Random(2)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for base in range(12):
        words = choose.choices(vocabulary, k=choose.choice([1, 2, 3, 8, 19, 40, 120, 400]))
        for copy in range(8):
            rows.append((base * 100 + copy, " ".join(edited(words, choose.choice([0, 0, 1, 1, 2, 4]), choose))))
    return rows


@pytest.mark.parametrize("like", [Likeness(), Likeness(5, 80, 100), Likeness(1, 70, 100)])
@pytest.mark.parametrize("block_sets", [4000, 4])
def test_components_are_exact(frame, monkeypatch, like, block_sets):
    monkeypatch.setattr(near_copies, "BLOCK_SETS", block_sets)
    rows = near_rows()
    got = near_copies.near_copies(frame(rows), like).collect()
    want = brute.near_components(rows, like.words, like.num, like.den)
    assert {r["id"]: (r["n_shingles"], r["component"]) for r in got} == want
    assert len(got) == len(rows)


def test_corpus(frame, corpus):
    got = near_copies.near_copies(frame(corpus)).collect()
    assert {r["id"]: (r["n_shingles"], r["component"]) for r in got} == brute.near_components(corpus, 3, 90, 100)


def test_odd_rows(frame, odd):
    got = near_copies.near_copies(frame(odd)).collect()
    found = Counter((r["id"], r["n_shingles"], r["component"]) for r in got)
    assert len(got) == len(odd)
    assert found[5, 1, 4] == 2 and found[4, 1, 4] == 1 and found[1, 0, 1] == 1 and found[2, 0, 2] == 1
    assert found[None, 1, None] == 1 and found[None, 0, None] == 1
    assert found[8, 1, 8] == 1 and found[9, 1, 9] == 1 and found[7, 2, 7] == 1
    left = near_copies.one_of_each(frame(odd), Likeness())
    assert left.columns == frame(odd).columns
    ids = Counter(r["doc_id"] for r in left.collect())
    assert ids[4] == 1 and ids[5] == 0 and ids[None] == 2 and ids[1] == ids[2] == ids[8] == 1


def test_nothing(frame):
    assert near_copies.near_copies(frame([])).collect() == []
    assert near_copies.one_of_each(frame([]), Likeness()).collect() == []


def test_linked_sets_share_a_signature():
    choose = np.random.default_rng(3)
    for like in (Likeness(), Likeness(5, 80, 100)):
        for _ in range(300):
            n = int(choose.integers(1, 400))
            a = np.unique(choose.integers(0, 1 << 64, n, dtype=np.uint64))
            keep = choose.random(len(a)) < choose.uniform(0.8, 1)
            b = np.unique(np.concatenate([a[keep], choose.integers(0, 1 << 64, int(choose.integers(0, 1 + n // 10)), dtype=np.uint64)]))
            if not len(b) or not like.links(len(np.intersect1d(a, b)), len(a), len(b)):
                continue
            signs, counts, need = near_copies.signatures(np.concatenate([a, b]), np.array([len(a), len(b)]), like)
            assert len(set(signs[: counts[0]].tolist()) & set(signs[counts[0] :].tolist())) >= need.max() >= 1


def test_graph_components(spark):
    choose = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + choose.randrange(80), 100 + choose.randrange(80)) for _ in range(50)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    group = {}
    for a, b in edges:
        group.setdefault(a, a), group.setdefault(b, b)
    for _ in range(200):
        for a, b in edges:
            group[a] = group[b] = min(group[a], group[b])
    assert got == {n: g for n, g in group.items() if any(n in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def passage_rows():
    choose = random.Random(6)
    words = lambda n: [f"v{choose.randrange(50_000)}" for _ in range(n)]
    hot, pair, near, short = words(70), words(52), words(120), words(40)
    rows = [(i, " ".join(words(30) + hot + words(30))) for i in range(30)]
    rows += [(100, " ".join(words(5) + pair + words(100))), (101, " ".join(words(200) + pair))]
    changed = list(near)
    changed[60] = "other"
    rows += [(200, " ".join(words(9) + near)), (201, " ".join(changed + words(9)))]
    rows += [(300, " ".join(words(60) + short + words(9))), (301, " ".join(short + words(90)))]
    rows += [(i, " ".join(words(150))) for i in range(400, 420)]
    return rows


def test_passages(frame, odd):
    rows = passage_rows() + [r for r in odd if r[0] not in (8,)]
    got = substring_dedup.repeated_passages(frame(rows)).collect()
    ids = {r["id"] for r in got}
    assert ids == {*range(30), 100, 101, 200, 201}
    texts = dict(passage_rows())
    for r in got:
        one, two = brute.words(texts[r["id"]])[r["start"] : r["stop"]], brute.words(texts[r["other_id"]])[r["other_start"] : r["other_stop"]]
        assert len(one) >= 50 and r["functions"] >= 2
        if r["id"] < 200:
            assert one == two
    assert {(r["start"], r["stop"]) for r in got if r["id"] < 30} == {(30, 100)}
    assert {(r["id"], r["other_id"], r["start"], r["stop"]) for r in got if r["id"] >= 100 and r["id"] < 200} == {
        (100, 101, 5, 57), (101, 100, 200, 252)}
    assert {(r["id"], r["start"], r["stop"]) for r in got if r["id"] >= 200} == {(200, 9, 129), (201, 0, 120)}


def test_passages_of_nothing(frame):
    assert substring_dedup.repeated_passages(frame([])).collect() == []
    assert substring_dedup.repeated_passages(frame([(1, "a b c"), (2, None)])).collect() == []


@pytest.mark.parametrize("heavy", [substring_dedup.HEAVY, 3])
def test_exact_passages_of_the_corpus(frame, corpus, monkeypatch, heavy):
    monkeypatch.setattr(substring_dedup, "HEAVY", heavy)
    windows = {}
    for i, text in corpus:
        own = brute.words(text)
        for j in range(len(own) - 49):
            windows.setdefault(tuple(own[j : j + 50]), set()).add((i, j))
    covered = {}
    for r in substring_dedup.repeated_passages(frame(corpus)).collect():
        covered.setdefault(r["id"], set()).update(range(r["start"], r["stop"]))
    shared = [places for places in windows.values() if len({i for i, _ in places}) > 1]
    assert shared
    for places in shared:
        for i in {i for i, _ in places}:
            assert any(set(range(j, j + 50)) <= covered.get(i, set()) for k, j in places if k == i)


def altered_passages(seed):
    """Pairs of passages: 60 words with one inserted, 100 with two inserted, 100
    with 6 replaced, 150 with runs inserted, deleted and replaced."""
    choose = random.Random(seed)
    words = lambda n: [f"u{choose.randrange(10**6)}" for _ in range(n)]
    for n, changes in (
        (60, [(30, 0, 1)]), (60, [(30, 1, 0)]), (100, [(33, 0, 1), (66, 0, 1)]), (100, [(47, 6, 6)]),
        (150, [(40, 0, 5), (100, 2, 0)]), (150, [(75, 9, 9)]), (120, [(60, 12, 0)]), (120, [(60, 0, 12)]),
    ):
        one = words(n)
        two = list(one)
        for place, gone, new in reversed(changes):
            two[place : place + gone] = words(new)
        a, b = brute.shingles(" ".join(one), 5), brute.shingles(" ".join(two), 5)
        assert len(a & b) >= 0.8 * len(a | b)
        yield one, two, words


def test_passages_with_inserted_deleted_and_replaced_runs():
    rng = np.random.default_rng(9)
    for one, two, words in altered_passages(8):
        # Seen from a minimum in the middle of each shared run.
        width = 2 * substring_dedup.AROUND + substring_dedup.SHINGLE
        code = {w: int(rng.integers(1, 1 << 15)) for w in one + two}
        rows = []
        joint = [w for w in one if w in set(two)]
        for function, word in enumerate((joint[12], joint[len(joint) // 2 + 10], joint[-18])):
            c, d = one.index(word), two.index(word)
            seen = np.zeros((2, width), np.uint16)
            for k, (text, at) in enumerate(((one, c), (two, d))):
                for place in range(width):
                    if 0 <= at - substring_dedup.AROUND + place < len(text):
                        seen[k, place] = code[text[at - substring_dedup.AROUND + place]]
            for _, shift, begin, end, equal in substring_dedup.stretches(seen[:1], seen[1:]):
                b, e = int(begin[0]) - substring_dedup.AROUND, int(end[0]) - substring_dedup.AROUND
                bits = np.packbits(equal[0], bitorder="little").tobytes()
                rows.append((1, 2, function, c + b, c + e, d + b + shift, d + e + shift, 0, c, 200, 0, d, 200, bits))
        rows.sort(key=lambda r: (r[3], r[5]))
        names = [x.split()[0] for x in substring_dedup._COLLISIONS.split(",")]
        batch = pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows])
        schema = pa.schema([(x.split()[0], pa.int64()) for x in substring_dedup._PASSAGES.split(",")])
        got = [r for out in substring_dedup._passages(iter([batch]), schema, 50) for r in out.to_pylist()]
        assert [(r["start"], r["stop"], r["other_start"], r["other_stop"]) for r in got] == [(0, len(one), 0, len(two))]


def test_altered_passages_of_documents(frame):
    rows, want = [], 0
    for seed in range(4):
        for one, two, words in altered_passages(seed):
            i = 1000 + len(rows)
            rows += [(i, " ".join(words(20) + one + words(20))), (i + 1, " ".join(words(40) + two + words(7)))]
            want += 2
    found = Counter()
    for r in substring_dedup.repeated_passages(frame(rows)).collect():
        assert {r["id"] // 2, r["other_id"] // 2} == {r["id"] // 2}
        assert min(r["stop"] - r["start"], r["other_stop"] - r["other_start"]) >= 50
        found[r["id"]] += 1
    assert len(found) == want


def test_shared_text_before_a_stock_sentence(frame):
    choose = random.Random(10)
    words = lambda n: [f"s{choose.randrange(10**6)}" for _ in range(n)]
    stock, rows = words(45), []
    for i in range(40):
        own = words(12)
        rows += [(i, " ".join(words(30) + own + stock + words(30))), (1000 + i, " ".join(words(12) + own + stock + words(50)))]
    rows += [(i, " ".join(words(60) + stock + words(60))) for i in range(100, 400)]
    got = substring_dedup.repeated_passages(frame(rows)).collect()
    found = {(r["id"], r["other_id"], r["start"], r["stop"]) for r in got}
    assert found == {x for i in range(40) for x in ((i, 1000 + i, 30, 87), (1000 + i, i, 12, 69))}


def test_every_place_of_a_passage_is_reported(frame):
    choose = random.Random(11)
    words = lambda n: [f"r{choose.randrange(10**6)}" for _ in range(n)]
    rows, want = [], set()
    for i in range(20):
        passage = words(90)
        changed = [*passage[:45], *words(1), *passage[46:]]
        places = [30, 180, 330, 480]
        rows.append((2 * i, " ".join(x for _ in places for x in words(30) + passage + words(30))))
        rows.append((2 * i + 1, " ".join(words(11) + changed + words(40))))
        want |= {(2 * i, 2 * i + 1, p, 11) for p in places} | {(2 * i + 1, 2 * i, 11, p) for p in places}
    got = substring_dedup.repeated_passages(frame(rows)).collect()
    found = {(r["id"], r["other_id"], r["start"], r["other_start"]) for r in got if r["stop"] - r["start"] == 90}
    assert found == want


def test_groups_of_a_heavy_minimum_meet():
    width = 2 * substring_dedup.AROUND + substring_dedup.SHINGLE
    marks = np.random.default_rng(12).integers(1, 1 << 12, (2, width)).astype(np.uint16)
    middle = slice(substring_dedup.AROUND, substring_dedup.AROUND + substring_dedup.SHINGLE)
    marks[1, middle] = marks[0, middle]
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    schema = lambda text: pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in text.split(",")])
    windows, collisions = schema(substring_dedup._WINDOWS), schema(substring_dedup._COLLISIONS)
    sent = substring_dedup._sent_marks(marks)
    assert (substring_dedup._marks_of(sent) == marks).all()
    row = lambda salt, doc, k: (7, salt, doc, 0, 0, 60, 200, sent[k].as_py(), k)
    batch = lambda rows: pa.RecordBatch.from_pylist([dict(zip(windows.names, r, strict=True)) for r in rows], windows)
    pairs, firsts = set(), []
    for part in ([row(1, 1, 0), row(1, 2, 1), row(1, 3, 1)], [row(2, 4, 1), row(2, 5, 1)]):
        # The rows of a group come in one batch or in several.
        for cuts in ([part], [part[:2], part[2:]], [[r] for r in part]):
            batches = [batch(rows) for rows in cuts if rows]
            own = {(r["a"], r["b"]) for out in substring_dedup._collisions(iter(batches), collisions) for r in out.to_pylist() if r["stop"] - r["start"] >= 50}
            first = [tuple(r.values()) for out in substring_dedup._first_windows(iter(batches), windows) for r in out.to_pylist()]
            pairs |= own
        firsts += first
    assert {(r[1], r[2]) for r in firsts} == {(0, 1), (1, 3), (0, 4), (1, 5)}
    for out in substring_dedup._collisions(iter([batch(sorted(firsts, key=lambda r: (r[1], r[8], r[2])))]), collisions):
        pairs |= {(r["a"], r["b"]) for r in out.to_pylist() if r["stop"] - r["start"] >= 50}
    assert {(2, 3), (4, 5), (3, 5)} <= pairs


def test_every_minimum_dealt_to_groups(frame, monkeypatch):
    want = {r["id"] for r in substring_dedup.repeated_passages(frame(passage_rows())).collect()}
    monkeypatch.setattr(substring_dedup, "HEAVY", 2)
    got = substring_dedup.repeated_passages(frame(passage_rows())).collect()
    assert {r["id"] for r in got} == want
    assert {(r["start"], r["stop"]) for r in got if r["id"] < 30} == {(30, 100)}


def test_recall_of_edited_passages(frame):
    """Pairs of passages with one to six replaced words, 0.8 alike or more."""
    choose = random.Random(13)
    words = lambda n: [f"q{choose.randrange(10**6)}" for _ in range(n)]
    rows, pairs = [], 0
    while pairs < 250:
        one = words(choose.choice([55, 60, 100, 150, 300]))
        two = edited(one, choose.randint(1, 6), choose)
        a, b = brute.shingles(" ".join(one), 5), brute.shingles(" ".join(two), 5)
        if len(a & b) >= 0.8 * len(a | b) and one[:5] == two[:5] and one[-5:] == two[-5:]:
            rows += [(2 * pairs, " ".join(words(30) + one + words(9))), (2 * pairs + 1, " ".join(words(11) + two + words(40)))]
            pairs += 1
    found = {(r["id"], r["other_id"]) for r in substring_dedup.repeated_passages(frame(rows)).collect()}
    assert all(a // 2 == b // 2 for a, b in found)
    assert len(found) >= 0.95 * 2 * pairs


def test_compact_windows_hold_every_minimum():
    choose = random.Random(7)
    texts = [" ".join(choose.choices("abcdefgh", k=n)) for n in (3, 60, 200)]
    words = Words.of([t.encode() for t in texts], LETTERS)
    who, sign, left, centre, right = substring_dedup.compact_windows(words, 0, 20)
    assert set(who.tolist()) <= {1, 2} and (left <= centre).all() and (centre <= right).all()
    assert (right - left + 1 >= 16).all()
    for text in (1, 2):
        own = who == text
        n = len(texts[text].split()) - 4
        # Each subsequence of 16 tokens lies in a window round its minimum, or in
        # a later one with a signature that stood before.
        seen = set(sign[own].tolist())
        assert seen and left[own].min() == 0 and right[own].max() == n - 1


def test_words_are_hashed_once_for_all_hash_functions(monkeypatch):
    calls = []
    made = Words.hashes
    monkeypatch.setattr(Words, "hashes", lambda self: calls.append(1) or made(self))
    words = Words.of([b"one two three four five six seven eight nine ten"] * 2, LETTERS)
    every = np.full(substring_dedup.BITMAP_BITS // 8, 255, np.uint8)
    found = substring_dedup._handed_in(pa.array([1, 2]), words, (every, ~every), 4, 8)
    assert len(found["sig"]) and calls == [1]


def test_shingles_of_marks_are_told_apart_exactly():
    marks = np.array([[1, 2, 3, 4, 5, 4095, 4095, 4095, 4095, 4095, 0, 1]], np.uint16)
    got = substring_dedup._runs(marks, 7)[0].tolist()
    rows = [marks[0, k : k + 5].tolist() for k in range(8)]
    assert got == [7 if 0 in row else sum(m << 12 * (4 - k) for k, m in enumerate(row)) for row in rows]


def test_texts_are_read_once_for_all_windows(frame, capsys):
    substring_dedup.repeated_passages(frame(passage_rows()), 50).explain()
    plan = [line.strip(" :+-") for line in capsys.readouterr().out.split("\n")]
    # Texts to windows, their meetings and the first ones of heavy groups, then passages;
    # the first two stand there for both readers of one shuffle.
    assert len([line for line in plan if line.startswith("MapInArrow")]) == 6
    at = [i for i, line in enumerate(plan) if line.startswith("Filter") and "salt" in line]
    assert len(at) == 1 and plan[at[0] + 1].startswith("Exchange hashpartitioning(sig")


def test_bounds_are_those_of_a_cartesian_tree():
    rng = np.random.default_rng(14)
    counts = np.array([0, 40, 1, 0, 300, 7])
    owners = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    at = np.flatnonzero(rng.random(len(owners)) < 0.4)
    for values in (rng.permutation(len(at)), np.arange(len(at)), np.arange(len(at))[::-1]):
        values = values.astype(np.uint64)
        left, right = substring_dedup._bounds(values, at, owners[at], first, counts)
        for i, place in enumerate(at.tolist()):
            own = [j for j in range(len(at)) if owners[at[j]] == owners[place] and values[j] < values[i]]
            before, after = [at[j] + 1 for j in own if j < i], [at[j] - 1 for j in own if j > i]
            assert left[i] == max([first[owners[place]], *before])
            assert right[i] == min([first[owners[place]] + counts[owners[place]] - 1, *after])


def test_shingle_hashes_of_any_size():
    hashes = np.random.default_rng(15).integers(0, 1 << 63, 70).astype(np.uint64)
    base = 0xD1342543DE82EF95
    for size in (1, 2, 3, 5, 10, 50, 70):
        want = [sum(h * pow(base, size - k, 1 << 64) for k, h in enumerate(hashes[i : i + size].tolist())) % (1 << 64) for i in range(71 - size)]
        assert (shingle_hashes(hashes, size) == mixed(np.array(want, np.uint64))).all()
    assert len(shingle_hashes(hashes, 71)) == 0


def test_shuffles_of_the_first_pass_are_not_kept(spark, frame):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    files = lambda: {*glob.glob(f"{tempfile.gettempdir()}/blockmgr-*/*/shuffle_*.data")}
    was, before = files(), spark.conf.get(name, None)
    kept = frame(passage_rows()).repartition(3, "doc_id").groupBy("doc_id").count()
    assert len(substring_dedup._collected(kept)) == len({i for i, _ in passage_rows()})
    assert spark.conf.get(name, None) == before
    until = time.time() + 20
    while files() - was and time.time() < until:
        time.sleep(0.2)
    assert not files() - was
    kept.collect()
    assert files() - was

"""The prefix trie of conversations."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from tidewatch.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, a string, shard int"


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(3)


def nodes_of(rows):
    """The rows of all nodes, plainly. Turns of one conversation have different numbers."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(own)] for c, own in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - (abs(c) % 100) * (1 if c > 0 else -1)
        built[c] = tuple(convs.get(first, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    kids = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, own in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += (len(own) - 1) * len(node[-1][1]) if node else 0
    out = Counter()
    for node, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if built[c] == node)
        out[min(own), len(node), min(members[node[:-1]]) if node else None, len(own), kids[node], leaves[node], saved[node],
            hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def found(spark, rows, **options):
    return Counter(tuple(r) for r in prefix_trie.prefix_trie(frame_of(spark, rows), **options).collect())


def test_given_conversations(spark):
    table = pq.read_table("/root/testdata/sf0.001/conversations.parquet")
    rows = list(zip(*(table[c].to_pylist() for c in ("conv_id", "turn", "role", "text")), strict=True))
    assert found(spark, rows) == nodes_of(rows)


def some_rows(seed, n):
    rng = random.Random(seed)
    texts = ["a", "bb", "", "é\U0001f600c", None]
    return [
        (c, turn or None, rng.choice(["user", "bot", None]) if rng.random() < 0.4 else "user", rng.choice(texts[: rng.randint(1, 5)]))
        for c in range(-n // 4, n) if c % 7 for turn in range(rng.choice([1, 1, 2, 3, 4, 7, 12]))
    ]


@pytest.mark.parametrize("limit", [1, 3, 20, 10_000])
def test_random_conversations(spark, limit):
    """Few texts, so that prefixes are shared, heavy at many depths, and some conversations end on heavy ones."""
    rows = some_rows(limit, 250)
    assert found(spark, rows, limit=limit) == nodes_of(rows)


def test_copies_of_one_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "WINDOW_BITS", 3)
    rows = [(c, t, "user", f"turn {t}") for c in range(400) for t in range(3)] + [(500, 0, "user", "x" * 100_000)]
    got = found(spark, rows)
    assert got == nodes_of(rows)


def test_a_very_long_conversation(spark):
    rows = [(c, t, "user", str(t % 5)) for c, n in ((100, 700), (150, 650), (230, 2)) for t in range(n)]
    assert found(spark, rows) == nodes_of(rows)
    rows = [(c, t, "user", str(t % 5)) for c, n in ((100, 60), (150, 50), (230, 2)) for t in range(n)]
    assert found(spark, rows, limit=1) == nodes_of(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "lost"), (7, None, None, None), (7, 3, "user", ""), (None, None, None, None), (300, 0, "a", "b")]
    assert found(spark, rows) == nodes_of(rows)
    # Ties and repeated rows: each is a turn, in an order that is the same every time.
    ties = [(301, 1, "user", "p"), (301, 1, "user", "q"), (301, 1, "user", "p"), (301, 1, "bot", "p")] * 3
    first = found(spark, ties)
    assert first == found(spark, ties[::-1]) and sum(first.values()) == 1 + 12 - zlib.crc32(b"301") % 6
    assert found(spark, []) == Counter()


def test_double_array_holds_every_edge_and_no_other():
    rng = np.random.default_rng(1)
    lens = np.sort(rng.integers(0, 9, 300))
    ids = np.minimum(rng.geometric(0.2, lens.sum()) * rng.integers(1, 40, lens.sum()), 900)
    trie = prefix_trie.DoubleArray(ids, lens)
    starts = np.cumsum(lens) - lens
    states = {}
    for i, (start, n) in enumerate(zip(starts, lens, strict=True)):
        state = 0
        for d in range(n):
            below = trie.base[state] + ids[start + d]
            assert trie.check[below] == state
            state = below
            assert trie.reached[d + 1][i - len(lens)] == state
            assert states.setdefault(int(state), tuple(ids[start : start + d + 1])) == tuple(ids[start : start + d + 1])
    assert len(set(states.values())) == len(states) == int((trie.check >= 0).sum()) - 1


def test_shared_rows_are_shuffled_by_group_only(spark):
    plan = prefix_trie.rebuilt(frame_of(spark, some_rows(1, 20)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan

"""Conversations as a prefix trie, by double-array tries per prefix shard.

Turns are known by 128-bit hashes of role and text; no text is shuffled. Equal
conversations are one sequence with a weight before any trie is built, so a
conversation copied a billion times is one path.

A prefix is heavy when more than SHARD_SEQUENCES distinct sequences start with
it; the root always is. A sequence belongs to the shard of its first prefix that
is not heavy, so a shard holds a bounded number of sequences, and every node of
a shard below the heavy prefixes lies in it whole. Light prefixes are packed
into shards of about that size by their hashes.

In a shard the turns get dense ids, frequent ones first, and the sequences are
packed into a double array: BASE and CHECK, where child c of state s is the slot
BASE[s] + c if CHECK of that slot is s. Walking all sequences through it a level
at a time gives the members of each state; going back over the states in the
opposite order gives what a subtree sums up. Nodes of heavy prefixes occur in
many shards: their parts are added up over all shards, and what they add
themselves is passed to their ancestors.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.ship import ship
from tidewatch.llm.texts import arrow_schema, map_batches, mixed, powers, record_batch
from tidewatch.session import cut
from tidewatch.sizes import broadcast_if

# Turns taken from the conversation a group of ids starts with, and ids in a group.
SHARED_TURNS = 5
GROUP = 100
# Distinct sequences that may start with a prefix which is not cut further.
SHARD_SEQUENCES = 4_000
# Conversation ids put together in one string: those of equal conversations
# within a window of 2 ** WINDOW_BITS.
WINDOW_BITS = 10
# Turns that a shard holds about, if its sequences are long.
SHARD_TURNS = 200_000

EMPTY = hashlib.sha256(b"").hexdigest()


def shared_turns(conv_id: Column) -> Column:
    """How many turns a conversation shares: its id's crc32 modulo SHARED_TURNS + 1."""
    return F.pmod(F.crc32(conv_id.cast("string").cast("binary")), F.lit(SHARED_TURNS + 1)).cast("int")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): every conversation's turns (hashes a and b, characters n)
    after its first ones were replaced by those its group starts with.

    Rows are shuffled once, by group, and then need no join: a group is at most
    GROUP conversations (twice that around 0), a row each.
    """
    c = F.col("conv_id")
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    turn = F.struct(
        F.col("turn").cast("bigint").alias("turn"), F.xxhash64(F.lit(1), role, text).alias("a"),
        F.xxhash64(F.lit(2), role, text).alias("b"), F.length(text).cast("bigint").alias("n"),
    )
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("turn")).where("conv_id is not null")
    rows = rows.withColumn("first", c - c % GROUP).repartition("first")
    own = rows.groupBy("first", "conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    own = own.select("first", "conv_id", F.transform("turns", lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"), t["n"].alias("n"))).alias("turns"))
    head = F.any_value(F.when(c == F.col("first"), F.slice("turns", 1, SHARED_TURNS)), True)
    groups = own.groupBy("first").agg(head.alias("head"), F.collect_list(F.struct("conv_id", "turns")).alias("all"))
    each = groups.select(F.coalesce("head", F.array().cast(own.schema["turns"].dataType)).alias("head"), F.inline("all"))
    h = shared_turns(c)
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    return each.select("conv_id", F.concat(F.slice("head", F.lit(1), h), rest).alias("turns"))


SEQUENCE = "conv_id bigint, weight bigint, ends string, a array<bigint>, b array<bigint>, n array<bigint>, p array<bigint>, q array<bigint>"


def prefix_hashes(turns: np.ndarray, salt: int) -> np.ndarray:
    """Hashes of all non-empty prefixes of a sequence of 64-bit hashes."""
    with np.errstate(over="ignore"):
        sums = np.cumsum(mixed(turns + np.uint64(salt)) * powers(len(turns)))
        return mixed(sums + np.arange(1, len(turns) + 1, dtype=np.uint64))


def sequences(found: DataFrame) -> DataFrame:
    """Distinct sequences of `found` (conv_id, turns): smallest conv_id, weight,
    ends (SHA-256 of all its conv_ids), turn hashes a and b, characters n, and
    prefix hashes p and q.

    A window of ids makes one string, however many conversations are equal; the
    strings of a sequence pass through the digest in order, one at a time.
    """
    keyed = found.select(
        F.xxhash64(F.lit(1), "turns").alias("k"), F.xxhash64(F.lit(2), "turns").alias("l"),
        F.shiftright("conv_id", WINDOW_BITS).alias("window"), "conv_id", "turns",
    )
    windows = keyed.groupBy("k", "l", "window").agg(
        F.sort_array(F.collect_list("conv_id")).alias("ids"), F.any_value("turns").alias("turns")
    )
    windows = windows.select(
        "k", "l", "window", F.element_at("ids", 1).alias("conv_id"), F.size("ids").cast("bigint").alias("weight"),
        F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"),
        *[F.col("turns")[x].alias(x) for x in ("a", "b", "n")],
    )
    ordered = windows.repartition("k", "l").sortWithinPartitions("k", "l", "window")
    shape = found.sparkSession.createDataFrame([], SEQUENCE).schema
    arrow = arrow_schema(shape)

    def finished(rows: list[dict]) -> pa.RecordBatch:
        columns = {name: [r[name] for r in rows] for name in ("conv_id", "weight", "a", "b", "n")}
        columns["ends"] = [r["digest"].hexdigest() for r in rows]
        for name, of, salt in (("p", "a", 3), ("q", "b", 4)):
            columns[name] = [prefix_hashes(np.array(r[of], np.int64).view(np.uint64), salt).view(np.int64) for r in rows]
        return record_batch(columns, arrow)

    def run(batches):
        done: list[dict] = []
        size, key = 0, None
        for batch in batches:
            for row in batch.to_pylist():
                if (row["k"], row["l"]) != key:
                    if size > 200_000:
                        yield finished(done)
                        done, size = [], 0
                    key = row["k"], row["l"]
                    done.append({**row, "digest": hashlib.sha256(row["ids"].encode())})
                    size += len(row["a"]) + 1
                else:
                    done[-1]["weight"] += row["weight"]
                    done[-1]["digest"].update(b"," + row["ids"].encode())
        if done:
            yield finished(done)

    return map_batches(ordered, run, shape)


def sharded(found: DataFrame, limit: int) -> DataFrame:
    """`found` (see `sequences`) with `cut`, the depth at which its path leaves
    the heavy prefixes (its own length + 1 if it never does), and `shard`.

    Depths are looked at in steps that double, so the rounds grow with the
    logarithm of the deepest heavy prefix. Prefixes are counted before the
    shuffle; only heavy ones, of which a depth has at most rows / limit, meet
    the sequences again.
    """
    sizes = F.size("a").cast("bigint")
    rows, turns, total = found.agg(F.count("*"), F.coalesce(F.max(sizes), F.lit(0)), F.sum(sizes)).first()
    open_rows, low, heavy = found, 0, None
    while rows and low < turns:
        high = max(1, 2 * low)
        places = F.slice(F.arrays_zip(F.sequence(F.lit(1), F.size("p")).alias("d"), F.col("p"), F.col("q")), low + 1, high - low)
        counts = (
            open_rows.where(F.size("p") > low).select(F.inline(places)).toDF("d", "p", "q")
            .groupBy("d", "p", "q").agg(F.count("*").alias("c")).where(F.col("c") > limit).drop("c")
        )
        new = cut(counts)
        n = new.count()
        if not n:
            break
        heavy = new if heavy is None else heavy.unionAll(new)
        # Sequences whose prefix of `high` turns is heavy go on.
        edge = broadcast_if(new.where(F.col("d") == high).select(F.col("p").alias("_p"), F.col("q").alias("_q")), n)
        on = (F.get("p", F.lit(high - 1)) == F.col("_p")) & (F.get("q", F.lit(high - 1)) == F.col("_q"))
        open_rows = open_rows.join(edge, on, "left_semi")
        low = high
    if heavy is not None:
        heavy = cut(heavy.coalesce(8))
        n = heavy.count()
        deepest = heavy.agg(F.max("d")).first()[0]
        places = F.slice(F.arrays_zip(F.sequence(F.lit(1), F.size("p")).alias("d"), F.col("p"), F.col("q")), 1, deepest)
        met = found.where(F.size("p") > 0).select("conv_id", F.inline(places)).toDF("conv_id", "d", "p", "q")
        deep = met.join(broadcast_if(heavy, n), ["d", "p", "q"]).groupBy("conv_id").agg((F.max("d") + 1).alias("cut"))
        found = found.join(deep, "conv_id", "left").withColumn("cut", F.coalesce("cut", F.lit(1)))
    else:
        found = found.withColumn("cut", F.lit(1))
    # The prefix that decides the shard; a sequence that ends before has its own.
    at = F.least("cut", F.size("p")) - 1
    shards = max(1, -(-rows // limit), -(-(total or 0) // SHARD_TURNS))
    shard = F.when(at >= 0, F.pmod(F.get("p", at), F.lit(shards))).otherwise(F.lit(0))
    return found.withColumn("shard", shard)


class DoubleArray:
    """A trie over dense ids, packed level by level. `reached[d]` are the states
    after d turns of the sequences that have so many."""

    def __init__(self, ids: np.ndarray, lens: np.ndarray):
        """ids: the sequences one after another, shorter ones first; lens: their sizes."""
        self.base = np.zeros(16, np.int64)
        self.check = np.full(16, -1, np.int64)
        self.check[0] = 0  # the root is slot 0
        self.free = 1
        self.levels = [np.zeros(1, np.int64)]
        self.reached = [np.zeros(len(lens), np.int64)]
        starts = np.cumsum(lens) - lens
        for depth in range(int(lens[-1])):
            first = int(np.searchsorted(lens, depth, "right"))  # sequences that go on
            state = self.reached[-1][first - len(lens) :]
            child = ids[starts[first:] + depth]
            width = int(child.max()) + 1
            edges = np.unique(state * width + child)
            self._placed(edges // width, edges % width)
            self.reached.append(self.base[state] + child)
            self.levels.append(np.unique(self.reached[-1]))

    def _grown(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def _placed(self, states: np.ndarray, children: np.ndarray) -> None:
        """BASE of each state so that all of its children fall on free slots."""
        starts = np.flatnonzero(np.concatenate([[True], states[1:] != states[:-1]]))
        counts = np.diff(np.concatenate([starts, [len(states)]]))
        # States of one child fit any free slot: behind all others, once those are placed.
        for start, count in sorted(zip(starts[counts > 1].tolist(), counts[counts > 1].tolist(), strict=True), key=lambda x: -x[1]):
            own = children[start : start + count]
            offsets = own - own[0]
            self._grown(self.free + int(offsets[-1]) + 1)
            first = self.free
            while True:
                slots = first + offsets
                self._grown(int(slots[-1]) + 1)
                if (self.check[slots] < 0).all():
                    break
                unused = self.check[first + 1 :] < 0
                first += 1 + (int(np.argmax(unused)) if unused.any() else len(unused))
            self.base[states[start]] = first - own[0]
            self.check[slots] = states[start]
            self._advance()
        single = starts[counts == 1]
        if len(single):
            self._grown(self.free + len(single) + int((self.check[self.free :] >= 0).sum()))
            slots = self.free + np.flatnonzero(self.check[self.free :] < 0)[: len(single)]
            self.base[states[single]] = slots - children[single]
            self.check[slots] = states[single]
            self._advance()

    def _advance(self) -> None:
        rest = np.flatnonzero(self.check[self.free :] < 0)
        self.free += int(rest[0]) if len(rest) else len(self.check) - self.free


NODE = (
    "upper boolean, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint,"
    " saved_tokens bigint, ends_sha256 string, size bigint, p bigint, q bigint, above array<struct<p:bigint,q:bigint>>"
)


def _dense(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Ids from 0 of the pairs (a, b), the most frequent first."""
    order = np.lexsort((b, a))
    new = np.concatenate([[True], (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])])[: len(a)]
    number = np.cumsum(new) - 1
    counts = np.bincount(number)
    rank = np.empty(len(counts), np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
    out = np.empty(len(a), np.int64)
    out[order] = rank[number]
    return out


def shard_nodes(table: pa.Table) -> dict:
    """The nodes of a shard (columns of NODE), from its rows of `sharded`.

    Nodes above a sequence's cut are marked `upper`: their numbers are those of
    this shard's part, saved_tokens without their own. The others are final, but
    for the parent of the topmost, whose key stands in `above`.
    """
    lens = np.asarray(table["a"].combine_chunks().value_lengths(), np.int64)
    order = np.argsort(lens, kind="stable")
    table, lens = table.take(pa.array(order)), lens[order]
    n = len(lens)
    flat = {x: np.asarray(table[x].combine_chunks().flatten(), np.int64) for x in ("a", "b", "n", "p", "q")}
    starts = np.cumsum(lens) - lens
    trie = DoubleArray(_dense(flat["a"], flat["b"]), lens)

    slots = len(trie.check)
    weight, conv, cuts = (np.asarray(table[x], np.int64) for x in ("weight", "conv_id", "cut"))
    members = np.zeros(slots, np.int64)
    least = np.full(slots, np.iinfo(np.int64).max)
    place = np.zeros((5, slots), np.int64)  # depth, characters, key, upper
    depth, size, p, q, upper = place
    digests, ends = table["ends"].to_pylist(), {}
    for d, at in enumerate(trie.reached):
        alive = np.arange(n - len(at), n)
        np.add.at(members, at, weight[alive])
        np.minimum.at(least, at, conv[alive])
        depth[at] = d
        upper[at] |= d < cuts[alive]
        if d:
            turn = starts[alive] + d - 1
            size[at], p[at], q[at] = flat["n"][turn], flat["p"][turn], flat["q"][turn]
        for state, i in zip(at.tolist(), alive[lens[alive] == d].tolist(), strict=False):  # shorter ones first
            ends[state] = digests[i]

    parent = trie.check
    children, leaves, saved = (np.zeros(slots, np.int64) for _ in range(3))
    for level in reversed(trie.levels[1:]):
        whole = level[upper[level] == 0]
        leaves[whole] += children[whole] == 0
        saved[whole] += (members[whole] - 1) * size[whole]
        np.add.at(children, parent[whole], 1)
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    used = np.concatenate(trie.levels)
    top = (upper[used] == 0) & (upper[parent[used]] == 1)
    above = []
    for state, is_top in zip(used.tolist(), top.tolist(), strict=True):
        if not upper[state] and not is_top:
            above.append(None)
            continue
        path = []
        while state:
            state = int(parent[state])
            path.append({"p": int(p[state]), "q": int(q[state])})
            if is_top:
                break
        above.append(path)
    final = upper[used] == 0
    return {
        "upper": ~final, "conv_id": least[used], "depth": depth[used],
        "parent_conv_id": pa.array(least[parent[used]], mask=~final | top),
        "n_convs": members[used], "n_children": children[used], "n_leaves": leaves[used], "saved_tokens": saved[used],
        "ends_sha256": [ends.get(s, EMPTY if f else None) for s, f in zip(used.tolist(), final.tolist(), strict=True)],
        "size": size[used], "p": p[used], "q": q[used], "above": above,
    }


RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _merged(parts: DataFrame) -> DataFrame:
    """The nodes of heavy prefixes, from their parts in all shards."""
    total = {"conv_id": F.min, "n_convs": F.sum, "n_children": F.sum, "n_leaves": F.sum, "saved_tokens": F.sum,
             "ends_sha256": F.max, "size": F.max, "above": F.first}
    keys = ["depth", "p", "q"]
    up = cut(parts.groupBy(*keys).agg(*[f(c).alias(c) for c, f in total.items()]))
    # Children that are heavy prefixes or ends of sequences on them.
    parent = F.get("above", F.lit(0))
    more = up.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), parent["p"].alias("p"), parent["q"].alias("q"))
    up = up.join(more.agg(F.count("*").alias("more")), keys, "left")
    up = up.withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).drop("more")
    # What a node adds itself goes to it and to all above it.
    own = (F.col("n_convs") - 1) * F.col("size")
    adds = up.select(
        "depth", F.when(F.col("n_children") == 0, 1).otherwise(0).alias("leaf"), own.alias("own"),
        F.posexplode(F.concat(F.array(F.struct("p", "q")), F.col("above"))).alias("k", "node"),
    )
    adds = adds.groupBy((F.col("depth") - F.col("k")).alias("depth"), F.col("node.p").alias("p"), F.col("node.q").alias("q"))
    up = up.join(adds.agg(F.sum("leaf").alias("leaf"), F.sum("own").alias("own")), keys)
    return cut(up.withColumns({
        "n_leaves": F.col("n_leaves") + F.col("leaf"), "saved_tokens": F.col("saved_tokens") + F.col("own"),
        "ends_sha256": F.coalesce("ends_sha256", F.lit(EMPTY)),
    }).drop("leaf", "own"))


def prefix_trie(conversations: DataFrame, limit: int = SHARD_SEQUENCES) -> DataFrame:
    """Per node of the trie of all rebuilt conversations, the columns RESULT.

    `conversations`: conv_id, turn, role, text. Turns are ordered by number, null
    first, and among equal numbers by their hashes; a repeated row is a turn
    more. A null role or text is empty, and rows without a conv_id belong to no
    conversation. Further columns are not read. An empty table has no nodes, not
    even a root. Turns are told apart by 128 bits of hash. The turns of one
    conversation (24 bytes each, no text) are held together by a task.
    """
    found = cut(sharded(cut(sequences(rebuilt(conversations))), limit))
    shape = found.sparkSession.createDataFrame([], NODE).schema
    arrow = arrow_schema(shape)

    def work(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([record_batch(shard_nodes(table), arrow)])

    ship(found.sparkSession)
    nodes = cut(found.groupBy("shard").applyInArrow(work, shape))
    up = _merged(nodes.where("upper").select("depth", "p", "q", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                                             "ends_sha256", "size", "above"))
    names = up.select((F.col("depth") + 1).alias("_depth"), F.col("p").alias("_p"), F.col("q").alias("_q"), F.col("conv_id").alias("_conv"))
    names = broadcast_if(names, up.count())
    parent = F.get("above", F.lit(0))
    on = (F.col("depth") == F.col("_depth")) & (parent["p"] == F.col("_p")) & (parent["q"] == F.col("_q"))
    both = nodes.where("not upper").select(*RESULT, "above").unionAll(
        up.withColumn("parent_conv_id", F.lit(None).cast("bigint")).select(*RESULT, "above")
    )
    return both.join(names, on, "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_conv")).select(*RESULT)

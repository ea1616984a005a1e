"""n-gram Jaccard join: size-banded tiles, bitmap signatures, exact intersection.

A text's set holds the hashes of its distinct word shingles. Equal sets are
joined first, as one class. Two sets link at a Jaccard similarity of
num / den or more. Such sets differ in at most H elements, H following from
their sizes, so if the hash range is cut into more than H parts, some part
holds the same elements of both. A size band (tile) has one number of parts;
a set hands in a signature per part, and only sets that share a signature can
link. Signatures are sorted over the cluster at sampled splitters, so one that
very many sets share is spread like any other, and each set is tied to the
first of its run: a few rows per signature and no pairs. More parts than H + 1
are made, so that linked sets share several signatures; sets that share too few
with any others are left out and the rest is tied once more.

The components of these ties are small bags of sets. A bag, or where it is
large each pair of blocks of neighbouring size bands in it, is compared in one
task: bit counts of hashed bitmaps bound the overlap of two sets from above,
what passes is intersected exactly, and sets already known to be connected are
not compared again. The links found give the components.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.exact_dedup import less
from tidewatch.llm.graph import components
from tidewatch.llm.texts import (
    NOT_BLANK,
    SPARK_SEED,
    Words,
    arrow_schema,
    digests,
    list_array,
    map_batches,
    map_texts,
    mixed,
    record_batch,
    shingle_hashes,
    slices,
)
from tidewatch.session import cut
from tidewatch.sizes import broadcast_if

# A tile's largest size over its smallest.
TILE_RATIO = 1.5
# Elements and sets of one block; a task holds two blocks.
BLOCK_ELEMENTS = 2_000_000
BLOCK_SETS = 4_000
COMPARED = 256  # sets compared by bit counts at a time
MOST_BITS = 8192


@dataclass(frozen=True)
class Likeness:
    """Shingle length in words, and the least similarity as a fraction."""

    words: int = 3
    num: int = 90
    den: int = 100

    def links(self, shared: int, a: int, b: int) -> bool:
        return self.den * shared >= self.num * (a + b - shared)

    def most_apart(self, a: int, b: int) -> int:
        """The most elements that linked sets of these sizes differ in."""
        return (self.den - self.num) * (a + b) // (self.den + self.num)


def shingle_sets(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after another, and how many each has.

    A text of fewer words than `size`, but not none, has its whole sequence as one.
    """
    words = Words.of(texts, NOT_BLANK)
    hashes, owners, counts = words.hashes(), words.owners(), words.counts
    values = shingle_hashes(hashes, size)
    whole = owners[: len(values)] == owners[size - 1 :] if len(values) else np.empty(0, bool)
    values, own = values[whole], owners[: len(values)][whole]
    few = np.flatnonzero((counts > 0) & (counts < size))
    if len(few):
        short = [shingle_hashes(hashes[words.bounds[i] : words.bounds[i + 1]], int(counts[i]))[0] for i in few]
        values = np.concatenate([values, mixed(np.array(short, np.uint64) + counts[few].astype(np.uint64))])
        own = np.concatenate([own, few])
    order = np.lexsort((values, own))
    values, own = values[order], own[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (own[1:] != own[:-1])
    return values[fresh], np.bincount(own[fresh], minlength=len(texts))


@lru_cache(maxsize=None)
def tiles(like: Likeness) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First sizes of the tiles, and of each its H and its number of parts."""
    ratio = max(TILE_RATIO, like.den / like.num)
    edges = [1]
    while edges[-1] < 1 << 40:
        edges.append(max(edges[-1] + 1, int(edges[-1] * ratio)))
    apart, parts = [], []
    for low, high in zip(edges, edges[1:], strict=False):
        a = high - 1
        h = like.most_apart(a, a * like.den // like.num)
        # Parts that are empty in both sets say nothing; spare parts make up for
        # about as many as are empty in a small set of the tile.
        n = h + 1
        for _ in range(6):
            n = h + 1 + (math.ceil(1.2 * n * math.exp(-low / n)) + 2 if h else 0)
        apart.append(h)
        parts.append(n)
    return np.array(edges), np.array(apart), np.array(parts)


def signatures(values: np.ndarray, counts: np.ndarray, like: Likeness) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of each set's parts in its tile and, near the tile's lower
    end, in the one below; how many each set has; and how many of them, at
    least, it has in common with any set that it links with."""
    edges, apart, parts = tiles(like)
    full = np.flatnonzero(counts)
    own = np.searchsorted(edges, counts[full], "right") - 1
    below = (own > 0) & (counts[full] * like.num <= (edges[own] - 1) * like.den)
    found, owners = [], []
    need = np.full(len(counts), np.iinfo(np.int32).max)
    first = np.cumsum(counts) - counts
    for sets, tile in ((full, own), (full[below], own[below] - 1)):
        if not len(sets):
            continue
        lens = counts[sets]
        at = np.repeat(first[sets] - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())
        v = values[at]
        n = np.repeat(parts[tile], lens).astype(np.uint64)
        part = ((v >> np.uint64(32)) * n) >> np.uint64(32)
        place = np.repeat(np.arange(len(sets)), lens)
        starts = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (place[1:] != place[:-1])]))
        with np.errstate(over="ignore"):
            sums = np.add.reduceat(mixed(v), starts)
            head = (tile.astype(np.uint64)[place[starts]] << np.uint64(48)) | part[starts]
            found.append(mixed(sums ^ mixed(head + np.uint64(1))))
        owners.append(sets[place[starts]])
        empty = parts[tile] - np.bincount(place[starts], minlength=len(sets))
        # Of the parts, at most `apart` differ, and those empty in both are as many
        # as this set has empty, at most.
        need[sets] = np.minimum(need[sets], np.maximum(1, parts[tile] - apart[tile] - empty))
        # A set with so many empty parts that two such sets might agree in no
        # other part hands in its empty parts too.
        for k in np.flatnonzero((empty >= parts[tile] - apart[tile]) & (empty > 0)):
            missing = np.setdiff1d(np.arange(parts[tile[k]], dtype=np.uint64), part[place == k])
            head = (np.uint64(tile[k]) << np.uint64(48)) | missing
            found.append(mixed(mixed(head + np.uint64(1))))
            owners.append(np.full(len(missing), sets[k]))
    if not found:
        return np.empty(0, np.uint64), np.zeros(len(counts), np.int64), need
    found, owners = np.concatenate(found), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return found[order], np.bincount(owners, minlength=len(counts)), need


def _sums(values: np.ndarray, counts: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit hash of each set."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        with np.errstate(over="ignore"):
            out[full] = np.add.reduceat(mixed(values + np.uint64(salt)), (np.cumsum(counts) - counts)[full])
    return mixed(out)


def _ties(batches, schema: pa.Schema):
    """Ties (a, b) of each row of a sorted partition with the first of its run;
    rows with a null b name the partition's first and last runs."""
    first_row, last, previous, opened = True, None, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        sig, node = (np.asarray(batch.column(i)) for i in range(2))
        new = np.concatenate([[previous != sig[0]], sig[1:] != sig[:-1]])
        run = np.maximum.accumulate(np.where(new, np.arange(len(sig)), -1))
        heads = np.where(run >= 0, node[np.maximum(run, 0)], last if last is not None else 0)
        tied = np.flatnonzero(~new & (heads != node))
        # The first tie of a run tells that its head shares the signature.
        opens = np.concatenate([[True], sig[tied][1:] != sig[tied][:-1]])[: len(tied)]
        if len(tied) and sig[tied[0]] == opened:
            opens[0] = False
        yield record_batch(_tie_columns(sig[tied], heads[tied], node[tied], opens), schema)
        if len(tied):
            opened = sig[tied[-1]]
        if first_row:
            yield record_batch(_tie_columns(sig[:1], node[:1], None, [False]), schema)
            first_row = False
        previous, last = sig[-1], heads[-1]
    if previous is not None:
        yield record_batch(_tie_columns(np.array([previous]), np.array([last]), None, [False]), schema)


def _tie_columns(sig, a, b, opens) -> dict:
    return {"sig": sig, "a": a, "b": [None] * len(a) if b is None else b, "opens": opens}


def ties(rows: DataFrame) -> DataFrame:
    """(a, b, opens): nodes of `rows` (sig, node) that share a sig, each with one
    other of it; `opens` once per sig and `a`, or a few times more."""
    shape = rows.sparkSession.createDataFrame([], "sig bigint, a bigint, b bigint, opens boolean").schema
    arrow = arrow_schema(shape)
    placed = rows.repartitionByRange("sig", "node").sortWithinPartitions("sig", "node")
    found = cut(map_batches(placed, lambda batches: _ties(batches, arrow), shape))
    # Two rows per partition; runs that go on in the next are tied through them.
    ends = found.where("b is null").select("sig", F.col("a").alias("node"))
    least = ends.groupBy("sig").agg(F.min("node").alias("a"))
    across = ends.join(least, "sig").where("a <> node").select("a", F.col("node").alias("b"), F.lit(True).alias("opens"))
    return found.where("b is not null").select("a", "b", "opens").unionAll(across)


def strong(found: DataFrame, needs: DataFrame) -> DataFrame:
    """(node): those of `needs` (node, need) with enough signatures that others share."""
    shared = found.select(F.col("b").alias("node")).unionAll(found.where("opens").select(F.col("a").alias("node")))
    counts = shared.groupBy("node").agg(F.count("*").alias("shared"))
    return needs.join(counts, "node").where("shared >= need").select("node")


def bitmaps(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A hashed bitmap of each set as 64-bit words."""
    bits = min(MOST_BITS, max(64, 1 << int(2 * counts.max(initial=1) - 1).bit_length()))
    out = np.zeros((len(counts), bits // 64), np.uint64)
    at = mixed(values) & np.uint64(bits - 1)
    owners = np.repeat(np.arange(len(counts)), counts)
    np.bitwise_or.at(out, (owners, (at >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (at & np.uint64(63)))
    return out


def linked(ids: np.ndarray, sets: list[np.ndarray], like: Likeness) -> list[tuple[int, int]]:
    """Links that connect the sets as all links among them would."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    ids, sets = ids[order], [sets[i] for i in order]
    sizes = np.array([len(s) for s in sets])
    maps = bitmaps(np.concatenate(sets), sizes)
    group = np.arange(len(sets))
    found = []
    for i in range(1, len(sets)):
        low = int(np.searchsorted(sizes, -(-like.num * sizes[i] // like.den)))
        for high in range(i, low, -COMPARED):
            others = np.arange(max(low, high - COMPARED), high)
            others = others[group[others] != group[i]]
            if not len(others):
                continue
            differ = np.bitwise_count(maps[others] ^ maps[i]).sum(1, dtype=np.int64)
            both = sizes[others] + sizes[i]
            bound = (both - differ) // 2
            for j in others[like.den * bound >= like.num * (both - bound)][::-1]:
                if group[j] == group[i]:
                    continue
                at = np.searchsorted(sets[i], sets[j])
                at[at == len(sets[i])] = 0
                shared = int((sets[i][at] == sets[j]).sum())
                if like.links(shared, sizes[i], sizes[j]):
                    found.append((int(ids[i]), int(ids[j])))
                    group[group == group[i]] = group[j]
    return found


def near_copies(docs: DataFrame, like: Likeness = Likeness(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: id, raw (hash of the text as it stands), n_shingles
    and component (the smallest id reachable by links, its own included).

    A null, empty or wordless text has an empty set and is linked with nothing;
    a row with a null id is linked with nothing and its component is null.
    Repeated rows are equal sets. An empty table gives an empty one.
    """

    def work(ids: pa.Array, texts: list[bytes]) -> dict:
        values, counts = shingle_sets(texts, like.words)
        signs, n, need = signatures(values, counts, like)
        return {
            "id": ids, "raw": digests(texts, SPARK_SEED), "n": counts,
            "h1": _sums(values, counts, 1), "h2": _sums(values, counts, 2), "sigs": list_array(signs, n), "need": need,
        }

    made = map_texts(docs, work, "id bigint, raw bigint, n bigint, h1 bigint, h2 bigint, sigs array<bigint>, need int", id_col, text_col)
    rows = cut(made)
    sets = rows.where("n > 0 and id is not null")
    classes = sets.groupBy("h1", "h2", "n").agg(
        F.min("id").alias("node"), F.min_by("sigs", "id").alias("sigs"), F.first("need").alias("need")
    )
    # Sets that share fewer signatures than a link takes are left out, and the
    # others tied anew among themselves.
    nodes = cut(strong(ties(classes.select(F.explode("sigs").alias("sig"), "node")), classes.select("node", "need")))
    kept = sets.select(F.col("id").alias("node"), "sigs").join(broadcast_if(nodes, nodes.count()), "node")
    bags = components(ties(kept.select(F.explode("sigs").alias("sig"), "node")).select("a", "b"))
    links = links_in(docs, bags, like, id_col, text_col)
    # Of each class: its node, and the component of that.
    nodes = sets.groupBy("h1", "h2", "n").agg(F.min("id").alias("node"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    whole = components(links)
    named = rows.select("id", "raw", "n", "h1", "h2").join(nodes, ["h1", "h2", "n"], "left")
    own = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.coalesce("node", "id")).otherwise(F.col("id"))
    named = named.withColumn("node", own)
    return named.join(broadcast_if(whole, whole.count()), "node", "left").select(
        "id", "raw", F.col("n").alias("n_shingles"), F.coalesce("component", "node").alias("component")
    )


def links_in(docs: DataFrame, bags: DataFrame, like: Likeness, id_col: str, text_col: str) -> DataFrame:
    """(a, b): links that connect the nodes of each bag (node, component)."""
    spark = docs.sparkSession
    bags = cut(bags)
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    inside = texts.join(broadcast_if(bags, bags.count()), texts["id"] == bags["node"]).select("id", "component", "text")
    arrow = arrow_schema(spark.createDataFrame([], "id bigint, bag bigint, n bigint, elements array<bigint>").schema)

    def run(batches):
        for batch in batches:
            for low, high, texts in slices(batch, "text"):
                values, counts = shingle_sets(texts, like.words)
                part = batch.slice(low, high - low)
                yield record_batch(
                    {"id": part.column(0), "bag": part.column(1), "n": counts, "elements": list_array(values, counts)}, arrow
                )

    sets = map_batches(inside, run, "id bigint, bag bigint, n bigint, elements array<bigint>")
    # A little wider than the ratio of two sizes that can link.
    width = math.log(like.den / like.num) * 1.01
    sets = cut(sets.withColumn("band", F.floor(F.log("n") / width)))
    small = (F.col("all_n") <= BLOCK_ELEMENTS) & (F.col("all_sets") <= BLOCK_SETS)
    bands = sets.groupBy("bag", "band").agg(F.sum("n").alias("n"), F.count("*").alias("sets"))
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK_ELEMENTS, F.col("sets") / BLOCK_SETS)).cast("int")
    totals = bands.groupBy("bag").agg(F.sum("n").alias("all_n"), F.sum("sets").alias("all_sets"))
    sized = cut(bands.join(totals, "bag").select("bag", "band", blocks.alias("k"), small.alias("small")))
    count = sized.count()
    near = [
        broadcast_if(sized.select("bag", (F.col("band") - d).alias("band"), F.col("k").alias(f"k{d}"), *(["small"] if not d else [])), count)
        for d in (0, 1, -1)
    ]
    joined = sets.join(near[0], ["bag", "band"]).join(near[1], ["bag", "band"], "left").join(near[-1], ["bag", "band"], "left")
    block = F.pmod(F.xxhash64("id"), F.col("k0")).cast("int")

    def with_each(k: str, tile):
        places = F.when(F.col(k).isNull(), F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.col(k) - 1))
        return F.transform(places, tile)

    def tile(band, x, y, apart: int):
        return F.struct(band.alias("band"), x.cast("int").alias("x"), y.cast("int").alias("y"), F.lit(apart).alias("apart"))

    band = F.col("band")
    spread = F.concat(
        with_each("k0", lambda j: tile(band, F.least(block, j), F.greatest(block, j), 0)),
        with_each("k1", lambda j: tile(band, block, j, 1)),
        with_each("k-1", lambda j: tile(band - 1, j, block, 1)),
    )
    one = F.array(tile(F.lit(-1).cast("bigint"), F.lit(0), F.lit(0), 0))
    placed = joined.select("id", "bag", "elements", F.explode(F.when(F.col("small"), one).otherwise(spread)).alias("tile"))

    def compare(group: pa.Table) -> pa.Table:
        ids = np.asarray(group.column("id").combine_chunks())
        elements = [np.asarray(x.values).view(np.uint64) for x in group.column("elements")]
        found = linked(ids, elements, like) if len(ids) > 1 else []
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return placed.groupBy("bag", "tile").applyInArrow(compare, "a bigint, b bigint")


def one_of_each(docs: DataFrame, like: Likeness, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one row of each component, that with the smallest id; all
    columns as they are. Of rows repeated with id and text equal one stays; an
    id repeated with other texts stays with all of them if it heads its component."""
    found = near_copies(docs, like, id_col, text_col)
    keep = F.coalesce(F.col("id") == F.col("component"), F.lit(True))
    marks = found.groupBy("id", "raw").agg(F.max(keep).alias("keep"), F.count("*").alias("times"))
    return less(docs, cut(marks.where("not keep or times > 1")), id_col, text_col)

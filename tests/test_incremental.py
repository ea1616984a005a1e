"""Silver and gold from what has changed in bronze."""

import random

import pytest

from helpers import bronze_comments, plan, rows
from tidewatch.plans import gold, incremental, silver
from tidewatch.sources.snapshots import SnapshotTables

KEYS = ["comment_id"]


@pytest.fixture
def store(spark, root):
    return SnapshotTables(spark, f"{root}/tables")


def comment(id, keyword="N/A", at=1.0, score=1, body="good bad"):
    return ("p", id, keyword, body, score, f"/c/{id}", at)


def some(rng, n):
    return [
        comment(rng.choice([None, *"abcdefghij"]), rng.choice(["N/A", "k", "l"]), float(rng.randint(1, 3)), rng.randint(1, 2),
                rng.choice(["good", "bad bad", "[deleted]", None]))
        for _ in range(n)
    ]


def steps(lexicon):
    return [
        ("silver", silver.silver_comments),
        ("gold", lambda made: gold.as_stored(gold.gold_comments(made, lexicon))),
    ]


@pytest.mark.parametrize("seed", range(2))
def test_updates_equal_making_all_anew(spark, store, seed):
    """Rows come, change and go; some runs add to bronze and some write it anew."""
    rng = random.Random(seed)
    lexicon = spark.createDataFrame([("good", 1.0), ("bad", -1.0)], "word string, polarity double")
    made = {"direct": some(rng, 12), "indirect": some(rng, 6)}
    for run in range(3):
        before = {name: store.latest(name) for name in made}
        for name in made:
            if run and rng.random() < 0.5:
                new = some(rng, rng.randint(0, 4))
                made[name] = made[name] + new
                # Added rows are new keys in a merge; here any key may come again.
                store.append(bronze_comments(spark, new), name)
            else:
                made[name] = rng.sample(made[name], len(made[name]) * 3 // 4) + some(rng, 2)
                store.overwrite(bronze_comments(spark, made[name]), name)
        if run:
            written = incremental.update(store, before, KEYS, steps(lexicon))
            assert written == {"silver": run, "gold": run}
            incremental.update(store, before, KEYS, steps(lexicon))  # a repeated update changes nothing
            for name in ("silver", "gold"):  # numbering goes on where one update would have left it
                held = store.read(name)
                again = spark.createDataFrame(held.collect(), held.schema)
                store.drop(name)
                for _ in range(run + 1):
                    store.overwrite(again, name)
        else:
            inputs = [store.read(name) for name in made]
            for name, step in steps(lexicon):
                store.overwrite(step(*inputs), name)
                inputs = [store.read(name)]
        whole = silver.silver_comments(store.read("direct"), store.read("indirect"))
        assert rows(store.read("silver")) == rows(whole)
        assert rows(store.read("gold")) == rows(gold.as_stored(gold.gold_comments(whole, lexicon)))


def test_added_rows_are_all_that_is_read_of_bronze(spark, store, root):
    """Where bronze was added to, keys come from the added folder alone; new keys add a folder to silver."""
    store.overwrite(bronze_comments(spark, [comment("a"), comment("b")]), "direct")
    store.overwrite(bronze_comments(spark, []), "indirect")
    store.overwrite(silver.silver_comments(store.read("direct"), store.read("indirect")), "silver")
    store.append(bronze_comments(spark, [comment("c")]), "direct")
    feed = store.changes("direct", 0, 1, KEYS)
    assert all("/part=1/" in f for f in feed.inputFiles()) and feed.inputFiles()
    assert "comment_body" not in plan(feed)
    incremental.update(store, {"direct": 0, "indirect": 0}, KEYS, [("silver", silver.silver_comments)])
    assert store.same_base("silver", 0, 1)
    assert [r["comment_id"] for r in store.read("silver", 1, since=0).collect()] == ["c"]
    # Nothing new: an empty version, no rewriting.
    incremental.update(store, {"direct": 1, "indirect": 0}, KEYS, [("silver", silver.silver_comments)])
    assert store.same_base("silver", 1, 2) and store.read("silver", 2, since=1).count() == 0


def test_touched_keys_are_joined_before_any_text_is_shuffled(spark, store):
    store.overwrite(bronze_comments(spark, [comment("a"), comment("b")]), "direct")
    touched = spark.createDataFrame([("a",)], "comment_id string")
    text = plan(incremental._of(store.read("direct"), touched, KEYS, 1, "left_semi"))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text

import random

import pytest

from helpers import plan, rows
from tidewatch.operators.merge import merge_upsert, new_rows

SCHEMA = "id string, key string, v int, w string"
BOUNDS = [None, 1000]


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def brute(target, source, null_safe):
    def differs(a, b):
        if null_safe:
            return a != b
        return a is not None and b is not None and a != b

    out = []
    for t in target:
        s = next((s for s in source if s[:2] == t[:2] and None not in t[:2]), None)
        changed = s is not None and any(differs(a, b) for a, b in zip(t[2:], s[2:]))
        out.append(s if changed else t)
    known = {t[:2] for t in target if None not in t[:2]}
    return sorted(out + [s for s in source if s[:2] not in known], key=repr)


@pytest.mark.parametrize("bound", BOUNDS)
@pytest.mark.parametrize("null_safe", [False, True])
def test_merge_equals_brute_force(spark, bound, null_safe):
    rng = random.Random(11)

    def some(n):
        keys = rng.sample([(str(i), k) for i in range(12) for k in "ab"], n)
        return [(*k, rng.choice([None, 1, 2]), rng.choice([None, "x", "y"])) for k in keys]

    for _ in range(3):
        target, source = some(14), some(10)
        got = merge_upsert(frame(spark, target), frame(spark, source), ["id", "key"], null_safe, bound)
        assert rows(got) == brute(target, source, null_safe)


@pytest.mark.parametrize("bound", BOUNDS)
def test_null_only_change(spark, bound):
    target = [("1", "a", None, "x"), ("2", "a", 1, "x")]
    source = [("1", "a", 5, "x"), ("2", "a", None, "x")]
    plain = merge_upsert(frame(spark, target), frame(spark, source), ["id", "key"], False, bound)
    safe = merge_upsert(frame(spark, target), frame(spark, source), ["id", "key"], True, bound)
    assert rows(plain) == sorted(target)
    assert rows(safe) == sorted(source)


@pytest.mark.parametrize("bound", BOUNDS)
def test_other_difference_updates_every_column(spark, bound):
    got = merge_upsert(
        frame(spark, [("1", "a", None, "x")]), frame(spark, [("1", "a", 5, "y")]), ["id", "key"], False, bound
    )
    assert rows(got) == [("1", "a", 5, "y")]


@pytest.mark.parametrize("bound", BOUNDS)
def test_two_source_rows_for_one_target_row_raise(spark, bound):
    target = frame(spark, [("1", "a", 1, "x")])
    source = frame(spark, [("1", "a", 2, "x"), ("1", "a", 3, "x")])
    with pytest.raises(Exception, match="two source rows match"):
        merge_upsert(target, source, ["id", "key"], False, bound).count()


@pytest.mark.parametrize("bound", BOUNDS)
def test_unmatched_copies_are_both_inserted(spark, bound):
    source = frame(spark, [("2", "a", 2, "x"), ("2", "a", 2, "x")])
    got = merge_upsert(frame(spark, [("1", "a", 1, "x")]), source, ["id", "key"], False, bound)
    assert got.count() == 3


@pytest.mark.parametrize("bound", BOUNDS)
def test_merge_twice_is_merge_once(spark, bound):
    target = frame(spark, [("1", "a", 1, "x"), ("2", "a", 1, "x")])
    source = frame(spark, [("2", "a", 9, "x"), ("3", "a", 1, "x")])
    once = merge_upsert(target, source, ["id", "key"], False, bound)
    assert rows(merge_upsert(once, source, ["id", "key"], False, bound)) == rows(once)


@pytest.mark.parametrize("bound", BOUNDS)
def test_null_keys_never_match(spark, bound):
    data = [("1", None, 1, "x")]
    assert merge_upsert(frame(spark, data), frame(spark, data), ["id", "key"], False, bound).count() == 2


def test_bounded_merge_does_not_shuffle_the_target(spark, root):
    frame(spark, [("1", "a", 1, "x")]).write.parquet(f"{root}/t")
    frame(spark, [("2", "a", 1, "x")]).write.parquet(f"{root}/s")
    target, source = spark.read.parquet(f"{root}/t"), spark.read.parquet(f"{root}/s")
    text = plan(merge_upsert(target, source, ["id", "key"], False, 10))
    assert "SortMergeJoin" not in text and "ShuffledHashJoin" not in text
    lines = text.splitlines()
    for at, line in enumerate(lines):
        if "FileScan" in line and "v#" in line and f"{root}/t" in line:
            above, level = [], len(line) - len(line.lstrip(" :+-"))
            for x in reversed(lines[:at]):
                if len(x) - len(x.lstrip(" :+-")) < level:
                    above.append(x)
                    level = len(x) - len(x.lstrip(" :+-"))
            # Nothing leaves the scan before it has met the broadcast keys.
            joined = next(i for i, x in enumerate(above) if "BroadcastHashJoin" in x)
            assert not any("Exchange" in x for x in above[:joined])


def test_new_rows_by_key_nulls_equal(spark):
    current = frame(spark, [("1", "a", 1, "x"), ("2", None, 1, "x"), ("3", None, 1, "x")])
    previous = frame(spark, [("1", "a", 0, "y"), ("2", None, 1, "x"), ("9", "a", 1, "x")])
    assert rows(new_rows(current, previous, ["id", "key"]), "id") == [("3",)]


def test_merge_broadcasts_keys_only(spark, root):
    frame(spark, [("1", "a", 1, "x"), ("2", "a", 1, "y")]).write.parquet(f"{root}/t2")
    frame(spark, [("2", "a", 1, "z")]).write.parquet(f"{root}/s2")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(merge_upsert(spark.read.parquet(f"{root}/t2"), spark.read.parquet(f"{root}/s2"), ["id", "key"], False, 10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = text.splitlines()
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    for at, line in enumerate(lines):
        if "BroadcastExchange" in line:
            below = []
            for x in lines[at + 1 :]:
                if depth(x) <= depth(line):
                    break
                below.append(x)
            assert not any("FileScan" in x and "v#" in x for x in below)
    assert "Window" not in text

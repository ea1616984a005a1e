import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import plan, rows
from tidewatch.operators import changes
from tidewatch.operators.changes import config_flags, diff_counts, multiset_diff, same_flag


def listed(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x string")


def test_diff_keeps_surplus_copies(spark):
    old, new = listed(spark, ["x", "x", "y"]), listed(spark, ["x", "y"])
    assert rows(multiset_diff(old, new)) == [("x", "old")]
    assert rows(multiset_diff(new, old)) == [("x", "new")]
    assert rows(diff_counts(old, new)) == [("x", 1)]


def test_order_does_not_matter(spark):
    old, new = listed(spark, ["y", "x", "x"]), listed(spark, ["x", "x", "y"])
    assert rows(multiset_diff(old, new)) == []
    assert same_flag(old, new, "same").first()["same"] is True


def test_nulls_compare_equal(spark):
    assert rows(diff_counts(listed(spark, [None, "a"]), listed(spark, ["a", None]))) == []


def test_flags_each_list_on_its_own(spark):
    a, b = listed(spark, ["x"]), listed(spark, ["x", "z"])
    assert rows(config_flags(a, a, a, a)) == [(True, True, True)]
    assert rows(config_flags(a, b, a, a)) == [(False, True, False)]
    assert rows(config_flags(a, a, a, b)) == [(True, False, False)]
    assert rows(config_flags(None, a, a, a)) == [(False, True, False)]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.sampled_from(["", "a", "b", None]), max_size=6), seed=st.integers(0, 5))
def test_a_shuffled_list_is_the_same(spark, values, seed):
    other = values[:]
    random.Random(seed).shuffle(other)
    frames = [listed(spark, values), listed(spark, other)]
    assert same_flag(*frames, "same").first()["same"] is True
    assert same_flag(frames[0], listed(spark, [*other, "a"]), "same").first()["same"] is False


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, key string, n int, text string").repartition(3)


def test_row_changes_names_all_three_kinds(spark):
    before = [("1", "a", 1, "x"), ("1", "b", 1, "x"), ("2", "a", 2, None), ("3", None, 3, "z"), ("4", "a", 4, "w"), ("9", "a", 1, "same")]
    after = [("1", "a", 1, "x"), ("1", "b", 2, "x"), ("2", "a", 2, ""), ("3", None, 3, "z"), ("5", None, 5, "v"), ("9", "a", 1, "same")]
    got = rows(changes.row_changes(frame(spark, before), frame(spark, after), ["id", "key"]))
    assert got == sorted([("1", "b", "updated"), ("2", "a", "updated"), ("4", "a", "deleted"), ("5", None, "inserted")], key=repr)
    # As many lost as gained: a count alone would show nothing.
    assert len(before) == len(after)


def test_row_changes_of_repeated_keys_and_moved_values(spark):
    keys = ["id", "key"]
    twice = [("1", "a", 1, "x"), ("1", "a", 2, "y")]
    assert rows(changes.row_changes(frame(spark, twice), frame(spark, twice[::-1]), keys)) == []
    assert rows(changes.row_changes(frame(spark, twice), frame(spark, twice + twice[:1]), keys)) == [("1", "a", "updated")]
    swapped = spark.createDataFrame([("1", "a", "p", None)], "id string, key string, u string, v string")
    other = spark.createDataFrame([("1", "a", None, "p")], "id string, key string, u string, v string")
    assert rows(changes.row_changes(swapped, other, keys)) == [("1", "a", "updated")]
    with pytest.raises(ValueError):
        changes.row_changes(frame(spark, twice), swapped, keys)


def test_row_changes_shuffles_no_text(spark):
    text = plan(changes.row_changes(frame(spark, []), frame(spark, []), ["id", "key"]))
    above = text[: text.index("Exchange hashpartitioning(id")]
    assert text.count("Exchange hashpartitioning(id") == 1 and "text#" not in above and "Join" not in text


@pytest.mark.parametrize("seed", range(4))
def test_fingerprints_say_what_the_difference_says(spark, seed):
    rng = random.Random(seed)
    values = ["a", "b", "", None, "\\N", "a b", "ü"]
    one = [(rng.choice(values),) for _ in range(rng.randint(0, 60))]
    lists = {"same": rng.sample(one, len(one)), "more": one + one[:1], "less": one[1:], "other": one[1:] + [(rng.choice(values),)]}
    for new in lists.values():
        old_frame, new_frame = (spark.createDataFrame(x, "line string").repartition(2) for x in (one, new))
        want = changes.same_flag(old_frame, new_frame, "same").first()[0]
        prints = changes.list_fingerprint(old_frame), changes.list_fingerprint(new_frame.withColumnRenamed("line", "other"))
        assert changes.same_fingerprint(*prints, "same").first()[0] == want == (sorted(map(repr, one)) == sorted(map(repr, new)))


def test_fingerprint_shuffles_no_value(spark):
    text = plan(changes.list_fingerprint(spark.createDataFrame([("a",)], "line string")))
    exchanges = [x for x in text.splitlines() if "Exchange" in x]
    assert len(exchanges) == 1 and "SinglePartition" in exchanges[0]

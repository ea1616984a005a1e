from datetime import datetime
from pathlib import Path

import pytest

from checks import registry
from checks.inputs import SCHEMAS
from helpers import post, posts_frame, rows, watch_list
from tidewatch.operators.match import match_posts
from tidewatch.operators.newest import Posts
from tidewatch.sources.snapshots import SnapshotTables
from tidewatch.streaming import stateful
from tidewatch.streaming.follow import follow_posts, read_post_stream


def test_stream_equals_batch_and_replays_change_nothing(spark, root):
    watch = watch_list(spark, ["a"], ["key", "x"])
    store = SnapshotTables(spark, f"{root}/tables")
    arrivals = [
        [post("1", title="key x", at=10.0), post("2", title="none", at=11.0)],
        [post("1", title="key x", at=10.0), post("3", title="KEY", at=5.0), post("4", "b", "key", at=9.0)],
        [],
    ]
    everything = {}
    for part in arrivals:
        if part:
            posts_frame(spark, part, 1).write.mode("append").parquet(f"{root}/in")
        everything.update({p[1]: p for p in part})
        query = follow_posts(
            read_post_stream(spark, f"{root}/in", 1), store, "found", watch, 0, f"{root}/checkpoint"
        )
        query.awaitTermination()
        assert query.exception() is None
    want = match_posts(Posts.of(posts_frame(spark, list(everything.values()))), watch, None, 0)
    assert rows(store.read("found")) == rows(want)

    # A stream that lost its checkpoint starts over; the table stays as it is.
    again = follow_posts(read_post_stream(spark, f"{root}/in"), store, "found", watch, 0, f"{root}/other")
    again.awaitTermination()
    assert rows(store.read("found")) == rows(want)


DAY = 86_400.0


def found(spark, root):
    frame = spark.read.parquet(f"{root}/found")
    return sorted((r["id"], r["key"]) for r in frame.collect())


def arrive(spark, root, watch, posts, delay="1 day", **options):
    posts_frame(spark, posts, 1).write.mode("append").parquet(f"{root}/in")
    query = stateful.follow_matches(
        read_post_stream(spark, f"{root}/in", 1), watch, f"{root}/found", f"{root}/checkpoint", 0, delay, **options
    )
    query.awaitTermination()
    assert query.exception() is None


def test_stateful_stream_finds_once_and_drops_what_is_too_late(spark, root):
    watch = watch_list(spark, ["a", "a"], ["key", "x", "KEY"])
    arrive(spark, root, watch, [post("1", title="key x", at=10 * DAY), post("2", title="none", at=10 * DAY)])
    assert found(spark, root) == [("1", "KEY"), ("1", "key"), ("1", "x")]
    # The same post again, edited, in a later run from the same checkpoint; one that is late, but within the delay.
    arrive(spark, root, watch, [post("1", title="key x!", at=10 * DAY), post("3", body="X", at=9.5 * DAY), post("4", "b", "key", at=11 * DAY)])
    once = [("1", "KEY"), ("1", "key"), ("1", "x"), ("3", "x")]
    assert found(spark, root) == once
    # The watermark passes on to day 19; what is older is dropped, what is newer is not.
    arrive(spark, root, watch, [post("5", title="x", at=20 * DAY)])
    arrive(spark, root, watch, [post("6", title="x", at=12 * DAY), post("7", title="x", at=19.5 * DAY), post("5", title="x", at=20 * DAY)])
    assert found(spark, root) == once + [("5", "x"), ("7", "x")]


def test_stateful_stream_restarted_from_its_checkpoint_adds_nothing(spark, root):
    watch = watch_list(spark, ["a"], [f"k{i}" for i in range(800)])  # found by the automaton
    arrive(spark, root, watch, [post(str(i), title=f"k{i} k{i + 1} ", at=DAY) for i in range(0, 40, 4)])
    first = found(spark, root)
    assert len(first) > 20
    arrive(spark, root, watch, [post("0", title="k0", at=DAY)])
    assert found(spark, root) == first


def test_stateful_stream_plan(spark, root):
    """Text is folded and matched where it is read; matches alone meet the state."""
    watch = watch_list(spark, ["a"], ["key"])
    posts_frame(spark, [post("1", title="key", at=DAY)], 1).write.parquet(f"{root}/in")
    stream = stateful.match_stream(read_post_stream(spark, f"{root}/in"), watch, 0)
    assert stream.isStreaming and "DeduplicateWithinWatermark" in stream._jdf.queryExecution().analyzed().toString()


def test_stateful_stream_needs_a_list_it_can_hold(spark, root, monkeypatch):
    watch = watch_list(spark, ["a"], ["key"])
    monkeypatch.setattr(stateful, "MAX_AUTOMATON_BYTES", 1)
    with pytest.raises(ValueError):
        stateful.match_stream(posts_frame(spark, [post("1")]), watch)


def test_stream_query_writes_and_reads_posts_in_many_tasks(spark, root, monkeypatch):
    """Posts that arrive are written by as many tasks as they take, not by one."""
    ids = range(40)
    tables = {
        "documents": [(n, f"The title {n}\nand a body", "en", f"src{n % 3}", 24) for n in ids],
        "events": [(n, datetime(2024, 1, 3, 0, n), 1, "view", 0.0, "{}") for n in ids],
        "conversations": [(0, 0, "user", "hello")],
    }
    for name, values in tables.items():
        spark.createDataFrame(values, SCHEMAS[name]).repartition(4).write.parquet(f"{root}/{name}.parquet")
    monkeypatch.setattr(registry, "scratch_dir", lambda *_: f"{root}/stream")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = registry.QUERIES["stream_submissions"](spark, root)
        assert rows(got, "id", "key") == sorted((str(n), "The") for n in ids)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(list(Path(root, "stream", "posts").glob("part-*.parquet"))) > 2

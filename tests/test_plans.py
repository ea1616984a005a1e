import random

import pytest
from pyspark.sql import functions as F

from checks import registry
from checks.inputs import FIRST_RUN, Inputs
from conftest import SF_DIR
from helpers import bronze_comments, comments_frame, plan, post, posts_of, rows
from tidewatch import schemas
from tidewatch.plans import full_run
from tidewatch.plans.decisions import growth, has_updates, notify_action, refresh_action
from tidewatch.plans.digest import digest
from tidewatch.plans.full_run import Settings, run_once
from tidewatch.sources.snapshots import SnapshotTables
from tidewatch.sources.watchlist import first_recipient


# --- decision tables, row by row


def test_refresh_decision(spark):
    cases = [
        # exists, both_same, stored, new -> action, updates
        (False, True, 0, 0, "full", False),
        (False, False, 0, 0, "full", False),
        (True, False, 0, 0, "rebuild", False),
        (True, False, 9, 9, "rebuild", False),
        (True, True, 0, 0, "full", False),
        (True, True, 5, 2, "merge", True),
        (True, True, 5, 0, "keep", False),
    ]
    df = spark.createDataFrame([c[:4] for c in cases], "e boolean, b boolean, s int, n int")
    got = df.withColumn("a", refresh_action(*[F.col(c) for c in "ebsn"])).withColumn("u", has_updates(F.col("a")))
    assert [(r["a"], r["u"]) for r in got.collect()] == [c[4:] for c in cases]


def test_notify_decision(spark):
    cases = [
        # same, new items, version -> digest, digest with compat
        (True, 3, 0, "update", "update"),
        (True, 3, 2, "update", "update"),
        (True, 0, 0, "none", "first"),
        (True, 0, 1, "none", "none"),
        (False, 0, 0, "first", "first"),
        (False, 7, 0, "first", "first"),
        (False, 7, 1, "none", "none"),
    ]
    df = spark.createDataFrame([c[:3] for c in cases], "s boolean, n int, v int")
    names = [F.col(c) for c in "snv"]
    got = df.select(notify_action(*names).alias("a"), notify_action(*names, compat=True).alias("b")).collect()
    assert [tuple(r) for r in got] == [c[3:] for c in cases]


def test_growth_is_never_negative(spark):
    df = spark.createDataFrame([(5, 3), (3, 5), (3, None)], "a int, b int")
    assert [r[0] for r in df.select(growth(F.col("a"), F.col("b"))).collect()] == [2, 0, 0]


# --- digest


def submissions(spark, n):
    data = [("a", "k", f"<t{i}>", f"{i:03d}", "/p", 0, "b", float(i % 7), 0.5) for i in range(n)]
    return spark.createDataFrame(data, schemas.SUBMISSIONS)


def comments(spark, n):
    return bronze_comments(spark, [("1", f"c{i:03d}", "k", f"body {i} & more", 1, "/p", float(i % 5)) for i in range(n)])


def recipient(spark):
    return first_recipient(spark.createDataFrame([("me@example.org",)], "_c0 string"))


def test_digest_of_one_page(spark):
    out = digest(
        "update", recipient(spark), submissions(spark, 3), 2, comments(spark, 1), 1,
        report_url="https://example.org/r",
    )
    assert out.columns == ["recipient", "subject", "page", "html", "post_count", "comment_count"]
    (row,) = out.collect()
    assert (row["recipient"], row["subject"], row["page"], row["post_count"], row["comment_count"]) == (
        "me@example.org", "Watch list news", 0, 2, 1,
    )
    assert row["html"] == (
        "<p>To me@example.org</p><p>Since the last digest: 2 posts, 1 comments.</p>"
        "<h4>Posts</h4>&lt;t2&gt;<br>&lt;t1&gt;<h4>Comments</h4>body 0 &amp; more"
        '<p><a href="https://example.org/r">Report</a></p>'
    )


def test_first_digest_has_no_counts(spark):
    (row,) = digest("first", recipient(spark), submissions(spark, 0), 0, comments(spark, 0), 0).collect()
    assert row["page"] == 0 and "first digest" in row["html"]
    assert row["html"].endswith("<h4>Posts</h4><h4>Comments</h4>")


@pytest.mark.parametrize("n, pages", [(0, 1), (1, 1), (10, 1), (11, 2), (20, 2), (21, 3)])
def test_digest_pages_are_dense(spark, n, pages):
    out = digest("update", recipient(spark), submissions(spark, 30), n, comments(spark, 0), 0, page_lines=10)
    assert sorted(r["page"] for r in out.collect()) == list(range(pages))


@pytest.mark.parametrize("page_lines", [4, 10, 1000])
def test_long_digest_loses_no_line(spark, page_lines):
    out = digest(
        "update", recipient(spark), submissions(spark, 40).repartition(5), 40, comments(spark, 30), 30,
        page_lines=page_lines,
    )
    pages = out.orderBy("page").collect()
    assert [p["page"] for p in pages] == list(range(-(-70 // page_lines)))
    assert (len(pages) == 1) == (page_lines >= 70)

    def lines(marker, end):
        found = []
        for p in pages:
            part = p["html"].split(marker)[1].split(end)[0]
            found += [line for line in part.strip().split("<br>") if line]
        return found

    want_posts = [f"&lt;t{i}&gt;" for i in sorted(range(40), key=lambda i: (-(i % 7), f"{i:03d}"))]
    want_comments = [f"body {i} &amp; more" for i in sorted(range(30), key=lambda i: (-(i % 5), f"c{i:03d}"))]
    assert lines("<h4>Posts</h4>", "<h4>Comments</h4>") == want_posts
    assert lines("<h4>Comments</h4>", "<p>") == want_comments
    for p in pages:
        assert p["html"].count("&lt;t") + p["html"].count("&amp; more") <= page_lines


# --- whole runs


@pytest.fixture
def world(spark, root):
    """Runs against the same store, with inputs given per run."""
    lexicon = spark.createDataFrame([("good", 0.5), ("bad", -0.5)], schemas.LEXICON)
    email = spark.createDataFrame([("me@example.org",)], "_c0 string")

    def run(posts, comments, subreddits=("a",), keywords=("key",), sync=None, **options):
        return run_once(
            spark, root, posts_of(spark, posts), comments_frame(spark, comments),
            spark.createDataFrame([(s,) for s in subreddits], schemas.SUBREDDITS),
            spark.createDataFrame([(k,) for k in keywords], schemas.KEYWORDS),
            email, lexicon, Settings(cutoff=0, **options), sync=sync,
        )

    return run, SnapshotTables(spark, f"{root}/tables")


def test_life_of_a_store(world):
    run, store = world
    posts = [post("1", title="key good", at=10.0), post("2", title="none", at=11.0)]
    comments = [
        ("1", "c1", "good", 1, "/c1", 12.0), ("1", "c2", "[deleted]", 1, "/c2", 12.0),
        ("2", "c3", "a bad key", 1, "/c3", 13.0),
    ]

    first = run(posts, comments)
    assert (first.action, first.updates, first.same_sub, first.same_key) == ("full", False, False, False)
    assert (first.new_posts, first.new_comments, first.notify) == (1, 1, "first")
    assert rows(store.read(full_run.GOLD_SUBMISSIONS), "id", "title_sentiment") == [("1", 0.5)]
    assert rows(store.read(full_run.GOLD_COMMENTS), "comment_id", "keyword", "comment_sentiment") == [
        ("c1", "N/A", 0.5), ("c3", "key", -0.5),
    ]
    assert dict(store.read(full_run.GOLD_COMMENTS).dtypes)["comment_sentiment"] == "float"
    assert "first digest" in store.read(full_run.DIGEST).first()["html"]

    quiet = run(posts, comments)
    assert (quiet.action, quiet.updates, quiet.new_posts, quiet.new_comments, quiet.notify) == (
        "keep", False, 0, 0, "none",
    )
    assert store.latest(full_run.SUBMISSIONS) == 0 and store.latest(full_run.INDIRECT) == 1
    assert not store.exists(full_run.STAGING)
    assert run(posts, comments, compat_digest=True).notify == "first"

    posts.append(post("3", title="KEYS", at=20.0))
    comments.append(("3", "c4", "fine", 1, "/c4", 21.0))
    merged = run(posts, comments)
    assert (merged.action, merged.updates, merged.new_posts, merged.new_comments, merged.notify) == (
        "merge", True, 1, 0, "update",
    )
    assert rows(store.read(full_run.SUBMISSIONS), "id") == [("1",), ("3",)]
    assert store.versions(full_run.SUBMISSIONS) == {0: 0, 1: 0}
    assert rows(store.read(full_run.SUBMISSIONS, 0), "id") == [("1",)]
    assert rows(store.read(full_run.DIRECT), "comment_id") == [("c1",), ("c2",), ("c4",)]
    assert "digest: 1 posts, 0 comments" in store.read(full_run.DIGEST).first()["html"]

    changed = run(posts, comments, keywords=("key", "none"))
    assert (changed.action, changed.same_sub, changed.same_key) == ("rebuild", True, False)
    assert (changed.new_posts, changed.notify) == (3, "first")
    assert store.versions(full_run.SUBMISSIONS) == {0: 0}
    assert rows(store.read(full_run.SUBMISSIONS), "id", "key") == [("1", "key"), ("2", "none"), ("3", "key")]


def test_reordered_lists_are_unchanged(world):
    run, _ = world
    posts = [post("1", title="key", at=10.0)]
    run(posts, [], keywords=("key", "other"))
    assert run(posts, [], keywords=("other", "key")).action == "keep"


def test_empty_table_is_matched_in_full_again(world):
    run, store = world
    run([post("1", title="none", at=10.0)], [])
    assert store.read(full_run.SUBMISSIONS).count() == 0
    again = run([post("1", title="key", at=5.0)], [])
    assert (again.action, again.updates, again.same_key) == ("full", False, True)
    assert rows(store.read(full_run.SUBMISSIONS), "id") == [("1",)]


def test_a_run_that_fails_before_its_end_sees_the_same_changes_again(world, monkeypatch):
    run, store = world
    posts = [post("1", title="key other", at=10.0)]
    run(posts, [])
    monkeypatch.setattr(full_run, "update_counts", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run(posts, [], keywords=("other",))
    monkeypatch.undo()
    assert run(posts, [], keywords=("other",)).action == "rebuild"
    assert rows(store.read(full_run.SUBMISSIONS), "key") == [("other",)]


def test_a_run_that_fails_after_its_merge_still_reports_it(world, monkeypatch):
    run, store = world
    posts = [post("1", title="key", at=10.0)]
    run(posts, [])
    posts.append(post("2", title="key", at=20.0))
    monkeypatch.setattr(full_run, "update_counts", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run(posts, [])
    monkeypatch.undo()
    again = run(posts, [])
    assert (again.action, again.new_posts, again.notify) == ("keep", 1, "update")
    assert "digest: 1 posts" in store.read(full_run.DIGEST).first()["html"]
    assert run(posts, []).notify == "none"


def test_strange_lists_do_not_look_changed(world):
    run, _ = world
    posts = [post("1", title="an ai key", at=10.0)]
    strange = ("key", " ai ", "", None, "a\nb", 'x"y')
    run(posts, [], keywords=strange)
    assert run(posts, [], keywords=strange).action == "keep"
    posts.append(post("2", title="more ai key", at=20.0))
    assert run(posts, [], keywords=strange).action == "merge"


def test_sync_gets_the_gold_tables(world):
    run, _ = world
    seen = {}
    run([post("1", title="key", at=10.0)], [], sync=lambda df, name: seen.update({name: (df.columns, df.count())}))
    assert set(seen) == {full_run.GOLD_SUBMISSIONS, full_run.GOLD_COMMENTS}
    assert "keyword" in seen[full_run.GOLD_SUBMISSIONS][0] and seen[full_run.GOLD_SUBMISSIONS][1] == 1


def test_previous_rows_survive_incremental_runs(world):
    run, store = world
    rng = random.Random(2)
    posts, kept = [], set()
    for step in range(3):
        posts += [
            post(f"{step}-{i}", title=rng.choice(["key", "x"]), at=float(step * 100 + rng.randint(1, 99)))
            for i in range(8)
        ]
        run(posts, [], posts_per_subreddit=4)
        now = set(rows(store.read(full_run.SUBMISSIONS), "id", "key"))
        assert kept <= now
        kept = now


def test_both_runs_of_the_query_read_stored_inputs(spark, monkeypatch):
    """The index and the comments are made once, not anew wherever a run reads them."""
    given = []
    monkeypatch.setattr(registry, "_RUNS", {})
    monkeypatch.setattr(full_run, "run_once", lambda spark, root, posts, comments, *_: given.append((posts.index, comments)))
    inputs = Inputs(spark, SF_DIR)
    registry.two_runs(inputs)
    for (index, comments), until in zip(given, (FIRST_RUN, None), strict=True):
        assert "Join" not in plan(index) + plan(comments)
        assert rows(index) == rows(inputs.posts(until).index)
        assert rows(comments) == rows(inputs.comments(until))

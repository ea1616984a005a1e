import random

import pytest

from helpers import bronze_comments, comments_frame, plan, post, posts_of, rows, watch_list
from tidewatch import schemas
from tidewatch.operators import comments as ops
from tidewatch.operators.comments import comments_direct, dedup_comments, drop_deleted, union_comments
from tidewatch.operators.match import match_posts
from tidewatch.plans import bronze, silver


def comment(id, post_id="1", body="text", at=100.0, score=1):
    return (post_id, id, body, score, f"/{post_id}/{id}", at)


def row(id, keyword="N/A", body="text", at=100.0, score=1):
    return ("1", id, keyword, body, score, f"/1/{id}", at)


@pytest.mark.parametrize("bounded", [True, False])
def test_direct_repeats_comments_per_submissions_row(spark, bounded):
    watch = watch_list(spark, ["a"], ["x", "y"])
    submissions = match_posts(posts_of(spark, [post("1", title="x y"), post("2", title="x")]), watch, 10, 0)
    comments = comments_frame(spark, [comment("c1"), comment("c2", "2"), comment("c3", "9")])
    direct = comments_direct(submissions, comments, 10 if bounded else None)
    assert rows(direct, "submission_id", "comment_id", "keyword") == [
        ("1", "c1", "N/A"), ("1", "c1", "N/A"), ("2", "c2", "N/A"),
    ]


def test_indirect_reads_newest_posts_whether_they_match_or_not(spark):
    watch = watch_list(spark, ["a"], ["Key", "other"])
    posts = posts_of(spark, [post("1", at=1.0), post("2", at=2.0), post("3", at=3.0)])
    comments = comments_frame(spark, [
        comment("old", "1", "key"), comment("hit", "2", "monKEYs and OTHERS"), comment("late", "3", "key", at=50.0),
        comment("null", "3", None), comment("miss", "3", "none"),
    ])
    found = bronze.comments_indirect(posts, comments, watch, cutoff=50, n=2)
    assert rows(found, "comment_id", "keyword") == [("hit", "Key"), ("hit", "other")]


def test_indirect_does_not_read_post_text(spark, root):
    from helpers import posts_frame
    from tidewatch.operators.newest import Posts

    posts_frame(spark, [post("1")]).write.parquet(f"{root}/p")
    posts = Posts.of(spark.read.parquet(f"{root}/p"))
    watch = watch_list(spark, ["a"], ["k"])
    text = plan(bronze.comments_indirect(posts, comments_frame(spark, [comment("c")]), watch))
    assert "selftext" not in text


def test_dedup_prefers_newest_then_match_then_keyword_then_score(spark):
    data = [
        row("a", "N/A"), row("a", "zeta"), row("a", "beta", score=1), row("a", "beta", score=5),
        row("b", "N/A", at=200.0), row("b", "key", at=100.0),
        row("c", "N/A"), row("c", "N/A"),
    ]
    got = rows(dedup_comments(bronze_comments(spark, data)), "comment_id", "keyword", "score")
    assert got == [("a", "beta", 5), ("b", "N/A", 1), ("c", "N/A", 1)]


def test_dedup_independent_of_order_and_partitions(spark):
    rng = random.Random(1)
    data = [row(f"c{rng.randint(0, 20)}", rng.choice(["N/A", "k", "l"]), at=float(rng.randint(0, 2)),
                score=rng.randint(0, 3)) for _ in range(200)]
    results = set()
    for partitions in (1, 3, 8):
        rng.shuffle(data)
        df = bronze_comments(spark, data).repartition(partitions)
        results.add(tuple(rows(dedup_comments(df))))
    assert len(results) == 1
    assert len(results.pop()) == len({r[1] for r in data})


def test_dedup_limits_copies_before_the_shuffle(spark):
    text = plan(dedup_comments(bronze_comments(spark, [row("a")])))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_deleted_is_case_sensitive_anywhere_and_null_is_dropped(spark):
    data = [row("a", body="so [deleted] it is"), row("b", body="[Deleted]"), row("c", body=None), row("d")]
    assert rows(drop_deleted(bronze_comments(spark, data)), "comment_id") == [("b",), ("d",)]


def test_dedup_runs_before_deletion(spark):
    # The newest copy is removed, so the comment goes, though an older copy has text.
    direct = bronze_comments(spark, [row("a", body="[deleted]", at=2.0)])
    indirect = bronze_comments(spark, [row("a", "k", body="k", at=1.0)])
    assert rows(silver.silver_comments(direct, indirect)) == []


def test_union_keeps_copies(spark):
    df = bronze_comments(spark, [row("a")])
    assert union_comments(df, df).count() == 2


def test_hot_key_dedup(spark):
    data = [row("hot", "N/A")] * 500 + [row("hot", "k")] + [row(f"c{i}") for i in range(50)]
    got = dedup_comments(bronze_comments(spark, data).repartition(8))
    assert got.count() == 51
    assert rows(got.where("comment_id = 'hot'"), "keyword") == [("k",)]


def test_bitmap_keeps_all_wanted_rows_and_few_others(spark):
    comments = spark.range(20_000).selectExpr("cast(id as string) submission_id", "concat('c', id) comment_id", "'b' body")
    comments = comments.unionAll(comments.selectExpr("null", "'none'", "body").limit(1))
    wanted = spark.range(0, 20_000, 50).selectExpr("cast(id as string) submission_id").unionAll(spark.sql("select cast(null as string)"))
    for bits in (64, 1 << 10, 1 << 24):
        passed = ops.among(comments, wanted, "submission_id", bits)
        ids = {int(r["submission_id"]) for r in passed.collect()}
        assert ids >= set(range(0, 20_000, 50)) and passed.columns == comments.columns
        if bits == 1 << 24:  # at most 2 % of the others pass
            assert len(ids) - 400 <= 0.02 * 19_600
    assert ops.among(comments, wanted.where("false"), "submission_id").count() == 0


def test_bitmap_stands_below_the_shuffle(spark):
    raw = comments_frame(spark, [("1", "c1", "body", 1, "/c", 1.0), ("2", "c2", "body", 1, "/c", 1.0)])
    posts = spark.createDataFrame([("a", "k", "t", "1", "/p", 1, "x", 1.0, 0.5)] * 2, schemas.SUBMISSIONS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = ops.comments_direct(posts, raw)
        text = plan(found)
        below = text[text.index("body#") :]
        assert "SortMergeJoin" in text and "shiftrightunsigned" in text and "BroadcastHashJoin" in below
        assert [r["comment_id"] for r in found.collect()] == ["c1", "c1"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

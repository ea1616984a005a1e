"""Registered queries against their SQL, and the counts FIXTURES.md gives."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from checks.inputs import CUTOFF, KEYWORDS, Inputs
from checks.oracle import ORACLE_SQL
from checks.registry import QUERIES
from checks.run import compare, connect
from conftest import SF_DIR
from tidewatch import schemas
from tidewatch.operators import comments as ops
from tidewatch.operators.newest import newest_index
from tidewatch.plans import bronze
from tidewatch.sources.watchlist import WatchList


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    ok, note = compare(spark, con, SF_DIR, name)
    assert ok, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() > 0
    assert df.columns == [
        "submission_id", "comment_id", "keyword", "comment_body", "score", "time_utc", "URL", "time_est",
        "comment_sentiment",
    ]


# The fixture parameters: ten communities, 30 posts for matching, 12 for comments.
COUNTS = {
    "/root/testdata/sf0.001": dict(posts=200, raw=87, newest=100, submissions=142, direct=94, indirect=46, dedup=45, clean=37),
    "/root/testdata/sf0.01": dict(posts=1000, raw=536, newest=300, submissions=528, direct=473, indirect=333, dedup=272, clean=235),
}


@pytest.mark.parametrize("sf_dir", sorted(COUNTS))
def test_fixture_counts(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    watch = WatchList.of(
        spark.createDataFrame([(f"src{n}",) for n in range(10)] + [("nosuch",)], schemas.SUBREDDITS),
        spark.createDataFrame([(k,) for k in KEYWORDS], schemas.KEYWORDS),
    )
    submissions = bronze.submissions_full(i.posts(), watch, CUTOFF, 30)
    direct = ops.comments_direct(submissions, i.comments(), watch.post_bound(30))
    indirect = bronze.comments_indirect(i.posts(), i.comments(), watch, CUTOFF, 12)
    dedup = ops.dedup_comments(ops.union_comments(direct, indirect))
    clean = ops.drop_deleted(dedup)
    got = dict(
        posts=i.index.count(), raw=i.comments().count(), newest=newest_index(i.posts(), watch, 30).count(),
        submissions=submissions.count(), direct=direct.count(), indirect=indirect.count(),
        dedup=dedup.count(), clean=clean.count(),
    )
    assert got == COUNTS[sf_dir]
    if sf_dir.endswith("sf0.01"):
        by_keyword = {r["keyword"]: r["n"] for r in clean.groupBy("keyword").agg(F.count("*").alias("n")).collect()}
        assert by_keyword == {"The": 156, "N/A": 50, "EAU": 21, "tion": 7, "über": 1}

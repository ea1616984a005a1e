import hashlib
from collections import Counter, defaultdict

import brute
import pytest

from tidewatch.llm import exact_dedup


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[brute.fold(t)].append(i)
    return Counter(
        (i, max((x for x in groups[brute.fold(t)] if x is not None), default=None), len(groups[brute.fold(t)]),
         hashlib.sha256(brute.fold(t).encode()).hexdigest())
        for i, t in rows
    )


def found(df):
    rows = df.collect()
    return Counter((r["id"], r["keep_id"], r["n"], r["digest"]) for r in rows), rows


def test_odd_rows(frame, odd):
    got, rows = found(exact_dedup.copy_groups(frame(odd)))
    assert got == expected(odd)
    kept = Counter(r["digest"] for r in rows if r["keep"])
    assert set(kept.values()) == {1} and len(kept) == len({brute.fold(t) for _, t in odd})


def test_corpus(frame, corpus):
    assert found(exact_dedup.copy_groups(frame(corpus)))[0] == expected(corpus)


@pytest.mark.parametrize("largest", [True, False])
@pytest.mark.parametrize("run_rows", [3, 100_000])
def test_a_group_over_many_partitions_and_cut_runs(spark, frame, monkeypatch, largest, run_rows):
    monkeypatch.setattr(exact_dedup, "RUN_ROWS", run_rows)
    rows = [(i, "Hot Text") for i in range(400)] + [(1000 + i, f"text {i % 40}") for i in range(200)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = exact_dedup.copy_groups(frame(rows), largest=largest).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot = [r for r in got if r["id"] < 1000]
    assert {(r["n"], r["keep_id"]) for r in hot} == {(400, 399 if largest else 0)}
    assert [r["id"] for r in hot if r["keep"]] == [399 if largest else 0]
    assert len(got) == 600 and sum(r["keep"] for r in got) == 41
    assert {r["n"] for r in got if r["id"] >= 1000} == {5}


def test_empty_table(frame):
    assert exact_dedup.copy_groups(frame([])).collect() == []
    assert exact_dedup.without_copies(frame([])).collect() == []


def test_without_copies_keeps_one_of_each(frame, odd):
    left = exact_dedup.without_copies(frame(odd))
    assert left.columns == frame(odd).columns
    texts = [brute.fold(r["text"]) for r in left.collect()]
    assert sorted(texts) == sorted({brute.fold(t) for _, t in odd})
    assert {r["doc_id"] for r in left.collect() if brute.fold(r["text"]) == "same text here"} == {5}

import random

import pytest

from helpers import plan, rows
from tidewatch.operators.topk import newest_k


def frame(spark, data):
    return spark.createDataFrame(data, "id string, time_utc double")


def test_small_k_is_one_ordered_take(spark):
    df = frame(spark, [("1", 1.0)])
    assert "TakeOrderedAndProject" in plan(newest_k(df, 5))


@pytest.mark.parametrize("k", [0, 1, 7, 50, 199, 200, 500])
def test_large_route_equals_sorting(spark, k):
    rng = random.Random(k)
    data = [(str(i), rng.choice([None, float(rng.randint(0, 20)), float(rng.randint(0, 20000))])) for i in range(200)]
    want = sorted(data, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))[:k]
    assert rows(newest_k(frame(spark, data), k)) == sorted(want, key=repr)
    if k > 3:
        assert rows(newest_k(frame(spark, data), k, max_take=3)) == sorted(want, key=repr)


def test_every_row_in_one_second(spark):
    data = [(f"{i:03d}", 5.0) for i in range(100)]
    got = newest_k(frame(spark, data), 60, max_take=10)
    assert rows(got, "id") == [(f"{i:03d}",) for i in range(60)]

"""Silver: deduplicated comments, links, readable times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import BASE_URL, full_url
from tidewatch.functions.time import NEW_YORK, local_timestamp, utc_text
from tidewatch.operators.comments import dedup_comments, drop_deleted, union_comments


def _links_and_times(df: DataFrame, permalink: str, base: str, zone: str) -> DataFrame:
    utc = utc_text(F.col("time_utc"))
    return (
        df.withColumn("URL", full_url(F.col(permalink), base))
        .drop(permalink)
        .withColumns({"time_utc": utc, "time_est": local_timestamp(utc, zone)})
    )


def silver_comments(
    direct: DataFrame, indirect: DataFrame, base: str = BASE_URL, zone: str = NEW_YORK
) -> DataFrame:
    clean = drop_deleted(dedup_comments(union_comments(direct, indirect)))
    return _links_and_times(clean, "permalink", base, zone)


def silver_submissions(submissions: DataFrame, base: str = BASE_URL, zone: str = NEW_YORK) -> DataFrame:
    return _links_and_times(submissions, "PermaLink", base, zone)

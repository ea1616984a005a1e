import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampNTZType, TimestampType,
)

from helpers import plan
from tidewatch.functions.sentiment import with_sentiment
from tidewatch.functions.sqltypes import column_types, create_table, sql_type
from tidewatch.functions.text import escape_html, full_url
from tidewatch.functions.time import local_timestamp, utc_text
from tidewatch.plans import silver

EPOCHS = [
    (1735689600.0, "2025-01-01 00:00:00", datetime(2024, 12, 31, 19, 0)),
    (1735689600.9, "2025-01-01 00:00:00", datetime(2024, 12, 31, 19, 0)),
    (1741487400.0, "2025-03-09 02:30:00", datetime(2025, 3, 8, 21, 30)),
    (1741505400.0, "2025-03-09 07:30:00", datetime(2025, 3, 9, 3, 30)),
    (1761976800.0, "2025-11-01 06:00:00", datetime(2025, 11, 1, 2, 0)),
    (1762063200.0, "2025-11-02 06:00:00", datetime(2025, 11, 2, 1, 0)),
    (-1.0, "1969-12-31 23:59:59", datetime(1969, 12, 31, 18, 59, 59)),
    (None, None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo", "Europe/London"])
def test_times_do_not_depend_on_the_session_zone(spark, utc, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    df = spark.createDataFrame([(i, e) for i, (e, _, _) in enumerate(EPOCHS)], "i int, e double")
    text = utc_text(F.col("e"))
    got = df.select("i", text.alias("t"), local_timestamp(text).alias("l")).orderBy("i").collect()
    assert [(r["t"], r["l"]) for r in got] == [(t, local) for _, t, local in EPOCHS]


def test_url_of_null_is_null(spark):
    df = spark.createDataFrame([("/r/x",), (None,)], "p string").select(full_url(F.col("p")).alias("u"))
    assert [r["u"] for r in df.collect()] == ["https://www.reddit.com/r/x", None]


def test_escape_html(spark):
    df = spark.createDataFrame([('<a href="x">&amp;</a>',)], "t string").select(escape_html(F.col("t")))
    assert df.first()[0] == "&lt;a href=&quot;x&quot;&gt;&amp;amp;&lt;/a&gt;"


def test_silver_submissions_columns(spark):
    from tidewatch import schemas

    df = spark.createDataFrame([("a", "k", "t", "1", "/p", 0, "b", 0.0, 0.5)], schemas.SUBMISSIONS)
    out = silver.silver_submissions(df)
    assert out.columns == [
        "subreddit_name", "key", "post_title", "id", "Comments", "Self_text", "time_utc", "upvote_ratio",
        "URL", "time_est",
    ]
    assert dict(out.dtypes)["time_utc"] == "string" and dict(out.dtypes)["time_est"] == "timestamp_ntz"


# --- sentiment

LEXICON = [("good", 0.7), ("bad", -0.7), ("fine", 0.4), ("été", 0.1)]


def score(spark, texts, lexicon, schema="word string, polarity double", **options):
    words = spark.createDataFrame(lexicon, schema)
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    out = with_sentiment(df, ["id"], "text", words, "s", **options)
    assert out.columns == ["id", "text", "s"]
    return [r["s"] for r in out.orderBy("id").collect()]


@pytest.mark.parametrize("inline", [20_000, 0])
def test_mean_of_known_tokens(spark, inline):
    texts = ["Good, GOOD bad!", "nothing", "", None, "good bad", "L'été", "goodness"]
    got = score(spark, texts, LEXICON, max_inline_words=inline)
    assert got == [0.233333, 0.0, 0.0, None, 0.0, 0.1, 0.0]
    assert str(got[4]) == "0.0"


@pytest.mark.parametrize("inline", [20_000, 0])
def test_word_listed_twice_has_the_mean(spark, inline):
    assert score(spark, ["good x good"], [("good", 0.5), ("good", 1.0)], max_inline_words=inline) == [0.75]


@pytest.mark.parametrize("inline", [20_000, 0])
def test_words_are_case_folded_and_null_words_ignored(spark, inline):
    assert score(spark, ["good"], [("Good", 0.5), (None, 1.0)], max_inline_words=inline) == [0.5]


@pytest.mark.parametrize("inline", [20_000, 0])
def test_odd_words_do_no_harm(spark, inline):
    lexicon = [("it's", 0.5), ("back\\slash", 0.1), ("') or true --", 0.2), ("good", 1e-7), ("bad", -1e-5)]
    assert score(spark, ["good bad it's"], lexicon, max_inline_words=inline) == [-5e-06]


MODIFIERS = [
    ("good", 0.5, None, None), ("great", 0.9, False, None), ("bad", -0.6, None, None),
    ("very", 0.2, None, 1.5), ("not", None, True, None),
]
MODIFIER_SCHEMA = "word string, polarity double, is_negation boolean, intensity double"


@pytest.mark.parametrize("inline", [20_000, 0])
def test_negation_and_intensity_scale_the_next_word(spark, inline):
    texts = ["not good", "not x good", "very bad", "very great", "not", "bad not bad"]
    got = score(spark, texts, MODIFIERS, MODIFIER_SCHEMA, max_inline_words=inline)
    assert got == [-0.25, 0.5, -0.35, 0.775, 0.0, -0.15]


@pytest.mark.parametrize("inline", [20_000, 0])
def test_polarities_of_any_scale_are_kept(spark, inline):
    lexicon = [("great", 3.0), ("bad", -2.0)]
    assert score(spark, ["great great bad", "bad"], lexicon, max_inline_words=inline) == [1.333333, -2.0]


def test_both_routes_agree(spark):
    rng = random.Random(5)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(400)]
    lexicon = [(w, rng.randint(-10, 10) / 10, rng.random() < 0.1, rng.choice([None, None, 1.3])) for w in words]
    texts = [" ".join(rng.choice([*words, "none"]) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    one = score(spark, texts, lexicon, MODIFIER_SCHEMA)
    other = score(spark, texts, lexicon, MODIFIER_SCHEMA, max_inline_words=0)
    assert one == other and len(set(one)) > 50


def test_scoring_in_place_has_no_shuffle_and_no_python(spark):
    words = spark.createDataFrame(LEXICON, "word string, polarity double")
    df = spark.range(5).select("id", F.lit("good").alias("text"))
    text = plan(with_sentiment(df, ["id"], "text", words, "s"))
    assert "Exchange" not in text and "Python" not in text


# --- SQL types


def test_sql_types():
    kinds = {
        "i": IntegerType(), "l": LongType(), "s": StringType(), "t": TimestampType(), "n": TimestampNTZType(),
        "d": DateType(), "f": FloatType(), "x": DoubleType(), "b": BooleanType(), "m": DecimalType(10, 2),
        "m2": DecimalType(18, 2), "a": ArrayType(StringType()),
    }
    schema = StructType([StructField(k, v) for k, v in kinds.items()])
    assert dict(column_types(schema)) == {
        "i": "INT", "l": "BIGINT", "s": "NVARCHAR(MAX)", "t": "DATETIME2", "n": "DATETIME2", "d": "DATE",
        "f": "REAL", "x": "FLOAT", "b": "BIT", "m": "DECIMAL(10,2)", "m2": "DECIMAL(18,2)",
        "a": "NVARCHAR(MAX)",
    }
    text = "NVARCHAR(255)"
    assert dict(column_types(schema, compat=True)) == {
        "i": "INT", "l": text, "s": text, "t": "DATETIME", "n": text, "d": text, "f": text, "x": "FLOAT",
        "b": "BIT", "m": text, "m2": text, "a": text,
    }
    assert sql_type(DecimalType(5, 0)) == "DECIMAL(5,0)"


def test_create_table():
    schema = StructType([StructField("key", StringType()), StructField("a]b", IntegerType())])
    assert create_table(schema, "t") == "CREATE TABLE [t] ([key] NVARCHAR(MAX), [a]]b] INT)"

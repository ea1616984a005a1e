"""Fixed table schemas. All columns are nullable."""

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)


def _schema(**columns):
    return StructType([StructField(name, dtype, True) for name, dtype in columns.items()])


# Watch lists: one headerless CSV column each.
SUBREDDITS = _schema(subreddits=StringType())
KEYWORDS = _schema(keywords=StringType())

# Inputs.
POSTS = _schema(
    subreddit_name=StringType(),
    id=StringType(),
    title=StringType(),
    permalink=StringType(),
    num_comments=IntegerType(),
    selftext=StringType(),
    created_utc=DoubleType(),
    upvote_ratio=DoubleType(),
)
RAW_COMMENTS = _schema(
    submission_id=StringType(),
    comment_id=StringType(),
    body=StringType(),
    score=IntegerType(),
    permalink=StringType(),
    created_utc=DoubleType(),
)
LEXICON = _schema(word=StringType(), polarity=DoubleType())
MODIFIER_LEXICON = _schema(
    word=StringType(), polarity=DoubleType(), is_negation=BooleanType(), intensity=DoubleType()
)

# Bronze tables.
SUBMISSIONS = _schema(
    subreddit_name=StringType(),
    key=StringType(),
    post_title=StringType(),
    id=StringType(),
    PermaLink=StringType(),
    Comments=IntegerType(),
    Self_text=StringType(),
    time_utc=DoubleType(),
    upvote_ratio=DoubleType(),
)
COMMENTS = _schema(
    submission_id=StringType(),
    comment_id=StringType(),
    keyword=StringType(),
    comment_body=StringType(),
    score=IntegerType(),
    permalink=StringType(),
    time_utc=DoubleType(),
)

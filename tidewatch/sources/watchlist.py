"""Watch lists: which communities and which keywords to follow."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import schemas
from tidewatch.session import cut
from tidewatch.sizes import Size, measure

# Names of the configuration files that are picked from a folder listing.
CONFIG_NAMES = ("subreddits", "keywords", "email")


# Keywords shorter than this many characters count as short.
SEQUENCE = 5


@dataclass(frozen=True)
class WatchList:
    """The two lists with their measured sizes.

    Lists are multisets: a line given twice counts twice. Measuring costs one
    small job and settles every broadcast decision that follows.
    """

    subreddits: DataFrame
    keywords: DataFrame
    n_subreddits: int
    keyword_size: Size
    short_keywords: int

    @classmethod
    def of(cls, subreddits: DataFrame, keywords: DataFrame) -> WatchList:
        subreddits = subreddits.select(F.col(subreddits.columns[0]).alias("subreddits"))
        keywords = keywords.select(F.col(keywords.columns[0]).alias("keywords"))
        short = keywords.where(F.length(F.lower("keywords")) < SEQUENCE)
        sub_size, size, short_size = measure(subreddits, keywords, short)
        return cls(subreddits, keywords, sub_size.rows, size, short_size.rows)

    def post_bound(self, n: int | None) -> int | None:
        """Most posts a newest-n selection can hold, or None if unbounded."""
        return None if n is None else self.n_subreddits * n


def read_list(spark: SparkSession, path: str, column: str) -> DataFrame:
    """A headerless one-column CSV list under a fixed column name."""
    schema = schemas.StructType([schemas.StructField(column, schemas.StringType(), True)])
    return spark.read.schema(schema).csv(path)


REJECTED = "_line"


def read_list_checked(spark: SparkSession, path: str, column: str) -> tuple[DataFrame, DataFrame]:
    """A headerless one-column CSV list, and the lines that are not one value.

    A line with an unquoted comma has more fields than the list, of which
    `read_list` keeps the first. Here such a line is left out, and comes back
    whole in the second frame as `_line`, with what would have been read.
    """
    schema = schemas.StructType([schemas.StructField(c, schemas.StringType(), True) for c in (column, REJECTED)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED}
    # Saved once, so that both frames come from one reading of the file.
    read = cut(spark.read.schema(schema).options(**options).csv(path))
    fits = F.col(REJECTED).isNull()
    return read.where(fits).select(column), read.where(~fits)


def read_csv_raw(spark: SparkSession, path: str) -> DataFrame:
    """A headerless CSV as strings `_c0`, `_c1`, ..."""
    return spark.read.option("header", False).csv(path)


# Lists as `write_list` stores them: every value quoted, blanks and line breaks
# kept, NULL told from an empty line by a mark.
STORED_LIST = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "nullValue": "\\N",
    "emptyValue": "",
}


def write_list(df: DataFrame, path: str) -> None:
    """Replace the CSV list at `path`, which must not be what `df` reads.

    `read_stored_list` gives back the same lines. Only the text \\N, the mark
    of NULL, cannot be a line.
    """
    df.write.mode("overwrite").options(**STORED_LIST, quoteAll=True).csv(path)


def read_stored_list(spark: SparkSession, path: str, column: str) -> DataFrame:
    """A list written by `write_list`, under a fixed column name."""
    schema = schemas.StructType([schemas.StructField(column, schemas.StringType(), True)])
    return spark.read.schema(schema).options(**STORED_LIST, multiLine=True).csv(path)


def select_config_files(files: DataFrame, names: tuple[str, ...] = CONFIG_NAMES) -> DataFrame:
    """Rows of a listing (name, trashed, ...) that are live config files."""
    return files.where(F.col("name").isin(*names) & ~F.col("trashed"))


def first_recipient(email: DataFrame) -> DataFrame:
    """The recipient: the first address of the list, in the order of its file.

    The list is one small file; of several, the first one read counts.
    """
    column = F.col(email.columns[0])
    placed = email.select(column.alias("recipient"), F.monotonically_increasing_id().alias("place"))
    return placed.where(F.col("recipient").isNotNull()).orderBy("place").limit(1).select("recipient")

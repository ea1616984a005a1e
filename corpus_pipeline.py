"""The corpus pipeline: five stages, each applied to what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes
each as Parquet in the shared folder and reads it back, so a lost executor costs
no finished stage. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import decontaminate, exact_dedup, near_copies, quality, sentencepieces
from tidewatch.session import scratch_dir

# Near copies: five words a shingle, similarity 0.8 or more.
NEAR = near_copies.Likeness(words=5, num=80, den=100)
# A text of which more of the words stand in benchmark windows goes.
MAX_COVERAGE = 0.5
TOKENIZER = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the classifier scores below its threshold go. It is fitted on
    labelled rows of `docs`."""
    return quality.good(docs, quality.trained(docs, _table(spark, sf_dir, "labels")))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.without_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the row with the smallest doc_id stays."""
    return near_copies.one_of_each(docs, NEAR)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark spans are cut out, texts mostly made of them go; `n_chars`
    follows a text that was cut."""
    benchmark = _table(spark, sf_dir, "benchmark")
    return decontaminate.decontaminated(docs, benchmark, max_coverage=MAX_COVERAGE, size_col="n_chars")


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document with its token ids and their number."""
    coded = sentencepieces.with_ids(docs, public_tokenizers.path(TOKENIZER))
    return coded.withColumn("n_tokens", F.size("token_ids").cast("bigint"))


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("tokens", tokens_stage),
]

# A learnt classifier, components and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    folder = scratch_dir(spark, "pipeline")
    docs = _table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        target = f"{folder}/{place}-{name}"
        stage(spark, docs, sf_dir).write.parquet(target)
        docs = spark.read.parquet(target)
    return docs

"""A training-data pipeline of five stages, each applied to all that the stage before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each result as
Parquet in the shared folder and reads it again for the next one.  All but the last return the
columns of documents; the last adds ``shard`` and ``slot``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import decontaminate, jaccard_join, mixing, quality, sharding
from tessella.llm.common import discard, kept, table, workspace, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from all labels, rejects (score below 0.3) go.

    Statistics are taken first, so that no text is shuffled.  Null texts count as empty; without a label that can be
    learned from all stay.  Repeated rows share their fate.
    """
    return quality.kept(docs, quality.learned(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links at 80 % of five-word shingles stays: the one with the smallest doc_id.

    Texts without words link with nothing and stay; of rows that agree in doc_id and text one stays; rows without a
    doc_id stay.
    """
    return jaccard_join.distinct_documents(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of ten words of a benchmark item go.

    Null and empty texts stay; an empty benchmark takes nothing; repeated rows share their fate.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their weights (5, 2, 1, repeating; 150 % of the words in all, no document more than twice).

    A document comes out once, twice or not at all; those without a word never, as they take nothing.  A null source is one
    of the sources.  Rows that agree in doc_id and text tie.  Equal texts have gone before, so each source is its own pattern.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))  # no column can clash
    mixed = mixing.mix_sources(rows, None, mixing.word_count(F.col("row.text")), [F.col("row.doc_id"), F.xxhash64("row.text")], own=F.col("row.source"))
    return mixing.repeated(mixed).select("row.*")


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets one of 24 shards of near equal bytes and a slot in it, as ``shard`` and ``slot``.

    Null texts have the size of empty ones; equal texts (and so the repeats of the mix) meet in one shard unless they fill
    more than one; columns named shard or slot are replaced.
    """
    return sharding.shard(docs, 24, sharding.record_size(F.col("text")), F.col("text"), F.col("doc_id"))


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
    ("sharding", sharding_stage),
]

#: The first stage is a trained classifier, which SQL can't express; tests check run() by stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage has written goes when the next one's result is there."""
    docs = table(spark, sf_dir, "documents")
    with workspace(spark):
        for name, stage in STAGES[:-1]:
            before = docs
            with workspace(spark):
                docs = kept(written(stage(spark, before, sf_dir), "stage-" + name.split()[0]))
            if stage is not STAGES[0][1]:
                discard(before)
        kept(docs)
    return STAGES[-1][1](spark, docs, sf_dir)

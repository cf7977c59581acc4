"""Pipeline over ``documents``: each stage applies one operator to what the one before kept.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and
read again as the next stage's ``docs``. All but the last return the columns they were given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sportlake.llm import decontam, mixing, sharding, toxicity
from sportlake.llm.minhash import deduplicated
from sportlake.llm.tables import read_table, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; the model learns from those labelled and at hand.

    Labels whose ids are held out (crc32 of the id mod 5 is 0) are not learned from. Without
    labels of both kinds nothing goes. Null and empty texts stay.
    """
    labels = read_table(spark, sf_dir, "labels").where(toxicity.remainder("doc_id", 5) != 0)
    return toxicity.clean(docs, toxicity.fit(docs, labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8) stays.

    That is the one with the group's smallest doc_id; a row without id stays only where the group has no
    id. Of rows equal in id and text one stays. Rows without words stay.
    """
    return deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of ``benchmark``, up to 8 % of edits, go.

    Short items count as whole words without edits. Rows are told apart by id and text, so those
    without id and repeated ones go as well. Null and empty texts stay.
    """
    row = "row_number"
    while row in docs.columns:
        row += "_"
    numbered = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    texts = numbered.select(F.col(row).alias("doc_id"), "text")
    found = decontam.contaminated(texts, read_table(spark, sf_dir, "benchmark"), percent=8)
    gone = found.select(F.col("doc_id").alias(row)).distinct()
    return numbered.join(gone, row, "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as a mix of their sources by weights 5, 2, 1 takes them.

    Rows without source are a source of their own, the last one. Rows without words count no
    words and come once. Repeated rows are taken each for itself.
    """
    return mixing.applied(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ``shard`` (0 to 39) and ``slot`` in it.

    Every row gets one, those without id or text and repeated ones too; counts are at most one apart.
    """
    return sharding.assigned(docs, shards=40)


#: Name and function of each stage.
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

#: Hashes, a trained classifier and edit distances are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

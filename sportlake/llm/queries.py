"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from sportlake.llm import decontam, imatch, language, mixing, neighbours, pii, runs, sharding, tokens, toxicity
from sportlake.llm.lines import near_lines
from sportlake.llm.minhash import near_duplicates
from sportlake.llm.oracles import ORACLES  # noqa: F401
from sportlake.llm.suffixes import repeated_spans
from sportlake.llm.tables import read_table, stored

#: Key of the registered query; a deployment passes its own secret.
PII_KEY = b"registered query"


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of ``documents`` with pseudonyms for personal numbers, dates and addresses."""
    return pii.pseudonymised(read_table(spark, sf_dir, "documents"), PII_KEY)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 39 of ``documents`` with even row counts and linked texts together."""
    found = sharding.sharded(read_table(spark, sf_dir, "documents"), shards=40)
    law = F.lit("rows").alias("law")
    grown = F.lit(None).cast("int").alias("grown_shard")
    return found.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of ``documents`` on two-word shingles."""
    return near_duplicates(read_table(spark, sf_dir, "documents"), length=2, percent=80)


def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings of 400 bytes that occur more than once in the texts of ``documents``, removed.

    ``n_shared`` tells shorter passages, from 250 bytes on, of which nothing is removed.
    """
    return repeated_spans(read_table(spark, sf_dir, "documents"), length=400).drop("spans")


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of ``documents`` that repeat an earlier line up to one edit."""
    found = near_lines(read_table(spark, sf_dir, "documents"))
    removed = F.array_join("removed", ",").alias("removed")
    return found.select("doc_id", "n_lines", "n_removed", removed)


def op4_lines_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of ``documents`` that repeat an earlier line up to three edits."""
    found = near_lines(read_table(spark, sf_dir, "documents"), edits=3)
    return found.select("doc_id", "n_lines", "n_removed", F.array_join("removed", ",").alias("removed"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of ``benchmark`` that occur in ``documents``, with up to 8 % of edits."""
    docs = read_table(spark, sf_dir, "documents")
    return decontam.contaminated(docs, read_table(spark, sf_dir, "benchmark"), percent=8)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of ``documents`` that a mix of their sources by weights 5, 2, 1 takes."""
    found = mixing.mixed(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """Learned from the labels whose ids are not held out (crc32 of the id mod 5 is not 0)."""
    labels = read_table(spark, sf_dir, "labels").where(toxicity.remainder("doc_id", 5) != 0)
    return toxicity.fit(read_table(spark, sf_dir, "documents"), labels)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text of ``documents``."""
    scored = toxicity.scored(read_table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))
    return scored.select(
        "doc_id",
        (toxicity.remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op9_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of ``documents``, and their likeness to edited and to other texts."""
    return imatch.compared(read_table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text of ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    network = language.fit(docs.where(toxicity.remainder("doc_id", 4) != 2))
    found = language.identified(docs, network)
    held_out = (toxicity.remainder("doc_id", 4) == 2).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score")


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of the words of every text of ``documents``, a tenth of them edited."""
    found = runs.periodic_runs(runs.with_planted_runs(read_table(spark, sf_dir, "documents")))
    found = found.withColumn("best", runs.strongest("runs"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(runs.listed("runs"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the tokens that two tokenizers make of every text of ``documents``."""
    found = tokens.aligned(read_table(spark, sf_dir, "documents"))
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    found = stored(found.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "pairs", "links"), "tokens")
    scored = found.drop("pairs", "links").join(tokens.scored(found), "row", "left")
    return scored.select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        *[F.coalesce(name, F.lit(0)).alias(name) for name in ("n_best", "count_sum")],
        "groups_sha256",
    )


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows of ``embeddings`` to each row whose id is divisible by 100."""
    return neighbours.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_sharding": op2_sharding,
    "op3_minhash": op3_minhash,
    "op4_lines": op4_lines,
    "op4_lines_edits": op4_lines_edits,
    "op5_decontamination": op5_decontamination,
    "op6_mixing": op6_mixing,
    "op7_toxicity": op7_toxicity,
    "op8_suffix_array": op8_suffix_array,
    "op9_imatch": op9_imatch,
    "op10_language": op10_language,
    "op11_runs": op11_runs,
    "op12_tokens": op12_tokens,
    "op13_neighbours": op13_neighbours,
}

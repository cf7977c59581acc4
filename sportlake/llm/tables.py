"""Tables on the shared folder, narrow row keys and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sportlake.session import scratch_folder


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame written below ``spark.checkpoint.dir`` and read back, which cuts its lineage.

    Lost executors cost a re-read of the files only.
    """
    folder = scratch_folder(frame.sparkSession, purpose)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(edges: DataFrame) -> DataFrame:
    """Smallest node that each node of ``edges`` (a, b: long) reaches: columns ``node, root``.

    Alternates large-star and small-star steps, so rounds grow with the logarithm of a
    component's size. A node with very many neighbours sends one partial minimum per task.
    Null ends and loops are left out; an empty table gives an empty result.
    """
    links = (
        edges.where("a != b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    links = stored(links, "links")
    before = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m"))
        lowest = lowest.select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        large = large.distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lowest, "u")
            .where("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(lowest.select("u", F.col("m").alias("v")))
            .distinct()
        )
        links = stored(small, "links")
        after = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if after == before:
            break
        before = after
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )

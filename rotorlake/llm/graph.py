"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rotorlake.session import shared_folder


def kept(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read again, so that plans stay short and lost executors cost little."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for all nodes of links (a, b: long) but the roots; the root is the smallest node reached.

    Large-star and small-star steps alternate until nothing changes. Every step sends each edge once, and nodes with
    many edges meet only minima.
    """
    edges = kept(links.where("a <> b").select("a", "b").distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # Each edge now points from a larger node to a smaller one.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        edges = kept(small.distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now

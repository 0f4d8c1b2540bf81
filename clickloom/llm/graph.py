"""Connected components of a graph whose edges lie in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.storage import stored, written


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) of every node of the edges ``a, b`` of two longs.

    Alternates two steps until nothing changes: larger neighbours of a node move to its smallest
    neighbour, then the node and its smaller neighbours do. No step gathers a node's neighbours;
    minima are combined before the shuffle, and a node of very many edges is a skewed join key,
    which the adaptive plan splits. Rounds grow with the logarithm of the longest path.
    """
    now = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct()
    )
    before = None
    while True:
        both = now.unionByName(now.select(F.col("low").alias("high"), F.col("high").alias("low")))
        least = stored(both.groupBy("high").agg(F.min("low").alias("least"))).select(
            "high", F.least("high", "least").alias("least")
        )
        larger = both.where("low > high").join(least, "high").select(F.col("low").alias("high"), F.col("least").alias("low"))
        larger = stored(larger.where("high <> low").distinct())
        least = stored(larger.groupBy("high").agg(F.min("low").alias("least")))
        joined = larger.join(least, "high")
        smaller = joined.select(F.col("low").alias("high"), F.col("least").alias("low")).unionByName(
            least.select("high", F.col("least").alias("low"))
        )
        now = written(smaller.where("high <> low").distinct())  # so that sizes are known, not multiplied in each round
        after = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    return now.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(
        now.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    )

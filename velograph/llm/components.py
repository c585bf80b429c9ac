"""Connected components of links between long ids, by alternating stars; only counts reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velograph.llm.shared import settle


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's larger (large) or smaller neighbours are linked to the least of its neighbourhood. The least ones are written out
    first: a plain side of the join, so that AQE can split the hub of a large component."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        least = settle(least, "cc-least")
        out = both.filter("v > u").join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = settle(edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m"), "cc-least")
        joined = edges.join(least, F.col("u") == F.col("c"))
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select(F.col("c").alias("u"), F.col("m").alias("v")))
    return out.filter("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) of long ids to (node, root), root the least id of the component; nodes that are roots are left out."""
    current = settle(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "cc")
    mark = lambda df: df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = mark(current)
    while before[0]:
        current = settle(_stars(settle(_stars(current, True), "cc"), False), "cc")
        after = mark(current)
        if after == before:
            break
        before = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))

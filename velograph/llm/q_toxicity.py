"""op5: a toxicity score for every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velograph.llm.shared import read_table
from velograph.llm.toxicity import fit, is_held_out, score


def op5_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, read_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op5_noisy_channel_toxicity": op5_noisy_channel_toxicity}
ORACLES: dict[str, str] = {}

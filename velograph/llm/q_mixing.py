"""op1: the documents as a stream of blocks at bisected source weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velograph.llm.mixing import mix, oracle, token_count
from velograph.llm.shared import read_table, settle

#: Production parameters.
PARAMETERS = {"block_tokens": 1_000_000, "budget_share": 1.0, "entropy_share": 0.98, "max_repeats": 4.0, "seed": 7}


def op1_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = settle(read_table(spark, sf_dir, "documents").select("doc_id", "source", token_count().alias("words")), "mix-sizes")
    return mix(docs, tokens=F.col("words"), **PARAMETERS).drop("words")


QUERIES = {"op1_temperature_mixing": op1_temperature_mixing}
ORACLES = {"op1_temperature_mixing": oracle(**PARAMETERS)}

"""op3: long repeats removed from every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from velograph.llm.long_repeats import cut_digests
from velograph.llm.shared import read_table


def op3_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_digests(read_table(spark, sf_dir, "documents")).drop("spans")


QUERIES = {"op3_run_length_index": op3_run_length_index}
ORACLES: dict[str, str] = {}

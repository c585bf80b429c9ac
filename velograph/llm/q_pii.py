"""op2: personal data and disclosing terms of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velograph.llm.pii import REMOVE, find
from velograph.llm.shared import read_table


def op2_information_theoretic_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(read_table(spark, sf_dir, "documents"))
    terms = F.array_join(F.transform("terms", lambda t: F.concat_ws(":", F.lit("term"), t["start"].cast("string"), t["end"].cast("string"))), ",")
    spans = F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), F.when(terms != "", terms))
    n_over = lambda low, high: F.size(F.filter("terms", lambda t: (t["disclosure"] >= low) & (t["disclosure"] < high))).cast("long")
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), spans.alias("spans"), n_over(0.0, REMOVE).alias("n_generalised"), n_over(REMOVE, 2.0).alias("n_removed_terms"))


QUERIES = {"op2_information_theoretic_pii": op2_information_theoretic_pii}
ORACLES: dict[str, str] = {}

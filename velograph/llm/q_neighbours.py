"""op10: the five nearest vectors of every fiftieth."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velograph.llm.permutation_index import PermutationIndex
from velograph.llm.shared import read_table


def op10_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = PermutationIndex(read_table(spark, sf_dir, "embeddings"))
    return index.search(F.col("vec_id") % 50 == 0, k=5)


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, r.vec_id, list_inner_product(q.e, r.e) / (sqrt(list_inner_product(q.e, q.e)) * sqrt(list_inner_product(r.e, r.e))) AS score
      FROM v q JOIN v r ON r.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
k AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 5
"""

QUERIES = {"op10_permutation_index": op10_permutation_index}
ORACLES = {"op10_permutation_index": SQL}

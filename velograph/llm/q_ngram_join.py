"""op9: shingle counts and components of near duplicates for every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from velograph.llm.ngram_join import classes
from velograph.llm.shared import read_table


def op9_multi_order_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
                                          WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS t FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM g x JOIN g y ON x.t = y.t AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a AS doc_id, a AS m FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.m),
c AS (SELECT doc_id, min(m) AS m FROM r GROUP BY doc_id)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(c.m, w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.doc_id = w.doc_id
"""

QUERIES = {"op9_multi_order_ngram_join": op9_multi_order_ngram_join}
ORACLES = {"op9_multi_order_ngram_join": SQL}

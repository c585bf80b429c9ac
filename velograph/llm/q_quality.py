"""op4: quality figures and the cascade's verdict for every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from velograph.llm.quality import cascade, measure, plan_cascade
from velograph.llm.shared import read_table

OUT = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return cascade(measure(docs), plan_cascade(docs)).select(*OUT)


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM hit) GROUP BY doc_id),
m AS (SELECT w.doc_id, w.text, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines, len(list_filter(ws, lambda w: NOT regexp_matches(w, '\p{L}'))) AS n_bare,
             length(text) - length(regexp_replace(text, '[.!?]', '', 'g')) AS n_marks,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_bare > 3 * n_words OR 10 * n_marks > 6 * n_words OR 100 * n_symbols > 10 * word_chars
            OR word_chars > 12 * n_words OR 2 * word_chars < 5 * n_words OR (n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines)) AS kept
FROM b
"""

QUERIES = {"op4_quality_cascade": op4_quality_cascade}
ORACLES = {"op4_quality_cascade": SQL}

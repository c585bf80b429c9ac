"""op6: repeated lines, and repeated sentences within other lines, removed from every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from velograph.llm.shared import read_table
from velograph.llm.unit_dedup import dedup_units


def op6_line_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_units(read_table(spark, sf_dir, "documents"), digests=True)


_PLAIN = r"translate(trim(regexp_replace({}, '[\x20\x09-\x0D]+', ' ', 'g'), ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_AHEAD = "coalesce(sum({}) OVER (PARTITION BY {} ORDER BY {} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT"
#: Sentences are marked off by the character 1, which no document holds.
SQL = rf"""
WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS no FROM t),
n AS (SELECT *, {_PLAIN.format("line")} AS plain, {_AHEAD.format("length(line) + 1", "doc_id", "no")} AS pos,
      string_split(regexp_replace(line, '([.!?][\x20\x09-\x0D]+)', '\1' || chr(1), 'g'), chr(1)) AS parts FROM l),
p AS (SELECT doc_id, no, pos, unnest(parts) AS part, generate_subscripts(parts, 1) AS k FROM n),
q AS (SELECT *, {_PLAIN.format("part")} AS plain, pos + {_AHEAD.format("length(part)", "doc_id, no", "k")} AS start FROM p),
w AS (SELECT doc_id, no, count(CASE WHEN plain <> '' THEN 1 END) AS worded FROM q GROUP BY 1, 2),
u AS (SELECT doc_id, no, 0 AS k, plain FROM n WHERE plain <> ''
      UNION ALL SELECT doc_id, no, k, plain FROM q JOIN w USING (doc_id, no) WHERE worded > 1 AND plain <> '' AND len(string_split(plain, ' ')) >= 8),
r AS (SELECT doc_id, no, k, len(string_split(plain, ' ')) AS words, row_number() OVER (PARTITION BY plain ORDER BY doc_id, no, k) > 1 AS gone, count(*) OVER (PARTITION BY plain) > 1 AS again FROM u),
g AS (SELECT n.doc_id, n.no, n.line, n.pos, coalesce(r.gone, false) AS gone, coalesce(r.again, false) AS again, coalesce(r.words, 0) AS words
      FROM n LEFT JOIN r ON r.doc_id = n.doc_id AND r.no = n.no AND r.k = 0),
s AS (SELECT q.doc_id, q.no, string_agg(CASE WHEN NOT coalesce(r.gone, false) THEN part END, '' ORDER BY q.k) AS rest, count(CASE WHEN r.gone THEN 1 END) AS cut,
      string_agg(CASE WHEN r.gone THEN start || ':' || (start + length(part)) END, ',' ORDER BY q.k) AS spans, count(CASE WHEN r.again THEN 1 END) AS n_again, sum(CASE WHEN r.again THEN r.words ELSE 0 END) AS words_again
      FROM q LEFT JOIN r ON r.doc_id = q.doc_id AND r.no = q.no AND r.k = q.k GROUP BY 1, 2),
x AS (SELECT g.doc_id, g.no, CASE WHEN NOT gone THEN coalesce(rest, '') END AS kept, CASE WHEN gone THEN 1 ELSE cut END AS n_removed,
      CASE WHEN gone THEN pos || ':' || (pos + length(line)) ELSE spans END AS spans, CASE WHEN again THEN 1 ELSE n_again END AS n_repeated, CASE WHEN again THEN words ELSE words_again END AS n_repeat_words
      FROM g JOIN s ON s.doc_id = g.doc_id AND s.no = g.no),
lv AS (SELECT doc_id, no, leaves, {_AHEAD.format("leaves", "doc_id", "no")} AS leaf, line_again FROM (SELECT doc_id, no, greatest(1, count(CASE WHEN k > 0 THEN 1 END)) AS leaves, bool_or(k = 0 AND again) AS line_again FROM r GROUP BY 1, 2)),
o AS (SELECT r.doc_id, leaf + row_number() OVER (PARTITION BY r.doc_id, r.no ORDER BY k) - CASE WHEN k = 0 THEN 1 ELSE 2 END AS leaf, CASE WHEN k = 0 THEN leaves ELSE 1 END AS leaves, words, again AND (k = 0 OR NOT line_again) AS outer_again
      FROM r JOIN lv ON lv.doc_id = r.doc_id AND lv.no = r.no),
f AS (SELECT *, CASE WHEN lag(leaf + leaves) OVER (PARTITION BY doc_id ORDER BY leaf) = leaf THEN 0 ELSE 1 END AS fresh FROM o WHERE outer_again),
rn AS (SELECT doc_id, run, sum(words) AS words FROM (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY leaf) AS run FROM f) GROUP BY 1, 2),
pw AS (SELECT doc_id, count(*) AS n_passages, sum(words) AS n_passage_words FROM rn WHERE words >= 20 GROUP BY 1)
SELECT x.doc_id, sum(n_removed)::BIGINT AS n_removed, coalesce(string_agg(spans, ',' ORDER BY no), '') AS spans, sum(n_repeated)::BIGINT AS n_repeated, sum(n_repeat_words)::BIGINT AS n_repeat_words,
       coalesce(max(n_passages), 0)::BIGINT AS n_passages, coalesce(max(n_passage_words), 0)::BIGINT AS n_passage_words,
       length(coalesce(string_agg(kept, chr(10) ORDER BY no), ''))::BIGINT AS kept_chars, sha256(coalesce(string_agg(kept, chr(10) ORDER BY no), '')) AS kept_sha256
FROM x LEFT JOIN pw ON pw.doc_id = x.doc_id GROUP BY x.doc_id
"""

QUERIES = {"op6_line_hashing": op6_line_hashing}
ORACLES = {"op6_line_hashing": SQL}

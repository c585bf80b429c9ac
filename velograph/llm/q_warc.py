"""op7: pages written as WARC records and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from velograph.llm.shared import read_table
from velograph.llm.warc import read_warc, write_warc


def op7_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_warc(read_table(spark, sf_dir, "pages"))
    return read_warc(spark, manifest, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS keeper FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(((('0x' || hex[(5 * (i // 4) + 1):(5 * (i // 4) + 5)])::BIGINT >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT]), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM keeper THEN NULL ELSE keeper END AS refers_to
FROM g
"""

QUERIES = {"op7_warc_round_trip": op7_warc_round_trip}
ORACLES = {"op7_warc_round_trip": SQL}

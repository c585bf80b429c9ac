"""The queries op1 to op10 and their SQL, as __spark_entry__.py registers them."""

from __future__ import annotations

from velograph.llm import q_bpe, q_long_repeats, q_mixing, q_neighbours, q_ngram_join, q_pii, q_quality, q_toxicity, q_unit_dedup, q_warc

MODULES = (q_mixing, q_pii, q_long_repeats, q_quality, q_toxicity, q_unit_dedup, q_warc, q_bpe, q_ngram_join, q_neighbours)


def queries() -> dict:
    return {name: run for module in MODULES for name, run in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}

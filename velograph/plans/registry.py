"""The registered queries of the engine and their SQL."""

from __future__ import annotations

from velograph.plans import q_layers, q_points, q_profiles

MODULES = (q_profiles, q_points, q_layers)


def queries() -> dict:
    return {name: run for m in MODULES for name, run in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}

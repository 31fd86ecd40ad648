"""Driver queries: each binds library operators to the test tables and has
an equivalent DuckDB SQL oracle (or none, for non-SQL operators)."""

from __future__ import annotations

import importlib

_MODULES = [
    "fieldbook.plans.catalog_queries",
    "fieldbook.plans.ingest_queries",
    "fieldbook.plans.etl_queries",
    "fieldbook.plans.stream_queries",
]


def registry() -> dict[str, tuple]:
    """name -> (callable(spark, sf_dir) -> DataFrame, oracle SQL or None)."""
    out: dict[str, tuple] = {}
    for m in _MODULES:
        out.update(importlib.import_module(m).QUERIES)
    return out

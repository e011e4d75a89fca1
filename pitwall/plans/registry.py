"""Registry of named queries: id -> (Spark callable, oracle SQL or None).

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the whole input tables.  ``__spark_entry__`` exposes the registry.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query id {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


def load_all() -> None:
    # Importing the modules registers their queries.
    from pitwall.plans import q_scalars, q_relational, q_jobs, q_ml, q_io  # noqa: F401,I001

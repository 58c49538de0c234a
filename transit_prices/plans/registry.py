"""All registered queries, gathered from the plan modules."""

from __future__ import annotations


def all_queries() -> dict:
    from . import queries, queries_ml

    return dict(queries.QUERIES) | queries_ml.QUERIES

"""Registry of named queries over the warehouse tables and their SQL oracles."""

from __future__ import annotations

from pinwheel.plans import geometry_queries, popularity_queries


def all_queries():
    return {**popularity_queries.QUERIES, **geometry_queries.QUERIES}


def all_oracles():
    return {**popularity_queries.ORACLES, **geometry_queries.ORACLES}

"""All registered queries, imported from their modules."""

from __future__ import annotations

from windowlens.plans import queries


def all_queries():
    return dict(queries.REGISTRY)

"""Registered queries: every operator on the driver tables, with its SQL twin."""

from __future__ import annotations

from driver_queries import community, gridded, indices, loaders, matching, profiles, products, quality, taxa

MODULES = (indices, quality, taxa, matching, profiles, gridded, community, products, loaders)


def all_queries() -> dict:
    return {name: fn for m in MODULES for name, fn in m.QUERIES.items()}


def all_sql() -> dict:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}

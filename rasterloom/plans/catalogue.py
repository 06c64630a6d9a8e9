"""All registered queries on the reference-shaped views."""

from __future__ import annotations

from rasterloom.plans import damage_queries, geometry_queries, pixel_queries, raster_queries, semantic_queries, shard_queries, table_queries, text_queries, tiling_queries

_MODULES = (text_queries, table_queries, geometry_queries, tiling_queries, pixel_queries, semantic_queries, damage_queries, shard_queries, raster_queries)


def queries():
    return {name: build for m in _MODULES for name, build in m.REGISTRY.queries().items()}


def oracle_sql():
    return {name: sql for m in _MODULES for name, sql in m.REGISTRY.oracle_sql().items()}

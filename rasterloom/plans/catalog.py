"""All queries of the raster engine."""

from __future__ import annotations

from rasterloom.plans import rasters, segments, statistics, tiles
from rasterloom.plans.registry import Query

MODULES = (statistics, rasters, segments, tiles)


def queries() -> dict[str, Query]:
    return {name: q for m in MODULES for name, q in m.catalog.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {name: s for m in MODULES for name, s in m.catalog.sql.items()}

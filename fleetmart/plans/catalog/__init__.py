"""Queries over the driver's tables."""

from fleetmart.plans.catalog.base import QUERIES, Query


def all_queries() -> dict[str, Query]:
    from fleetmart.plans.catalog import behaviours, joins, pipelines, quality, tables, timeline, vault  # noqa: F401

    return QUERIES

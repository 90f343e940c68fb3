"""Every operator as a query on the benchmark tables, each with the SQL it must agree with."""

from civiclake.queries import (  # noqa: F401
    aggregates,
    edges,
    joins,
    landed,
    metadata,
    parcels,
    quality,
    scalars,
    spatial,
    stores,
    windows,
)
from civiclake.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""Every operator as a query over the benchmark tables, each with the SQL it must agree with."""

from __future__ import annotations

from trafficloom.queries.registry import QUERIES
from trafficloom.queries import (  # noqa: F401 - importing registers the queries
    analyses,
    catalogue,
    cleaning,
    geometry,
    joins,
    landed,
    reading,
    tiles,
    viewer,
)

__all__ = ["QUERIES"]

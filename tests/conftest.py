import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from trafficloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    yield session
    session.stop()


@pytest.fixture()
def layer(spark):
    """Build a landed layer from (schema, rows); a geometry is given as kind and points."""
    from trafficloom.model import ORDINAL

    def shape(g, srid):
        if g is None:
            return None
        kind, points = g
        if kind == "Point":
            return (kind, srid, [[tuple(points)]])
        if kind == "LineString":
            return (kind, srid, [[tuple(p) for p in points]])
        return (kind, srid, [[tuple(p) for p in part] for part in points])

    def make(schema, rows, srid=4326, geometry=True, first=0):
        if geometry:
            schema += (
                ", geometry struct<kind:string,srid:int,"
                "parts:array<array<struct<x:double,y:double>>>>"
            )
            rows = [(*r[:-1], shape(r[-1], srid)) for r in rows]
        schema += f", {ORDINAL} int"
        rows = [(*r, first + i) for i, r in enumerate(rows)]
        return spark.createDataFrame(rows, schema)

    return make


def line(x, y, dx=100.0, dy=0.0):
    return ("LineString", [(float(x), float(y)), (float(x + dx), float(y + dy))])


def dot(x, y):
    return ("Point", (float(x), float(y)))

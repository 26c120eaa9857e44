"""Reading of landed texts, over texts built from the benchmark tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from trafficloom.queries import standins as s
from trafficloom.queries.registry import query, table
from trafficloom.sources import collections, readers

# ------------------------------------------------------------------ a collection in pieces

# What a read at the separator gives: the head of the file, a piece per feature, the last of which
# ends the document. A file for each of 25 sources; texts hold what could be taken for structure.
START = '{"type": "Feature"'
HEAD = '{"type": "FeatureCollection", "features": ['
FEATURE = """', "id": "' || cast(o_orderkey as string) || '", "properties": {"nr": '
    || cast(o_custkey as string) || '.5, "text": "' || o_orderpriority || ' } ] , { ", "none": null}, '
    || '"geometry": {"type": "Point", "coordinates": [' || cast(o_custkey % 360 - 180 as string) || '.25, '
    || cast(o_orderkey % 90 as string) || ', 7]}},'"""
LAST = """', "properties": {"nr": ' || cast(n_nationkey as string)
    || '}, "geometry": {"type": "LineString", "coordinates": [[1, 2], [3, 4]]}}], "links": []}'"""


@query("""
    select 'n' || cast(o_custkey % 25 as varchar) as source, cast(o_orderkey as varchar) as id,
        cast(o_custkey as varchar) || '.5' as nr, o_orderpriority || ' } ] , { ' as text, 'Point' as kind,
        (o_custkey % 360 - 180) + case when o_custkey % 360 < 180 then -0.25 else 0.25 end as x,
        cast(o_orderkey % 90 as double) as y, 1 as vertices
    from orders
    union all select 'n' || cast(n_nationkey as varchar), null, cast(n_nationkey as varchar), null, 'LineString',
        1.0::double, 2.0::double, 2 from nation
""")
def collection_in_pieces(spark, folder):
    """Every piece of a large document parses by itself; no file without end."""
    orders, nations = table(spark, folder, "orders"), table(spark, folder, "nation")
    file, none = "'n' || cast({} as string) as file", "cast({} as bigint) as block"
    head = nations.selectExpr(file.format("n_nationkey"), none.format("0"), none.format("0") + "_", f"'{HEAD}' as value")
    rows = orders.selectExpr(file.format("o_custkey % 25"), none.format("1"), none.format("o_orderkey") + "_", f"{FEATURE} as value")
    last = nations.selectExpr(file.format("n_nationkey"), none.format("2"), none.format("0") + "_", f"{LAST} as value")
    pieces = head.unionByName(rows).unionByName(last).withColumnRenamed("block_", "row")
    found = readers.piece_features(pieces, START)
    shape = readers.geojson_geometry(F.col("f.geometry"), 4326)
    found = found.select("f", "_ord", shape.alias("g"))
    first = F.col("g.parts")[0][0]
    # Files that are not whole come as one row each, so any would show as a difference.
    broken = collections.unclosed(pieces).select(F.lit(None).cast("string"), F.lit("broken"), *[F.lit(None)] * 6)
    good = found.select(
        F.regexp_replace("_ord.file", "^n0*(?=[0-9])", "n").alias("source"),
        F.col("f.id").alias("id"),
        F.col("f.properties")["nr"].alias("nr"),
        F.col("f.properties")["text"].alias("text"),
        F.col("g.kind").alias("kind"),
        first["x"].alias("x"),
        first["y"].alias("y"),
        F.size(F.flatten("g.parts")).alias("vertices"),
    )
    return good.union(broken)


# ------------------------------------------------------------------------ a chain of pages

CHAIN = {
    "folder": "'n' || cast(o_custkey % 300 as string)",
    "page": "cast(o_orderkey as string)",
    "place": "(o_orderkey * 7919) % 100003",
}


@query(f"""
    select folder, page, row_number() over (partition by folder order by place, page) - 1 as at
    from (select {s.columns_sql(CHAIN)} from orders)
""")
def pages_in_link_order(spark, folder):
    """Pages know the one after them only; their names say nothing about the order."""
    pages = s.derive(table(spark, folder, "orders"), CHAIN)
    after = "lead(page) over (partition by folder order by place, page)"
    return collections.page_order(pages.selectExpr("folder", "page", f"{after} as next")).select("folder", "page", "at")

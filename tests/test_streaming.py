"""Mapping and clean-up are stateless, so they hold for a streaming input unchanged."""

from pyspark.sql import functions as F

from trafficloom.catalogue_data import LEVEL_OF
from trafficloom.functions import geometry as geo
from trafficloom.functions import roads
from trafficloom.operators.canonical import Spec, to_canonical


def test_mapping_on_a_stream(spark, tmp_path):
    def mapped(raw):
        rows = raw.withColumn("geometry", geo.point(F.col("x"), F.col("y"), 25832))
        spec = Spec({"kfz": "dtv_kfz"}, metric="DTV", state="BY", source="by", license="l",
                    year=2021, levels=LEVEL_OF, road_class_from="k", srid=25832,
                    road_class_map=roads.class_by_code({"A": "A"}, "L"))
        return to_canonical(rows, spec)

    folder = str(tmp_path / "in")
    batch = spark.range(100).selectExpr(
        "cast(id as string) || '.5' as kfz", "case when id % 2 = 0 then 'A' end as k",
        "550000D + id as x", "5800000D as y")
    batch.write.parquet(folder)
    stream = mapped(spark.readStream.schema(batch.schema).parquet(folder))
    query = (stream.writeStream.format("parquet")
             .option("checkpointLocation", str(tmp_path / "ck"))
             .trigger(availableNow=True).start(str(tmp_path / "out")))
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.exceptAll(mapped(batch)).count() == 0 and got.count() == 100

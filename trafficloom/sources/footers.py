"""Statistics out of Parquet footers: counts, least and largest values without reading a row."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

NATIVE = "spark.sql.sources.useV1SourceList"
PUSHED = "spark.sql.parquet.aggregatePushdown"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def read(spark: SparkSession, *paths: str) -> DataFrame | None:
    """A Parquet table whose global aggregates, and those by partition columns, of counts and of
    least and largest numbers come from the footers.

    Only Spark's second generation of sources takes aggregates, and Parquet is not among them by
    default: it is for this one table, whatever the session says. A file without rows has no such
    statistics, nor has a column that holds no value in a whole file, or one that is not a number;
    asking for them is an error. Meant for tables with rows, for the columns that the contract
    requires and the flat envelope.

    Footers list the leaves of nested columns, Spark counts columns: behind a nested one it would
    take another column's statistics. None for such a table: it has to be aggregated.
    """
    spark.conf.set(PUSHED, "true")  # looked at when the query is planned, so it has to stay
    old = [n for n in spark.conf.get(NATIVE).split(",") if n.strip() and n.strip() != "parquet"]
    with _setting(spark, NATIVE, ",".join(old)):
        table = spark.read.parquet(*paths)
    return table if fit(table) else None


def fit(table: DataFrame) -> bool:
    """Do all nested columns stand behind the others? Columns of the folders come last anyway."""
    nested = [isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) for f in table.schema]
    folders = len(table._jdf.queryExecution().analyzed().collectLeaves().head().table().partitioning())  # noqa: SLF001
    own = nested[: len(nested) - folders]
    return own == sorted(own)

"""Registration of queries."""

from __future__ import annotations

import textwrap
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


class Query(NamedTuple):
    run: Run
    sql: str


QUERIES: dict[str, Query] = {}


def query(sql: str) -> Callable[[Run], Run]:
    """Register the decorated function under its own name together with its SQL."""

    def keep(run: Run) -> Run:
        QUERIES[run.__name__] = Query(run, textwrap.dedent(sql).strip())
        return run

    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")

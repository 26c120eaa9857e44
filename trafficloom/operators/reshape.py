"""Wide count tables: repeated blocks, direction and year columns, period pairs."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficloom.functions import roads
from trafficloom.functions import values as v
from trafficloom.operators.keyed import last_per_key

# --- fixed values -----------------------------------------------------------------------
COUNT_BLOCKS = (1, 2, 3, 4)
STATION_KEY = ("ID", "NAME", "BREITENGRAD", "LAENGENGRAD")
FORWARD = r"^K_(\d{4})_24H$"
REVERSE = r"^R_K_(\d{4})"
# ----------------------------------------------------------------------------------------


def both_directions(forward: Column, reverse: Column) -> Column:
    """Cross-section count: both directions added, a missing one as zero."""
    return F.coalesce(forward, F.lit(0.0)) + F.coalesce(reverse, F.lit(0.0))


def upper_names(df: DataFrame) -> DataFrame:
    """Column names without surrounding blanks, in capitals."""
    return df.toDF(*[c.strip().upper() for c in df.columns])


def blocks_to_long(df: DataFrame, keys: Sequence[str] = STATION_KEY) -> DataFrame:
    """One row per count out of the blocks ``KFZ_n``, ``SV_n``, ``DATUM_n``.

    A block that lacks a column is left out; counts without value, date or position drop out.
    ``unread_dates`` lists those whose date is there but can't be read.
    """
    long = _all_blocks(df, keys)
    known = F.col("kfz").isNotNull() & F.col("datum").isNotNull()
    for place in ("BREITENGRAD", "LAENGENGRAD"):
        if place in keys:
            known = known & F.col(place).isNotNull()
    return long.filter(known).drop("datum_text")


def unread_dates(df: DataFrame, keys: Sequence[str] = STATION_KEY) -> DataFrame:
    """Counts that ``blocks_to_long`` rejects because of the form of their date."""
    unread = F.col("datum").isNull() & (F.trim("datum_text") != "")
    return _all_blocks(df, keys).filter(F.col("kfz").isNotNull() & unread).drop("datum")


def _all_blocks(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    wide = upper_names(df)
    blocks = [
        n
        for n in COUNT_BLOCKS
        if {f"KFZ_{n}", f"SV_{n}", f"DATUM_{n}"} <= set(wide.columns)
    ]
    if not blocks:
        raise ValueError(f"no complete count block in {wide.columns}")
    counts = F.array(
        *[
            F.struct(
                F.lit(n).alias("block"),
                v.number(wide, f"KFZ_{n}").alias("kfz"),
                v.number(wide, f"SV_{n}").alias("sv"),
                v.read_date(F.col(f"DATUM_{n}").cast("string")).alias("datum"),
                F.col(f"DATUM_{n}").cast("string").alias("datum_text"),
            )
            for n in blocks
        ]
    )
    places = [c for c in ("BREITENGRAD", "LAENGENGRAD") if c in keys]
    key_columns = [
        v.number(wide, k).alias(k) if k in places else F.col(k) for k in keys
    ]
    return wide.select(*key_columns, F.inline(counts))


def latest_count(long: DataFrame, key: str = "ID") -> DataFrame:
    """Newest count per station; on the same date the later block wins."""
    rest = [c for c in long.columns if c not in (key, "datum", "block")]
    order = F.struct("datum", "block", *rest)
    return last_per_key(long.filter(F.col(key).isNotNull()), [key], order)


def direction_years(names: Sequence[str]) -> list[tuple[int, str, str]]:
    """Years with a forward and a reverse column, newest first: ``(year, forward, reverse)``."""

    def found(pattern: str) -> dict[int, str]:
        return {int(m.group(1)): n for n in names if (m := re.match(pattern, n))}

    forward, reverse = found(FORWARD), found(REVERSE)
    years = sorted(forward.keys() & reverse.keys(), reverse=True)
    if not years:
        raise ValueError(f"no year with both directions in {list(names)}")
    return [(y, forward[y], reverse[y]) for y in years]


def pick_direction_year(df: DataFrame) -> DataFrame:
    """Cross-section count per edge: newest year with both directions, else with one."""
    both, one = [], []
    for year, forward, reverse in direction_years(df.columns):
        k, r = v.number(df, forward), v.number(df, reverse)
        total = F.coalesce(k, F.lit(0.0)) + F.coalesce(r, F.lit(0.0))
        choice = F.struct(total.alias("dtv_kfz"), F.lit(year).alias("year"))
        both.append(F.when(k.isNotNull() & r.isNotNull(), choice))
        one.append(F.when(k.isNotNull() | r.isNotNull(), choice))
    picked = df.withColumn("_pick", F.coalesce(*both, *one))
    return picked.filter(F.col("_pick").isNotNull()).withColumns(
        {"dtv_kfz": F.col("_pick.dtv_kfz"), "year": F.col("_pick.year")}
    ).drop("_pick")


def five_or_ten(df: DataFrame, value: str, period: str) -> tuple[Column, Column]:
    """Five-year mean and the end of its period, else the ten-year mean and its end."""
    v5, v10 = v.number(df, f"{value}_5j"), v.number(df, f"{value}_10j")
    y5, y10 = (roads.period_end_year(F.col(f"{period}_{n}").cast("string")) for n in ("5j", "10j"))
    return F.coalesce(v5, v10), F.when(v5.isNotNull(), y5).otherwise(y10)

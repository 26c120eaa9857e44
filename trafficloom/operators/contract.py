"""Checking a table against the canonical contract.

All row checks are one aggregate: a few counters per task, whatever the size of the table. The
offending rows and values are never gathered; they can be listed as a distributed table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficloom.functions.geometry import is_missing
from trafficloom.model import COLUMNS, ENUMS, REQUIRED, SRID

EXAMPLES = 20  # offending values quoted in an error text


class ContractError(ValueError):
    """A table breaks the canonical contract."""


def missing_columns(df: DataFrame) -> list[str]:
    """Contract columns the table does not have; needs no job."""
    return [c for c in (*COLUMNS, "geometry") if c not in df.columns]


def broken_rules() -> dict[str, Column]:
    """Rule name to a condition that is true for an offending row, in reporting order."""
    geometry = F.col("geometry")
    rules = {"srid": ~is_missing(geometry) & ~geometry["srid"].eqNullSafe(F.lit(SRID))}
    rules.update({f"null:{c}": F.col(c).isNull() for c in REQUIRED})
    rules.update(
        {f"enum:{c}": F.col(c).isNotNull() & ~F.col(c).isin(*ok) for c, ok in ENUMS.items()}
    )
    rules["geometry"] = is_missing(geometry)
    return rules


def _counters() -> list[Column]:
    return [F.count_if(bad).alias(rule) for rule, bad in broken_rules().items()]


def violations(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows ``(by…, rule, n)`` for every broken rule."""
    counted = df.groupBy(*by).agg(*_counters()) if by else df.agg(*_counters())
    rules = F.array(
        *[
            F.struct(F.lit(r).alias("rule"), F.col(f"`{r}`").alias("n"))
            for r in broken_rules()
        ]
    )
    return counted.select(*by, F.inline(rules)).filter("n > 0")


def invalid_values(df: DataFrame) -> DataFrame:
    """Every value outside its domain with its number of rows: ``(column, value, n)``."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.when(~F.col(c).isin(*ok), F.col(c)).alias("value"))
            for c, ok in ENUMS.items()
        ]
    )
    return (
        df.select(F.inline(cells))
        .filter("value is not null")
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Rows ``(column, n)``: missing values per required column, zeros included."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in REQUIRED])
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in REQUIRED]
    )
    return counted.select(F.inline(cells))


def describe(counts: dict[str, int], where: str, df: DataFrame | None = None) -> str | None:
    """Error text for broken rules, or None."""
    broken = {rule: counts[rule] for rule in broken_rules() if counts.get(rule)}
    if not broken:
        return None
    text = f"{where}: " + ", ".join(f"{rule} in {n} rows" for rule, n in broken.items())
    if df is not None and any(rule.startswith("enum:") for rule in broken):
        values = invalid_values(df)
        worst = values.orderBy(F.desc("n"), "column", "value").limit(EXAMPLES).collect()
        text += "; e.g. " + ", ".join(f"{r['column']}={r['value']!r}" for r in worst)
        more = values.count() - len(worst)
        if more:
            text += f" and {more} other values (invalid_values lists all)"
    return text


def check_columns(df: DataFrame, where: str) -> None:
    absent = missing_columns(df)
    if absent:
        raise ContractError(f"{where}: missing columns {absent}")


def validate(df: DataFrame, where: str = "<table>") -> DataFrame:
    """Raise ``ContractError`` or return the table unchanged."""
    check_columns(df, where)
    found = df.agg(*_counters()).first().asDict()
    text = describe(found, where, df)
    if text:
        raise ContractError(text)
    return df


def marked(df: DataFrame) -> DataFrame:
    """The table with ``fits``: whether a row breaks no rule."""
    fits = F.lit(True)
    for bad in broken_rules().values():
        fits = fits & ~bad
    # As an exploded list it stays a value of the row, see quarantine.
    return df.withColumn("fits", F.explode(F.array(fits)))


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and the others with the names of the rules they break."""
    rules = broken_rules()
    found = F.array_compact(F.array(*[F.when(bad, F.lit(rule)) for rule, bad in rules.items()]))
    # Exploding the one list keeps it a value of the row: a plain column would be copied into
    # the filters, and they would work out the geometry a second time.
    marked = df.withColumn("broken", F.explode(F.array(found)))
    good = marked.filter(F.size("broken") == 0).drop("broken")
    return good, marked.filter(F.size("broken") > 0)

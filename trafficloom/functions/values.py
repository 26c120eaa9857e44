"""Reading numbers, counts, dates and empty cells out of loosely typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------------------
# Cell texts that a CSV reader of the original data treats as missing.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# ----------------------------------------------------------------------------------------

# White space in the Unicode sense; plain trim() only removes blanks.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(WHITESPACE))


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def null_tokens(c: Column) -> Column:
    """Null for an empty cell or one of the usual words for "missing"."""
    return F.when(~c.isin(*NULL_TOKENS), c)


def finite(c: Column) -> Column:
    """A numeric column as double, without NaN and infinities."""
    d = c.cast("double")
    return F.when(F.abs(d) < F.lit(float("inf")), d)


def parse_number(c: Column) -> Column:
    """A text column as double; anything that is not a plain decimal number is null.

    The cast alone would also accept ``1d``, ``1f``, ``nan`` and ``Infinity``: no letter but the
    exponent mark may occur.
    """
    return F.when(~c.rlike("[A-DF-Za-df-z]"), finite(c.try_cast("double")))


def number(df: DataFrame, name: str) -> Column:
    """Column ``name`` as double, read the way its type needs."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return parse_number(F.col(f"`{name}`"))
    if isinstance(kind, (T.NullType, T.BooleanType)):
        return F.col(f"`{name}`").cast("double")
    return finite(F.col(f"`{name}`"))


def count_value(x: Column) -> Column:
    """A double as a whole count; halves go to the even neighbour."""
    return F.bround(x, 0).try_cast("bigint")


def whole_year(x: Column) -> Column:
    """A double as a year; a fractional one is null and fails the contract later."""
    return F.when(x == F.floor(x), x.try_cast("int"))


def clean_kfz(kfz: Column) -> Column:
    """Zero vehicles a day is a placeholder, never a count."""
    return F.nullif(kfz, F.lit(0).cast("bigint"))


def clean_sv(kfz: Column, sv: Column) -> Column:
    """Zero heavy vehicles only counts beside a (cleaned) total."""
    return F.when(~(kfz.isNull() & F.coalesce(sv == 0, F.lit(False))), sv)


_DAY_MONTH_YEAR = r"^\s*(\d{1,2})\.(\d{1,2})\.(\d{4})"


def read_date(text: Column) -> Column:
    """ISO dates with or without time, also a bare date with a zone mark (``2022-09-20Z``) as map
    services write it, and day.month.year; null for anything else."""
    text = text.cast("string")
    day, month, year = (F.regexp_extract(text, _DAY_MONTH_YEAR, i) for i in (1, 2, 3))
    turned = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    bare = F.regexp_replace(text, r"^\s*(\d{4}-\d{2}-\d{2})Z\s*$", "$1")
    return F.coalesce(bare.try_cast("timestamp"), F.when(year != "", turned).try_cast("timestamp"))


def year_of(c: Column) -> Column:
    """Year of a date text or timestamp; an unreadable one is null."""
    return F.year(read_date(c))


def id_text(c: Column) -> Column:
    """An identifier as text: whole doubles lose their fraction part first."""
    return c.cast("string")

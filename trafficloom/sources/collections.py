"""Large feature collections read in pieces, and pages in the order of their links.

A GeoJSON collection is one document, whatever its size. Its features all start with the same text,
which serves as the record separator of a plain text read: byte ranges of the file become tasks, and
each piece is completed to a small collection of its own and parsed there. Nothing is guessed: a
piece that does not parse, a file without end or with two is an error.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficloom.operators import chains

#: How a feature starts; writers differ in white space only.
START = re.compile(r'\{\s*"type"\s*:\s*"Feature"')
#: Rows of the first file, cut at "{", in which a first feature is looked for.
HEAD_ROWS = 16
_OPENING = '{"features":['


class CollectionError(ValueError):
    """The landed text is not one whole feature collection per file."""


def feature_start(reader, paths: str | Sequence[str]) -> str | None:
    """The text that starts every feature, found in the first rows of the landed files; None where
    features start otherwise, so that documents must be read whole."""
    rows = reader.option("lineSep", "{").text(paths).limit(HEAD_ROWS).collect()
    found = START.search("{".join(r["value"] or "" for r in rows) + "{")
    return found[0] if found else None


def whole_pieces(text: Column, start: str) -> Column:
    """A piece between two separators as a collection: its own feature, or what stands before the
    first one, or a document whose features start otherwise."""
    t = F.regexp_replace(text, r"\s+$", "")
    document = F.regexp_replace(F.substring(t, 1, 64), r"^[\s﻿]+", "").startswith("{")
    comma = t.endswith(",")
    body = F.when(comma, F.substring(t, F.lit(1), F.length(t) - 1)).otherwise(t)
    closing = F.when(comma | (document & t.endswith("[")), "]}").otherwise("")
    return F.concat(F.when(document, "").otherwise(_OPENING + start), body, closing)


def unclosed(pieces: DataFrame) -> DataFrame:
    """``(file, starts, ends, odd)`` of files that are not one whole document: one piece starts it,
    one ends it, all others end with the comma before the next feature. ``pieces``: file, value."""
    t = F.regexp_replace("value", r"\s+$", "")
    document = F.regexp_replace(F.substring(t, 1, 64), r"^[\s﻿]+", "").startswith("{")
    ends, opens = t.endswith("}"), document & t.endswith("[")
    counted = pieces.groupBy("file").agg(
        F.count_if(document).alias("starts"),
        F.count_if(ends).alias("ends"),
        F.count_if(~ends & ~opens & ~t.endswith(",")).alias("odd"),
    )
    return counted.filter("starts <> 1 or ends <> 1 or odd > 0")


def read_pieces(reader, paths: str | Sequence[str], start: str) -> DataFrame:
    """``(file, block, row, value)``: the text between the separators, a task per byte range."""
    raw = reader.option("lineSep", start).text(paths)
    return raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )


def checked_pieces(reader, paths: str | Sequence[str], start: str) -> DataFrame:
    pieces = read_pieces(reader, paths, start)
    bad = unclosed(pieces).limit(1).collect()
    if bad:
        b = bad[0]
        raise CollectionError(
            f"{b['file']}: {b['starts']} starts and {b['ends']} ends of a collection instead of one each,"
            f" {b['odd']} pieces that end otherwise"
        )
    return pieces


# ---------------------------------------------------------------------------- page chains


def page_name(address: Column) -> Column:
    """Name a page is landed under: the last path step of its link, query included, with every
    character outside letters, digits, dot and hyphen replaced by an underscore."""
    return F.regexp_replace(F.regexp_extract(address, r"([^/]+)$", 1), r"[^A-Za-z0-9.-]", "_")


def page_order(pages: DataFrame) -> DataFrame:
    """``(folder, page, next)`` to ``(folder, page, at)``: the place of every page in the chain of
    its folder, by its links and not by its name.

    ``next`` is the name of the following page, null at the end. A folder without any link has no
    order to follow (``at`` is null). A link to a page that is not there, a page that two others
    lead to, a circle, or pages beside the chain are errors.
    """
    # A number stands for a page: names would travel in every round.
    rows = chains.saved(pages.select("folder", "page", "next", F.monotonically_increasing_id().alias("state")))
    linked = rows.filter("next is not null").select("folder").distinct()
    here = rows.join(linked, "folder", "left_semi")
    before = here.filter("next is not null").groupBy("folder", F.col("next").alias("page")).agg(
        F.min("state").alias("prev"), F.count("*").alias("leads")
    )
    met = chains.saved(here.select("folder", "page", "state").join(before, ["folder", "page"], "full"))
    _refuse(met.filter("state is null"), "pages not landed")
    _refuse(met.filter("leads > 1"), "pages that several others lead to")
    _refuse(rows.groupBy("folder", "page").count().filter("count > 1"), "pages landed twice")
    ordered = chains.follow(met.select("state", "prev"))
    _refuse(ordered.filter("ring").join(rows, "state"), "pages in a circle")
    # Each folder is one list: a second start is a page that no link leads to.
    starts = met.filter("prev is null").groupBy("folder").agg(F.count("*").alias("n"), F.max("page").alias("page"))
    _refuse(starts.filter("n > 1"), "pages beside the chain")
    # A page without a name has no place.
    at = F.when(F.col("page").isNotNull(), F.col("at")).alias("at")
    return rows.select("folder", "page", "state").join(ordered.select("state", "at"), "state", "left").select("folder", "page", at)


def _refuse(rows: DataFrame, what: str) -> None:
    found = rows.agg(F.count("*").alias("n"), F.min(F.to_json(F.struct("folder", "page"))).alias("one")).first()
    if found["n"]:
        raise CollectionError(f"{found['n']} {what}, among them {found['one']}")

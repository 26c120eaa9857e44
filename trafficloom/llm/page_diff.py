"""Main text of web pages: lines shared with the nearest pages of the host go, containers check it.

A page becomes text lines (page_lines). The distinct pages of a host are set in the order of their
URL paths and every one is aligned, by longest common subsequence of all its lines, with the nearest
two of its four neighbours there (longest common path prefix first). Lines shared with both are the
site's frame; a host with two pages has one partner for each. A neighbour that shares four fifths of
its text is a copy, not a sign of the site's frame, and is passed over, as copies would erase each other.

What the containers say is the check that follows: lines in menus, headers, adverts, comments and the
like go even if no neighbour has them, and lines in an element that declares the article stay even if
the neighbours share them. All others are open, and for them the alignment decides. A line that goes
by its containers is never the same as one that doesn't. Pages with open lines have such pages for
neighbours, the rest the rest. Pages are distinct by what the check leaves.

Defined results: a null html counts as empty; pages without text give the empty string. Null and
unreadable URLs share one host, the empty one. Repeated rows and ids give one row each. All rules
look at the page, its host's pages and nothing else. An empty table gives no rows. Extra columns
play no part.
"""

from __future__ import annotations

import os.path
import re
from collections import deque
from collections.abc import Iterator
from itertools import chain, groupby, repeat

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_hot, saved
from .page_lines import AWAY, OPEN, lines

#: Partners of a page, and how many neighbours on each side they are chosen from.
PARTNERS, REACH = 2, 2
#: Two pages that share this part of their open text are copies.
COPY = 0.8
#: Up to so many table cells (bits) an alignment keeps all rows; beyond it is split.
_CELLS = 1 << 26
#: Rows a Python task hands over at once.
_BATCH = 256
#: Pages that follow each other meet their neighbours in blocks of so many (bits).
_BLOCK = 8

_URL = re.compile(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)([^#]*)")


def host_and_path(url: str | None) -> tuple[str, str]:
    found = _URL.match((url or "").strip())
    return (found[1].lower(), found[2]) if found else ("", "")


# -- alignment

def _rows(a: list, b: list) -> Iterator[int]:
    """Longest common subsequences of every prefix of a with all prefixes of b, as bit rows: of the
    first j bits, the zeros count the length."""
    everywhere: dict = {}
    for j, x in enumerate(b):
        everywhere[x] = everywhere.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hits = row & everywhere.get(x, 0)
        row = ((row + hits) | (row - hits)) & full
        yield row


def _lengths(a: list, b: list) -> list[int]:
    row = (1 << len(b)) - 1
    for row in _rows(a, b):
        pass
    out, length = [0], 0
    for bit in reversed(bin(row | 1 << len(b))[3:]):
        length += bit == "0"
        out.append(length)
    return out


def common(a: list, b: list) -> list[tuple[int, int]]:
    """Places of a longest common subsequence of a and b, as rising pairs."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, k, j, m = todo.pop()
        while i < k and j < m and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < k and j < m and a[k - 1] == b[m - 1]:
            k, m = k - 1, m - 1
            found.append((k, m))
        # Lines of one side only are in no alignment.
        shared = set(a[i:k]) & set(b[j:m])
        left = [x for x in range(i, k) if a[x] in shared]
        right = [x for x in range(j, m) if b[x] in shared]
        if not left:
            continue
        own, other = [a[x] for x in left], [b[x] for x in right]
        if len(own) * len(other) <= _CELLS or len(own) == 1:
            found += [(left[x], right[y]) for x, y in _walk(own, other)]
            continue
        half = len(own) // 2
        before = _lengths(own[:half], other)
        after = _lengths(own[half:][::-1], other[::-1])[::-1]
        cut = max(range(len(other) + 1), key=lambda y: before[y] + after[y])
        mid_a = left[half]
        mid_b = right[cut] if cut < len(right) else m
        todo += [(i, mid_a, j, mid_b), (mid_a, k, mid_b, m)]
    return sorted(found)


def _walk(a: list, b: list) -> list[tuple[int, int]]:
    rows = list(_rows(a, b))
    i, j, out = len(a) - 1, len(b) - 1, []

    def length(i: int, j: int) -> int:
        """Of the first i + 1 and j + 1 lines."""
        return j + 1 - (rows[i] & ((2 << j) - 1)).bit_count() if i >= 0 and j >= 0 else 0

    now = length(i, j)
    while now:
        if a[i] == b[j]:
            out.append((i, j))
            i, j, now = i - 1, j - 1, now - 1
        elif length(i - 1, j) == now:
            i -= 1
        else:
            j -= 1
    return out


def shared_lines(me: dict, others: list[dict]) -> list[int]:
    """Places of the lines that me shares with its nearest pages (host, path, at, hashes, lengths)."""
    hashes, total = me["hashes"], sum(me["lengths"])

    def nearness(o: dict) -> tuple:
        prefix = len(os.path.commonprefix((me["path"], o["path"])))
        return -prefix, abs(o["at"] - me["at"]), o["at"]

    kept: set[int] | None = None
    used = 0
    for other in sorted((o for o in others if o["host"] == me["host"]), key=nearness):
        places = {i for i, _ in common(hashes, other["hashes"])}
        if sum(me["lengths"][i] for i in places) >= COPY * max(total, sum(other["lengths"])):
            continue
        kept = places if kept is None else kept & places
        used += 1
        if used == PARTNERS:
            break
    return sorted(kept or ())


# -- pages

def _parse(batches: Iterator[pa.RecordBatch], schema: pa.Schema, texts: bool) -> Iterator[pa.RecordBatch]:
    """texts: the lines that may be in the result; else what the alignment needs: all lines, those
    that the check takes away with length 0."""
    names = schema.names
    for batch in batches:
        for at in range(0, batch.num_rows, _BATCH):
            part = batch.slice(at, _BATCH)
            ids = part.column("page_id") if texts else [None] * part.num_rows
            out: dict[str, list] = {n: [] for n in names}
            for page, url, html in zip(ids, part.column("url").to_pylist(), part.column("html").to_pylist()):
                found, marks = lines(html)
                if not texts and not found:
                    continue
                host, path = host_and_path(url)
                is_open = OPEN in marks
                left = [t for t, m in zip(found, marks) if m != AWAY]
                named = xxhash.xxh3_128_hexdigest("\n".join(left).encode("utf-8", "surrogatepass"))
                row = {
                    "page_id": page.as_py() if texts else None, "url": url, "host": host, "path": path,
                    "content": named if is_open else f"settled {named}", "is_open": is_open, "texts": left,
                }
                if not texts:
                    # An advert's text is not that of a neighbour's paragraph, even if it reads the same.
                    seeds = [int(m == AWAY) for m in marks]
                    row["hashes"] = [
                        xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass"), seed) - 2**63
                        for t, seed in zip(found, seeds)
                    ]
                    row["lengths"] = [len(t) if m != AWAY else 0 for t, m in zip(found, marks)]
                for n in names:
                    out[n].append(row[n])
            yield pa.RecordBatch.from_pydict(out, schema=schema)


def _parsed(pages: DataFrame, ddl: str, texts: bool) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(pages.sparkSession.createDataFrame([], ddl).schema)
    return pages.mapInArrow(lambda batches: _parse(batches, schema, texts), ddl)


def _in_order(pages: DataFrame) -> DataFrame:
    """The rows, saved, with their place (at) in the order of host, kind, path and content. Sorted by
    ranges, so that a large host spreads over many tasks; the driver sees one count per range."""
    ordered = saved(pages.orderBy("host", "is_open", "path", "content").withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    ranges = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    first, offsets = 0, []
    for r in ranges:
        offsets.append((r["part"], first))
        first += r["n"]
    offsets = pages.sparkSession.createDataFrame(offsets, "part long, first long")
    ordered = ordered.join(F.broadcast(offsets), part == F.col("part"))
    return ordered.withColumn("at", F.col("first") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("part", "first")


def _with_neighbours(rows: Iterator[dict]) -> Iterator[tuple[dict, list[dict]]]:
    """Each page that is a block's own, with its neighbours. Of the rows of a block, in order, no more
    than a page and its neighbours are kept."""
    for _, block in groupby(rows, key=lambda r: r["block"]):
        near: deque = deque(repeat(None, 2 * REACH + 1), maxlen=2 * REACH + 1)
        for row in chain(block, repeat(None, REACH)):
            near.append(row)
            me = near[REACH]
            if me and me["own"]:
                yield me, [o for o in near if o and o is not me]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (r for b in batches for at in range(0, b.num_rows, _BATCH) for r in b.slice(at, _BATCH).to_pylist())
    types = {"host": pa.string(), "content": pa.string(), "frame": pa.list_(pa.bool_())}
    out: list[dict] = []
    for me, near in _with_neighbours(rows):
        places = set(shared_lines(me, [o for o in near if o["is_open"] == me["is_open"]]))
        frame = [i in places for i, n in enumerate(me["lengths"]) if n]
        if any(frame):
            out.append({"host": me["host"], "content": me["content"], "frame": frame})
        if len(out) == _BATCH:
            yield pa.RecordBatch.from_pylist(out, pa.schema(types))
            out = []
    yield pa.RecordBatch.from_pylist(out, pa.schema(types))


def frame_lines(pages: DataFrame) -> DataFrame:
    """host, content and frame, of pages that share lines with their nearest ones: of each line that
    may be in the result, whether it is shared."""
    ddl = "host string, path string, content string, is_open boolean, hashes array<bigint>, lengths array<int>"
    narrow = _parsed(pages, ddl, False)
    distinct = narrow.groupBy("host", "content").agg(F.min(F.struct("path", "is_open", "hashes", "lengths")).alias("r"))
    placed = _in_order(distinct.select("host", "content", "r.*"))
    # A page goes to its own block and to those whose pages have it for a neighbour.
    places = (F.col("at") + step for step in range(-REACH, REACH + 1))
    blocks = F.array_distinct(F.array(*(F.shiftright(place, _BLOCK) for place in places)))
    sent = placed.withColumn("block", F.explode(blocks)).withColumn("own", F.col("block") == F.shiftright("at", _BLOCK))
    met = sent.repartition("block").sortWithinPartitions("block", "at")
    return met.mapInArrow(_compare, "host string, content string, frame array<boolean>")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars, a row per page; n_shared, the lines deleted as shared, and
    n_kept, lines as much shared that stay as the article's."""
    page_type = pages.schema["page_id"].dataType.simpleString()
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    frame = saved(frame_lines(pages.select("url", "html")))
    ddl = f"page_id {page_type}, url string, host string, content string, is_open boolean, texts array<string>"
    rows = join_hot(_parsed(pages, ddl, True), frame, ["host", "content"], "left")
    left = F.filter("texts", lambda _, i: ~(F.col("is_open") & F.coalesce(F.get("frame", i), F.lit(False))))
    shared = F.size(F.filter(F.coalesce("frame", F.array().cast("array<boolean>")), lambda x: x)).cast("long")
    rows = rows.select(
        "page_id", "url", F.array_join(left, "\n").alias("text"),
        F.when(F.col("is_open"), shared).otherwise(0).alias("n_shared"),
        F.when(F.col("is_open"), 0).otherwise(shared).cast("long").alias("n_kept"),
    )
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_shared", "n_kept")

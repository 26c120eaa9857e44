"""Vectors as short codes: a codebook for each of 16 parts, fitted over all rows.

Components become integers, floor(256 * x). Blocks of some thousand vectors are written once with a
dictionary per dimension: its distinct integers and, for every vector, the place of its own among
them. A round tabulates the squared differences of every distinct integer to all entries of the
codebook; a part's distances are then rows gathered from the tables of its dimensions and added. All
sums are of integers, so neither the order of rows nor lost tasks change a result.

Defined results: rows with a null vector or one with null or non-finite components are dropped; the
empty vector is kept (all its parts are empty, so it is entry 0 with error 0). Vectors of different
length have codebooks of their own; where 16 does not divide a length, part p is the components from
floor(p * length / 16) on. Rows without id are coded and come last where codebooks start, repeated
ids in the order of their vectors, and every row counts. Fewer than 64 kept rows make a smaller codebook.
Integers of any size are exact; an error that a long can't hold is shown as the longs' end. An empty
table gives no rows. Extra columns play no part.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_hot, saved

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Vectors of a block.
BLOCK = 4096
#: Below it (absolute values), squares and their sums over a vector fit a long.
SMALL = 1 << 24
_LIMB = 30
LONGEST = 2**63 - 1


def kept(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """id, label, v of the rows that take part."""
    rows = df.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).alias("label"),
        F.col(vec_col).cast("array<double>").alias("v"),
    ).filter("v is not null")
    # NaN is larger than any number here, so one comparison finds both kinds.
    return rows.filter(F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))))


def integers(v: np.ndarray) -> np.ndarray:
    """floor(256 * x): int64 where all are small, else Python integers."""
    if v.size == 0 or np.abs(v).max() < SMALL // SCALE:
        return np.floor(v * SCALE).astype(np.int64)
    whole = np.empty(v.shape, object)
    whole.ravel()[:] = [int(x) * SCALE if abs(x) >= 2.0**53 else math.floor(x * SCALE) for x in v.ravel().tolist()]
    return whole


def bounds(dim: int) -> list[int]:
    return [p * dim // PARTS for p in range(PARTS + 1)]


def _blocks(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("v")
        sizes = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        starts = np.concatenate(([0], np.cumsum(sizes)))
        out = []
        for dim in np.unique(sizes).tolist():
            mine = np.flatnonzero(sizes == dim)
            for at in range(0, len(mine), BLOCK):
                rows = mine[at : at + BLOCK]
                v = flat[starts[rows][:, None] + np.arange(dim)]
                whole = integers(v)
                values, codes, counts = [], np.empty((dim, len(rows)), "<u2"), []
                for d in range(dim):
                    distinct, code = np.unique(whole[:, d], return_inverse=True)
                    values += distinct.tolist()
                    counts.append(len(distinct))
                    codes[d] = code
                wide = whole.dtype == object
                chosen = batch.take(pa.array(rows))
                out.append(
                    {
                        "dim": dim,
                        "ids": chosen.column("id").to_pylist(),
                        "labels": chosen.column("label").to_pylist(),
                        "counts": np.array(counts, "<i4").tobytes(),
                        "dictionary": None if wide else np.array(values, "<i8").tobytes(),
                        "wide": [str(x) for x in values] if wide else None,
                        "codes": codes.tobytes(),
                    }
                )
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)


def blocks(rows: DataFrame) -> DataFrame:
    """The rows by block: ids, labels, the dictionaries of all dimensions and the codes."""
    label = rows.schema["label"].dataType.simpleString()
    made = (
        f"dim int, ids array<bigint>, labels array<{label}>, counts binary, dictionary binary,"
        " wide array<string>, codes binary"
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = rows.sparkSession.createDataFrame([], made).schema
    arrow = to_arrow_schema(schema)
    return rows.mapInArrow(lambda batches: _blocks(batches, arrow), made)


def dictionaries(row: dict) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct integers of every dimension, and the codes, a row per dimension."""
    counts = np.frombuffer(row["counts"], "<i4")
    if row["wide"] is None:
        values = np.frombuffer(row["dictionary"], "<i8")
    else:
        values = np.array([int(x) for x in row["wide"]], object)
    ends = np.cumsum(counts)
    codes = np.frombuffer(row["codes"], "<u2").reshape(row["dim"], len(row["ids"]))
    return [values[e - n : e] for e, n in zip(ends.tolist(), counts.tolist())], codes


def nearest(values: list[np.ndarray], codes: np.ndarray, book: list) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of every part (a row per part) and the squared distances summed over the
    parts. book: the entries, each a list of integers."""
    dim, n = codes.shape
    entries = np.array(book, object).reshape(len(book), dim)
    largest = max([abs(int(x)) for x in entries.ravel()] + [abs(int(x)) for v in values for x in (v[0], v[-1])], default=0)
    kind = np.int64 if 4 * largest * largest * max(1, dim) < 2**62 else object
    entries = entries.astype(kind)
    chosen, error = np.zeros((PARTS, n), np.uint8), np.zeros(n, kind)
    cuts = bounds(dim)
    for p in range(PARTS):
        distance = np.zeros((n, len(book)), kind)
        for d in range(cuts[p], cuts[p + 1]):
            table = values[d].astype(kind)[:, None] - entries[None, :, d]
            distance += (table * table)[codes[d]]
        best = np.argmin(distance, axis=1)  # the first of equal ones
        chosen[p] = best
        error += distance[np.arange(n), best]
    return chosen, error


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One block at a time in memory as Python objects."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _sums(batches: Iterator[pa.RecordBatch], books: dict, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Per entry of a part: its parts' count (place -1) and component sums, in limbs of 30 bits."""
    totals: dict[int, np.ndarray] = {}
    for row in _rows(batches):
        dim, book = row["dim"], books[row["dim"]]
        values, codes = dictionaries(row)
        chosen, _ = nearest(values, codes, book)
        cuts = bounds(dim)
        total = totals.setdefault(dim, np.zeros((ENTRIES, dim + PARTS), object))
        for p in range(PARTS):
            counts = np.bincount(chosen[p], minlength=ENTRIES)
            total[:, dim + p] += counts.astype(object)
            for d in range(cuts[p], cuts[p + 1]):
                added = np.zeros(ENTRIES, values[d].dtype)
                np.add.at(added, chosen[p], values[d][codes[d]])
                total[:, d] += added.astype(object)
    out: dict[str, list] = {name: [] for name in schema.names}
    for dim, total in totals.items():
        for (entry, place), sum_ in np.ndenumerate(total):
            limb = 0
            while sum_ not in (0, -1):
                for name, x in zip(schema.names, (dim, entry, place, limb, sum_ & ((1 << _LIMB) - 1))):
                    out[name].append(int(x))
                sum_ >>= _LIMB
                limb += 1
            if sum_:
                for name, x in zip(schema.names, (dim, entry, place, limb, -1)):
                    out[name].append(int(x))
    yield pa.RecordBatch.from_pydict(out, schema=schema)


def next_books(made: DataFrame, books: dict) -> dict:
    """Every entry replaced by the floored mean of its parts; unused ones stay. What reaches the
    driver is a few numbers per entry and component."""
    names = ("dim", "entry", "place", "limb", "value")
    schema = pa.schema([(n, pa.int64()) for n in names])
    found = made.mapInArrow(lambda b: _sums(b, books, schema), ", ".join(f"{n} long" for n in names))
    totals: dict[tuple, int] = {}
    for r in found.groupBy(*names[:-1]).agg(F.sum("value").alias("value")).collect():
        key = (r["dim"], r["entry"], r["place"])
        totals[key] = totals.get(key, 0) + (r["value"] << (_LIMB * r["limb"]))
    after = {}
    for dim, book in books.items():
        cuts = bounds(dim)
        after[dim] = [list(e) for e in book]
        for i, entry in enumerate(after[dim]):
            for p in range(PARTS):
                count = totals.get((dim, i, dim + p), 0)
                for d in range(cuts[p], cuts[p + 1]):
                    if count:
                        entry[d] = totals.get((dim, i, d), 0) // count
    return after


def first_books(rows: DataFrame) -> dict:
    """The vectors of the 64 smallest ids of every length. Each map task sends 64 at most."""
    order = Window.partitionBy("dim").orderBy(F.asc_nulls_last("id"), "v")
    rows = rows.withColumn("dim", F.size("v")).withColumn("at", F.row_number().over(order))
    found = rows.filter(F.col("at") <= ENTRIES).orderBy("dim", "at").select("dim", "v").collect()
    books: dict[int, list] = {}
    for r in found:
        whole = integers(np.array(r["v"], float).reshape(1, -1))
        books.setdefault(r["dim"], []).append([int(x) for x in whole[0]])
    return books


def digest(book: list) -> str:
    """SHA-256 of all components by part, entry and place within the part."""
    cuts = bounds(len(book[0]))
    listed = (str(x) for p in range(PARTS) for entry in book for x in entry[cuts[p] : cuts[p + 1]])
    return hashlib.sha256(",".join(listed).encode()).hexdigest()


def _codes(batches: Iterator[pa.RecordBatch], books: dict, digests: dict, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    width = 2 * PARTS
    for row in _rows(batches):
        chosen, error = nearest(*dictionaries(row), books[row["dim"]])
        text = np.ascontiguousarray(chosen.T).tobytes().hex()
        made = {
            "vec_id": row["ids"],
            "label": row["labels"],
            "code": [text[i : i + width] for i in range(0, len(text), width)],
            "error": [min(int(e), LONGEST) for e in error],
            "codebooks_sha256": [digests[row["dim"]]] * len(row["ids"]),
        }
        yield pa.RecordBatch.from_pydict(made, schema=schema)


def compress(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", rounds: int = ROUNDS
) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error, codebooks_sha256."""
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = kept(df, id_col, vec_col, label_col)
    books = first_books(rows)
    made = saved(blocks(rows))
    for _ in range(rounds):
        books = next_books(made, books)
    digests = {dim: digest(book) for dim, book in books.items()}
    label = rows.schema["label"].dataType.simpleString()
    out = f"vec_id bigint, label {label}, code string, error bigint, codebooks_sha256 string"
    arrow = to_arrow_schema(df.sparkSession.createDataFrame([], out).schema)
    coded = saved(made.mapInArrow(lambda b: _codes(b, books, digests, arrow), out))
    by_label = coded.groupBy("label").agg(_long(F.sum(F.col("error").cast("decimal(38,0)"))).alias("label_error"))
    both = join_hot(coded, by_label, ["label"])
    return both.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _long(total: Column) -> Column:
    return F.least(total, F.lit(LONGEST).cast("decimal(38,0)")).cast("long")

"""Quality classifier by importance resampling.

Two generative models of hashed word n-grams, one of target text and one of all text, give each
document the log of its probability ratio. Documents are sampled without replacement in proportion
to that ratio: Gumbel noise is added to the log weight and the top k are kept. A document's own n-grams are taken out of both models before it
is weighed, so that documents the models have seen and others are judged alike.

What no document may be (toxic) has models of its own, of text labelled so and of text labelled
otherwise. In a sum over the whole text a few insults drown, so only n-grams far likelier in unwanted
text count; benign text can't make up for them. The bound is calibrated by the labelled others.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_small_batches, join_hot, saved, uniform, use_cache

#: Buckets of the models: the only thing that is gathered and sent, whatever the corpus.
BUCKETS = 1 << 18
#: Occurrences of a bucket that the models are taken to agree on beforehand.
PRIOR = 16.0
#: Bytes of texts that reach a Python worker at once.
BATCH = 4 << 20
TOKEN = re.compile(r"\w+|[^\w\s]+")
#: Labelled target documents that the target model is fitted on, at most: a share drawn by hash.
#: Their ids (8 bytes each) are broadcast; everything else is counted over all documents.
FITTED = 20_000
#: Share of the labelled target documents that a calibrated sample keeps, and of the labelled
#: documents that are not unwanted that the bound against unwanted ones lets through.
KEEP = 0.995
#: The models of unwanted text count words and their starts of these lengths (endings vary), up to
#: MOST times a text; log ratios (drawn to 0 by FEW occurrences) say something from SURE on.
STARTS, MOST, FEW, SURE = (5, 7), 4, 1.0, 1.0


class _Hashes(dict):
    LIMIT = 150_000

    def __missing__(self, word: str) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.LIMIT and len(word) <= 64:
            self[word] = value
        return value


_HASHES = _Hashes()
_PAIR = np.uint64(0x9E3779B97F4A7C15)


class _Starts(dict):
    """Buckets of a word and of its starts."""

    LIMIT = 60_000

    def __missing__(self, word: str) -> tuple[int, ...]:
        parts = [word, *(f"{word[:k]} " for k in STARTS if len(word) >= k)]
        value = tuple(xxhash.xxh3_64_intdigest(x) & (BUCKETS - 1) for x in parts)
        if len(self) < self.LIMIT and len(word) <= 64:
            self[word] = value
        return value


_STARTS = _Starts()
#: Words whose hashes, and words whose starts, a worker remembers; results don't depend on it.
REMEMBERED = (_Hashes.LIMIT, _Starts.LIMIT)


def use_word_caches(remembered: tuple[int, int]) -> None:
    """Make the caches of the worker at hand those of this operator, of so many words."""
    use_cache(_HASHES, _STARTS)
    _HASHES.LIMIT, _STARTS.LIMIT = remembered


def words_of(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def buckets_of(words: list[str]) -> np.ndarray:
    """Buckets of the words, runs of signs and pairs of neighbours of a text."""
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    pairs = (h[:-1] * _PAIR) ^ (h[1:] >> np.uint64(3)) if len(h) > 1 else h[:0]
    both = np.concatenate([h, pairs * _PAIR])
    return ((both ^ (both >> np.uint64(32))) & np.uint64(BUCKETS - 1)).astype(np.int64)


def starts_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and their starts, and how often each is there, up to MOST times."""
    counts: dict[int, int] = {}
    for word, n in Counter(words).items():
        for b in _STARTS[word]:
            counts[b] = counts.get(b, 0) + n
    b = np.fromiter(counts, np.int64, len(counts))
    return b, np.minimum(np.fromiter(counts.values(), np.int64, len(counts)), MOST)


def fit(
    docs: DataFrame, text_col: str, aimed_col: str, unwanted_col: str, remembered: tuple[int, int] = REMEMBERED
) -> np.ndarray:
    """Occurrences by bucket in all text (row 0), in the target text (1), and of words and starts in
    text labelled not unwanted (2) and unwanted (3): counts over all rows, of which only one number
    per bucket and model reaches the driver."""

    def count(batches):
        use_word_caches(remembered)
        total = np.zeros((4, BUCKETS), np.int64)
        for batch in batches:
            for text, aimed, unwanted in zip(*(c.to_pylist() for c in batch.columns)):
                words = words_of(text)
                b, n = np.unique(buckets_of(words), return_counts=True)
                total[0, b] += n
                if aimed:
                    total[1, b] += n
                if unwanted is not None:
                    b, n = starts_of(words)
                    total[2 + unwanted, b] += n
        used = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), *(pa.array(row[used]) for row in total)], ["bucket", *"abcd"]
        )

    counts = docs.select(text_col, aimed_col, unwanted_col)
    counts = counts.mapInArrow(count, "bucket long, a long, b long, c long, d long")
    counts = counts.groupBy("bucket").agg(*(F.sum(c).alias(c) for c in "abcd")).toPandas()
    model = np.zeros((4, BUCKETS))
    for row, c in zip(model, "abcd"):
        row[counts["bucket"]] = counts[c]
    return model


def unwanted_weight(words: list[str], unwanted: bool | None, model: np.ndarray, odds: float) -> float:
    """What words and starts say for unwanted text, its own occurrences left out: the sum of what
    their log ratios are above SURE. odds: unwanted text to other text; 0 if either is missing."""
    if odds <= 0:
        return 0.0
    b, n = starts_of(words)
    seen = model[3, b] - n if unwanted else model[3, b]
    expected = (model[2, b] - n if unwanted is False else model[2, b]) * odds
    return float((n * np.maximum(np.log((seen + FEW) / (expected + FEW)) - SURE, 0.0)).sum())


def log_weight(words: list[str], aimed: bool, model: np.ndarray, share: float) -> float:
    """Sum of the log ratios of the text's n-grams, its own occurrences left out. A bucket's ratio
    is drawn to 1 by PRIOR occurrences, so rare ones say little. share: target text in all text."""
    if share <= 0:
        return 0.0
    b, n = np.unique(buckets_of(words), return_counts=True)
    seen = model[1, b] - n if aimed else model[1, b]
    expected = np.maximum(model[0, b] - n, 0) * share
    return float((n * np.log((seen + PRIOR) / (expected + PRIOR))).sum())


def kth_largest(rows: DataFrame, k: int, low: float, high: float) -> float:
    """The k-th largest value of column key, found by counting in ever finer ranges: a few numbers
    reach the driver each time, whatever the table."""
    above = 0
    while True:
        width = (high - low) / 4096
        if width <= 0 or low + width == low:
            return low
        slot = F.least(F.floor((F.col("key") - low) / width), F.lit(4095)).cast("int")
        counts = rows.filter(F.col("key").between(low, high)).groupBy(slot.alias("s"))
        counts = counts.agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("a"), F.max("key").alias("b"))
        for r in sorted(counts.collect(), reverse=True):
            if above + r["n"] >= k:
                low, high = r["a"], r["b"]
                break
            above += r["n"]
        else:
            return low
        if low == high:
            return low


def reached(rows: DataFrame, share: float) -> tuple[float] | None:
    """The largest key that the given share of the rows reaches; None without rows."""
    ends = rows.agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("a"), F.max("key").alias("b")).first()
    return (kth_largest(rows, math.ceil(share * ends["n"]), ends["a"], ends["b"]),) if ends["n"] else None


def resample(
    docs: DataFrame,
    labels: DataFrame,
    target: Column,
    keep: float = KEEP,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = ("doc_id",),
    unwanted: Column | None = None,
    remembered: tuple[int, int] = REMEMBERED,
) -> DataFrame:
    """carry, and quality: a struct of log_weight, key (with Gumbel noise) and kept, for each row.

    labels: id_col and what target (a condition on its columns) asks for. The size k of the sample
    is calibrated: as many as have a key that the given share of the labelled target documents
    reaches; ties at the k-th key stay in. Without labelled target documents every row is kept.
    unwanted (a condition on the labels) rejects rows whatever their key: those with more
    unwanted_weight than the given share of the documents labelled otherwise have. Labels where it
    is null don't count; without labelled documents of both sorts it rejects none.
    Null and empty texts have log weight 0. Equal rows get equal noise, reruns agree. Repeated
    labels count if any of them meets the target, or is unwanted; rows without id are scored but not
    fitted on. An empty table gives no rows. Carried columns keep any name. remembered: words whose
    hashes, and whose starts, a worker keeps; fewer take less memory and more time, nothing else.
    """
    unwanted = F.lit(None) if unwanted is None else unwanted
    marks = labels.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(target, F.lit(False)).alias("aimed"),
        unwanted.cast("boolean").alias("unwanted"),
    )
    marks = marks.filter("id is not null").groupBy("id").agg(F.max("aimed").alias("aimed"), F.max("unwanted").alias("unwanted"))
    marks = saved(marks.filter("aimed or unwanted is not null"))

    def drawn(which: str) -> DataFrame:
        return marks.filter(which).orderBy(F.xxhash64("id"), "id").limit(FITTED)

    fitted = drawn("aimed").select("id", "aimed", F.lit(None).cast("boolean").alias("unwanted"))
    for which in ("unwanted", "not unwanted"):
        fitted = fitted.unionByName(drawn(which).select("id", F.lit(False).alias("aimed"), "unwanted"))
    fitted = fitted.groupBy(F.col("id").alias("__id")).agg(F.max("aimed").alias("aimed"), F.max("unwanted").alias("unwanted"))
    rows = in_small_batches(docs, 256, BATCH).select(
        F.struct(*(F.col(f"`{c}`") for c in carry)).alias("row"),
        F.col(id_col).cast("long").alias("id"),
        F.col(text_col).alias("text"),
    )
    rows = rows.join(F.broadcast(saved(fitted)), F.col("id") == F.col("__id"), "left").drop("__id")
    counts = fit(rows, "text", "aimed", "unwanted", remembered)
    total = counts.sum(axis=1)
    share = float(total[1] / total[0]) if total[0] else 0.0
    odds = float(total[3] / total[2]) if total[2] else 0.0
    model = docs.sparkSession.sparkContext.broadcast(counts)

    @F.pandas_udf("log_weight double, unwanted double")
    def weigh(texts: pd.Series, aims: pd.Series, marks: pd.Series) -> pd.DataFrame:
        use_word_caches(remembered)
        out = []
        for text, aimed, mark in zip(texts, aims, marks):
            words, mark = words_of(text), None if mark is None else bool(mark)
            weight = log_weight(words, aimed is True, model.value, share)
            out.append((weight, unwanted_weight(words, mark, model.value, odds)))
        return pd.DataFrame(out, columns=["log_weight", "unwanted"], dtype=float)

    scored = rows.withColumn("weights", weigh("text", "aimed", "unwanted"))
    gumbel = -F.log(-F.log(uniform(F.col("id").cast("string"), F.xxhash64("text"), F.lit(seed))))
    weight = F.col("weights.log_weight")
    # Turned round, so that larger is better here too.
    fine = (-F.col("weights.unwanted")).alias("fine")
    scored = saved(scored.select("row", "id", weight, (weight + gumbel).alias("key"), fine))
    labelled = saved(join_hot(scored.select("id", "key", "fine"), marks, ["id"]))
    kept = F.lit(True)
    if reach := reached(labelled.filter("aimed").select("key"), keep):
        k = scored.filter(F.col("key") >= reach[0]).count()
        ends = scored.agg(F.min("key").alias("a"), F.max("key").alias("b")).first()
        kept = F.col("key") >= kth_largest(scored, k, ends["a"], ends["b"])
    if bound := reached(labelled.filter("not unwanted").select(F.col("fine").alias("key")), keep):
        kept = kept & (F.col("fine") >= bound[0])
    return scored.select("row.*", F.struct("log_weight", "key", kept.alias("kept")).alias("quality"))

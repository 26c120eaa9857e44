"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The white space that separates words: blank and 0x09 to 0x0D, nothing else.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a session without one (a test) gets its own."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="trafficloom-llm-"))
    return context.getCheckpointDir().rstrip("/")


def saved(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read it again: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_hot(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join whose sides both get an exchange of their own, also where one of them comes from
    an aggregate: only then can adaptive execution split a key with a large share of the rows.
    The key columns of the left side stay."""
    mine = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = [left[k].eqNullSafe(mine[f"__{k}"]) for k in keys]
    condition = on[0]
    for c in on[1:]:
        condition = condition & c
    return left.join(mine, condition, how).drop(*(f"__{k}" for k in keys))


def numbers_of_equals(rows: DataFrame, keys: list[str], place: str) -> DataFrame:
    """place and number (0, 1, …) of the rows whose keys occur more than once. place is a stored
    monotonically_increasing_id(): each task's rows are counted by themselves and follow those of
    the tasks before it, so no group of equals meets in one task."""
    narrow = rows.select(*keys, F.col(place).alias("__place"), F.shiftright(place, 33).alias("__task"))
    often = narrow.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).filter("__rows > 1").drop("__rows")
    equal = join_hot(narrow, often, keys, "left_semi")
    tasks = Window.partitionBy(*keys).orderBy("__task")
    before = equal.groupBy(*keys, "__task").agg(F.count(F.lit(1)).alias("__own"))
    before = before.select(*keys, "__task", (F.sum("__own").over(tasks) - F.col("__own")).alias("__before"))
    own = F.row_number().over(Window.partitionBy(*keys, "__task").orderBy("__place")) - 1
    counted = join_hot(equal.withColumn("__at", own), before, [*keys, "__task"])
    return counted.select(F.col("__place").alias(place), (F.col("__before") + F.col("__at")).alias("number"))


def uniform(*parts: Column | str) -> Column:
    """A number in (0, 1) that depends on the parts alone, so reruns agree."""
    bits = F.shiftrightunsigned(F.xxhash64(*parts), 11)
    return (bits.cast("double") + 0.5) / F.lit(float(2**53))


def in_small_batches(df: DataFrame, rows: int = 1000, size: int | None = None) -> DataFrame:
    """df, whose rows reach Python in batches of so many rows, and of about so many bytes if a size
    is given."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    if size:
        df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
    return df


_IN_USE: list[dict] = []


def use_cache(*caches: dict) -> None:
    """Say which caches of the Python worker the task at hand uses; those of the operator before it
    are emptied, so a worker that serves many operators holds the caches of one."""
    for old in _IN_USE:
        if not any(old is c for c in caches):
            old.clear()
    _IN_USE[:] = caches


def word_bytes(text: str | None) -> list[bytes]:
    """Words with A-Z lowered. bytes.split() separates at blank and 0x09-0x0D only, bytes.lower()
    changes A-Z only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class WordHashes(dict):
    """64-bit hash of a word, remembered up to a bound."""

    LIMIT = 60_000

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.LIMIT and len(word) <= 64:
            self[word] = value
        return value


#: One per Python worker.
HASHES = WordHashes()
_FACTORS = np.array(
    [xxhash.xxh3_64_intdigest(b"place", seed=i) | 1 for i in range(16)], dtype=np.uint64
)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser over 64 bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; fewer words than the width make one shingle."""
    words = word_bytes(text)
    if not words:
        return np.empty(0, np.uint64)
    hashes = word_hashes(words)
    n = len(words)
    span = min(width, n)
    total = np.full(n - span + 1, span, np.uint64)
    for i in range(span):
        total += hashes[i : n - span + 1 + i] * _FACTORS[i]
    return np.unique(mix64(total))

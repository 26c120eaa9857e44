"""A training corpus from documents: five stages, each over all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet to the
shared folder and gives the next stage what it reads there. All but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficloom.llm import mixing, near_dedup, packing, quality, secret_scan
from trafficloom.llm.common import saved, table
from trafficloom.llm.queries import is_target, is_toxic

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near duplicates share this many hundredths of their shingles.
PERCENT = 80
#: Workers serve all stages, so the word caches of the first one are small here.
REMEMBERED = (60_000, 30_000)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents outside the sample and toxic ones go."""
    labels = table(spark, sf_dir, "labels")
    made = quality.resample(docs, labels, is_target(), carry=COLUMNS, unwanted=is_toxic(), remembered=REMEMBERED)
    return made.filter("quality.kept").select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near duplicates: of each group the document with the smallest id stays; documents without
    words or without id are no one's copies and stay."""
    groups = near_dedup.near_duplicates(docs, percent=PERCENT)
    gone = groups.filter("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    left = docs.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")
    # Rows that repeat an id are one document: the first of them stays.
    again = groups.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    repeated = left.join(again, "doc_id", "left_semi").select(*COLUMNS)
    once = repeated.groupBy("doc_id").agg(F.min(F.struct(*COLUMNS[1:])).alias("r")).select("doc_id", "r.*")
    return left.join(again, "doc_id", "left_anti").select(*COLUMNS).unionByName(once)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scan: each secret becomes [SECRET]; n_chars follows the text."""
    clean = docs.withColumn("__before", F.col("text"))
    clean = secret_scan.without_secrets(clean)
    n_chars = F.when(~F.col("text").eqNullSafe(F.col("__before")), F.length("text").cast("long"))
    return clean.withColumn("n_chars", F.coalesce(n_chars, F.col("n_chars"))).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Source weights: a document is there as often as the mix takes it."""
    made = mixing.mix(docs, carry=COLUMNS)
    copies = F.array_repeat(F.lit(1), F.col("mix.copies"))
    return made.withColumn("__copy", F.explode(copies)).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: the pieces of all sequences with their ids."""
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("quality classifier", keep_good),
    ("near duplicates", keep_one_of_each),
    ("secret scan", hide_secrets),
    ("source weights", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: The classifier, the similarity classes and the packing can't be said in SQL.
ORACLE_SQL = None

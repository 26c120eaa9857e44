"""Chat formatting after cumulative-snapshot collapse.

Logs often hold a conversation again and again, each time with one more turn. A rolling hash over
the turns gives every prefix of a conversation a fingerprint; a conversation whose whole
fingerprint is that of a longer one's prefix is a snapshot of it and goes. What remains is
rendered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import join_hot, saved

#: Turns numbered within so many follow each other in one block of a long conversation.
BLOCK = 1_024
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def numbered(turns: DataFrame) -> DataFrame:
    """conv, place (from 0), role, text. Order: turn number (null last), role, text. Places are
    counted in blocks of turn numbers first, so a conversation of any length is never sorted in
    one task."""
    turns = turns.withColumn("block", F.floor(F.col("turn") / BLOCK))
    before = Window.partitionBy("conv").orderBy(F.asc_nulls_last("block"))
    blocks = turns.groupBy("conv", "block").agg(F.count(F.lit(1)).alias("n"))
    blocks = blocks.select("conv", "block", (F.sum("n").over(before) - F.col("n")).alias("base"))
    own = Window.partitionBy("conv", "block").orderBy(
        F.asc_nulls_last("turn"), F.asc_nulls_last("role"), F.asc_nulls_last("text")
    )
    turns = turns.withColumn("own", F.row_number().over(own) - 1)
    turns = join_hot(turns, blocks, ["conv", "block"])
    return turns.select("conv", "block", (F.col("base") + F.col("own")).alias("place"), "role", "text")


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv, place and the 128-bit fingerprint (a, b) of the turns up to there: an exclusive or of
    hashes that know their place, rolled along each block and on from the blocks before."""
    a = F.xxhash64(F.lit("a"), "place", F.isnull("role"), "role", F.isnull("text"), "text")
    b = F.xxhash64(F.isnull("text"), "text", F.isnull("role"), "role", "place", F.lit("b"))
    turns = turns.select("conv", "block", "place", a.alias("a"), b.alias("b"))
    rolled = Window.partitionBy("conv").orderBy(F.asc_nulls_last("block"))
    blocks = turns.groupBy("conv", "block").agg(F.bit_xor("a").alias("ha"), F.bit_xor("b").alias("hb"))
    blocks = blocks.select(
        "conv",
        "block",
        F.bit_xor("ha").over(rolled).bitwiseXOR(F.col("ha")).alias("ba"),
        F.bit_xor("hb").over(rolled).bitwiseXOR(F.col("hb")).alias("bb"),
    )
    own = Window.partitionBy("conv", "block").orderBy("place")
    turns = turns.withColumns({"a": F.bit_xor("a").over(own), "b": F.bit_xor("b").over(own)})
    turns = join_hot(turns, blocks, ["conv", "block"])
    return turns.select(
        "conv", "place", F.col("a").bitwiseXOR(F.col("ba")).alias("a"), F.col("b").bitwiseXOR(F.col("bb")).alias("b")
    )


def maximal(turns: DataFrame) -> DataFrame:
    """conv and n of the conversations that are no snapshot of a longer one; of equal ones that
    with the smallest id. turns: as numbered() gives them."""
    hashes = saved(prefix_hashes(turns))
    sizes = hashes.groupBy("conv").agg((F.max("place") + 1).alias("n"))
    whole = join_hot(hashes, sizes, ["conv"]).withColumn("last", F.col("place") == F.col("n") - 1)
    whole = saved(whole)
    ends = whole.filter("last").groupBy("a", "b", "n").agg(F.min("conv").alias("conv"))
    # Places count from the start, so equal fingerprints are at equal places.
    inner = whole.filter("not last").select("a", "b").distinct()
    return join_hot(ends, inner, ["a", "b"], "left_anti").select("conv", "n")


def collapse_and_render(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """conv_id, n_turns and text: each maximal conversation in chat format.

    Turns go by number (null last), those with equal numbers by role and text. Rows without
    conversation id belong to none and are left out. A null role renders as an empty one, a null
    text as an empty text; both still differ from empty ones when conversations are compared.
    Repeated rows are repeated turns. An empty table gives no rows; other columns are not read.
    """
    turns = conversations.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.col(role_col).alias("role"),
        F.col(text_col).alias("text"),
    )
    turns = saved(numbered(turns))
    kept = join_hot(turns, maximal(turns), ["conv"])
    line = F.concat(
        F.lit(OPEN), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(CLOSE + "\n")
    )
    rendered = kept.groupBy("conv", "n").agg(
        F.sort_array(F.collect_list(F.struct("place", line.alias("line")))).alias("lines")
    )
    return rendered.select(
        F.col("conv").alias("conv_id"),
        F.col("n").alias("n_turns"),
        F.array_join(F.transform("lines", lambda x: x["line"]), "").alias("text"),
    )

"""Conversations that were logged again and again as they grew.

Every turn gets a hash of the conversation up to it. A conversation whose last such hash
is also that of an earlier turn of another one is a snapshot of that longer conversation,
and goes; of conversations that are equal, the smallest id stays. What stays is rendered
turn by turn.

The hash of a prefix is the exclusive or of the hashes of its turns, each taken with its
position, so it is a running aggregate that can be added up in pieces: a conversation of
any length is cut into pieces of turns, and no task has to hold it whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import saved

TURNS_PER_PIECE = 4096
TEMPLATE = ("<|", "|>\n", "<|end|>\n")
"""What stands before the role, after it and after the text of a turn."""
HASHES = ["h0", "h1"]


def numbered(turns: DataFrame) -> DataFrame:
    """``turns`` with ``place``: the number of turns before in the conversation, by ``turn``,
    null first, then role and text."""
    piece = F.coalesce(F.expr(f"turn div {TURNS_PER_PIECE}"), F.lit(-(1 << 62)))
    rows = turns.withColumn("piece", piece)
    sizes = rows.groupBy("conv_id", "piece").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        F.col("conv_id").alias("_conv"),
        F.col("piece").alias("_piece"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"),
    )
    inside = Window.partitionBy("conv_id", "piece").orderBy("turn", "role", "text")
    rows = rows.withColumn("_nth", F.row_number().over(inside) - 1)
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("piece") == F.col("_piece"))
    rows = rows.join(sizes, same)
    return rows.withColumn("place", F.col("_base") + F.col("_nth")).drop(
        "_conv", "_piece", "_base", "_nth"
    )


def with_prefix_hashes(rows: DataFrame) -> DataFrame:
    """Adds ``h0`` and ``h1``, a 128-bit hash of all turns up to this one."""
    for k, name in enumerate(HASHES):
        own = F.xxhash64(F.lit(k), "place", F.col("role").isNull(), "role", F.col("text").isNull(), "text")
        rows = rows.withColumn(name, own)
    sums = rows.groupBy("conv_id", "piece").agg(*[F.bit_xor(h).alias(h) for h in HASHES])
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("conv_id").alias("_conv"),
        F.col("piece").alias("_piece"),
        *[F.coalesce(F.bit_xor(h).over(before), F.lit(0)).alias(f"_{h}") for h in HASHES],
    )
    upto = (
        Window.partitionBy("conv_id", "piece")
        .orderBy("place")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = rows.withColumns({h: F.bit_xor(h).over(upto) for h in HASHES})
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("piece") == F.col("_piece"))
    rows = rows.join(sums, same)
    rows = rows.withColumns({h: F.col(h).bitwiseXOR(F.col(f"_{h}")) for h in HASHES})
    return rows.drop("_conv", "_piece", *[f"_{h}" for h in HASHES])


def maximal(prefixes: DataFrame) -> DataFrame:
    """``(conv_id)`` of the conversations to keep, from ``(conv_id, place, h0, h1)`` per turn."""
    last = prefixes.groupBy("conv_id").agg(F.max_by(F.struct("place", *HASHES), "place").alias("last"))
    # equal conversations first: copies count as one from here on
    ends = last.groupBy("last").agg(F.min("conv_id").alias("conv_id"))
    ends = saved(ends.select("conv_id", "last.*"), "ends")
    lasts = prefixes.join(
        last.select(F.col("conv_id").alias("_conv"), F.col("last.place").alias("_last")),
        F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("place") == F.col("_last")),
        "left_anti",
    )
    inner = lasts.select("place", *HASHES).distinct()
    return ends.join(inner, ["place", *HASHES], "left_anti").select("conv_id")


def rendered(role: Column, text: Column, template: tuple[str, str, str] = TEMPLATE) -> Column:
    before, after, end = (F.lit(x) for x in template)
    none = F.lit("")
    return F.concat(before, F.coalesce(role, none), after, F.coalesce(text, none), end)


def collapsed(conversations: DataFrame, template: tuple[str, str, str] = TEMPLATE) -> DataFrame:
    """``(conv_id, place, role, rendered)``: the turns of the conversations that are kept.

    Turns are ordered by ``turn``, null first, ties by role, then text; rows that repeat in
    all four columns count once. Null and empty roles and texts differ, and are rendered
    alike. Rows with a null ``conv_id`` belong to no conversation and are left out. Other
    columns play no part. Joined in the order of ``place``, the turns are the conversation.
    """
    turns = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    turns = turns.where("conv_id IS NOT NULL").distinct()
    rows = saved(with_prefix_hashes(numbered(turns)), "turns")
    kept = maximal(rows.select("conv_id", "place", *HASHES)).withColumnRenamed("conv_id", "_conv")
    rows = rows.join(kept, F.col("conv_id") == F.col("_conv"), "left_semi")
    return rows.select(
        "conv_id", "place", "role", rendered(F.col("role"), F.col("text"), template).alias("rendered")
    )

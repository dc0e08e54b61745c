"""A uniform shuffle of rows into shards of exact sizes.

Rows are dealt from partitions to shards as in a parallel shuffle on distributed memory:
a matrix of counts, how many rows of each partition go to each shard, is drawn first from
the distribution that a uniform shuffle of all rows gives it, a multivariate hypergeometric
one; then each partition permutes its rows and deals them out by its line of the matrix;
the rows are exchanged; then each shard permutes what it got.

The matrix is drawn by halving: what the shards hold in all is split between the two halves
of the partitions, and so on down to single partitions, a few levels at a time and all groups
of partitions of a level side by side. The permutations are pseudorandom ones of row numbers,
so a row's shard and slot are known before it moves, and one exchange brings it to its place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import given, if_small, saved
from daybook.llm.draws import permuted, split_counts

LEVELS_PER_EXCHANGE = 6
GROUPS_PER_TASK = 16
BROADCAST_LINES = 20_000
"""Lines of the matrix that are broadcast at most."""
ROWS_PER_PIECE = 100_000
"""How many rows one task of the exchange takes; a shard of more is cut into ranges of slots."""


def shard_size(shard: Column, total: int, shards: int) -> Column:
    return F.lit(total // shards).cast("long") + (shard < total % shards).cast("long")


def communication_matrix(counts: DataFrame, partitions: int, total: int, shards: int, seed: int) -> DataFrame:
    """``(part, takes, before)``: for each partition how many rows go to each shard, and how
    many the partitions before it send there.

    ``counts (part, n)`` has the partitions' rows; ``partitions`` is a power of two. Row sums
    are the partitions' counts, column sums the shards' sizes, at most one apart.
    """
    numbers = F.sequence(F.lit(0), F.lit(shards - 1))
    tree = counts.sparkSession.range(1).select(
        F.col("id").alias("part"),
        F.transform(numbers, lambda j: shard_size(j, total, shards)).alias("takes"),
        F.transform(numbers, lambda j: F.lit(0).cast("long")).alias("before"),
    )
    levels = partitions.bit_length() - 1
    for level in range(0, levels, LEVELS_PER_EXCHANGE):
        width, deep = partitions >> level, min(LEVELS_PER_EXCHANGE, levels - level)
        tree = tree.join(_group_rows(counts, width, deep), F.col("part") == F.col("of"), "left")
        found = F.transform(
            F.sequence(F.lit(0), F.lit((1 << deep) - 1)),
            lambda i: F.coalesce(F.element_at("held", i.cast("long")), F.lit(0).cast("long")),
        )
        tree = tree.select("part", found.alias("rows"), "takes", "before")
        for step in range(deep):
            tree = _halved(tree, width >> (step + 1), 1 << (deep - step - 1), f"{seed}, {level + step}, part")
        tree = tree.drop("rows").repartition(max(1, (1 << (level + deep)) // GROUPS_PER_TASK), "part")
    return tree.select("part", "takes", "before")


def _group_rows(counts: DataFrame, width: int, deep: int) -> DataFrame:
    """For groups of ``width`` partitions, named by the first, the rows of each of their
    ``2 ** deep`` equal parts, as a map from the part's number."""
    start = F.col("part") - F.col("part") % width
    number = F.expr(f"(part % {width}) div {width >> deep}")
    sums = counts.groupBy(start.alias("of"), number.alias("at")).agg(F.sum("n").alias("n"))
    return sums.groupBy("of").agg(F.map_from_entries(F.collect_list(F.struct("at", "n"))).alias("held"))


def _halved(tree: DataFrame, half: int, inside: int, key: str) -> DataFrame:
    """Each group of partitions as its first and its second ``half`` of them: ``rows`` has the
    rows of ``2 * inside`` parts, ``takes`` what all of them send to each shard."""
    tree = tree.select(
        "part",
        "takes",
        "before",
        F.slice("rows", 1, inside).alias("first"),
        F.slice("rows", inside + 1, inside).alias("rest"),
    ).withColumn("n", F.aggregate("first", F.lit(0).cast("long"), lambda a, x: a + x))
    tree = tree.withColumn("left", F.expr(split_counts("takes", "n", key)))
    kids = F.array(
        F.struct("part", F.col("first").alias("rows"), F.col("left").alias("takes"), "before"),
        F.struct(
            (F.col("part") + half).alias("part"),
            F.col("rest").alias("rows"),
            F.zip_with("takes", "left", lambda a, b: a - b).alias("takes"),
            F.zip_with("before", "left", lambda a, b: a + b).alias("before"),
        ),
    )
    return tree.select(F.inline(kids))


def shuffled_into_shards(
    rows: DataFrame, shards: int = 16, seed: int = 8, rows_per_piece: int = ROWS_PER_PIECE
) -> DataFrame:
    """``rows`` with ``shard`` (0 to ``shards`` - 1) and ``slot``, gapless from 0 in each shard.

    Rows come back where they belong: a partition holds one range of slots of one shard, of
    ``rows_per_piece`` rows or fewer, in their order, so what is written of it is the shards'
    shuffled files.

    Rows are told apart by where they lie, so nulls, ties, very long texts and rows that repeat
    need no rule; the same files in the same partitions give the same result, other partitions
    another one. They are numbered once and saved, so that a later retry cannot number them
    anew. All rows come back, with all their columns; own ``shard`` and ``slot`` columns are
    replaced. An empty table stays empty.
    """
    numbered = saved(given(rows, ["shard", "slot"], at=F.monotonically_increasing_id()), "numbered")
    place = numbered.select("given", F.expr("at >> 33").alias("own"), F.expr("at & 8589934591").alias("nth"))
    counts = saved(place.groupBy(F.col("own").alias("part")).agg(F.count("*").alias("n")), "counts")
    found = counts.agg(F.sum("n").alias("rows"), F.max("part").alias("last")).first()
    total, last = found["rows"] or 0, found["last"] or 0
    matrix = communication_matrix(counts, 1 << last.bit_length(), total, shards, seed)
    upto = F.transform(
        F.sequence(F.lit(1), F.lit(shards)),
        lambda j: F.aggregate(F.slice("takes", 1, j), F.lit(0).cast("long"), lambda a, x: a + x),
    )
    matrix = saved(matrix.select("part", "takes", "before", upto.alias("upto")), "matrix")
    dealt = place.join(if_small(matrix, BROADCAST_LINES), F.col("own") == F.col("part"))
    dealt = dealt.withColumn("n", F.element_at("upto", -1))
    dealt = dealt.withColumn("nth", permuted("nth", "n", f"{seed}, 'partition', own"))
    dealt = dealt.withColumn("shard", F.size(F.filter("upto", lambda edge: edge <= F.col("nth"))))
    # its number in the shard: after all that partitions before send there
    dealt = dealt.select(
        "given",
        "shard",
        (F.get("before", "shard") + F.col("nth") - F.get("upto", "shard") + F.get("takes", "shard")).alias("nth"),
        shard_size(F.col("shard"), total, shards).alias("n"),
    )
    dealt = dealt.withColumn("slot", permuted("nth", "n", f"{seed}, 'shard', shard"))
    pieces = max(1, -(-total // (shards * rows_per_piece)))
    piece = F.expr(f"CAST(shard * {pieces} + (slot * {pieces}) div n AS INT)")
    moved = dealt.select("given", "shard", "slot", piece.alias("piece")).repartitionById(shards * pieces, "piece")
    return moved.sortWithinPartitions("shard", "slot").select("given.*", "shard", "slot")

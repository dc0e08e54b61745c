"""Mixing sources to target weights, in blocks of tokens.

The documents of a source, in a random order, make one stream of words, which is cut into
blocks of a fixed number of words. The mix is a number of slots, dealt over output shards;
for each shard, how many slots each source gets is drawn. A source's slots are numbered
through; a pseudorandom permutation of the source's block numbers, another one for every
pass over the source, says which block a slot takes, and one of the shard's slots where in
the shard it lies. The blocks are pieces of documents, ranges of their words.

The stage of the pipeline needs documents, not blocks: a document comes as often as its words
in the drawn blocks fill it, what is left over being evened out among a source's documents.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import given, if_small, row_hashes, saved, slice_bits, unit, with_running_total
from daybook.llm.draws import permuted

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MOST_PASSES = 3
BLOCK_WORDS = 32
SHARDS = 8
SLOTS_PER_ROW = 10_000
"""Slots that one row is spread into, which bounds the arrays."""
SLOTS_PER_TASK = 100_000
NEAR_BLOCKS = 4
NEAR_SHARE = 0.05
"""How far a source may be from its draw, the larger of so many blocks and such a share of its
target, so that documents stay whole; where that is not enough, one document is cut."""


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, passes: int = MOST_PASSES) -> DataFrame:
    """``(source, number, source_size, target)`` from one row ``(source, source_size)`` per source.

    Sources, by code point and null last, weigh ``weights``, repeating, and share all of the
    words by weight. A target stops at ``passes`` times its source's size and the excess goes
    to the others by weight, until none is above: the sources are full in the order of that
    bound against their weight, so the level at which the rest share is found by running sums.
    """
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    number = F.row_number().over(rank) - 1
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (number % len(weights) + 1).cast("int")
    )
    rows = sizes.select("source", "source_size", number.alias("number"), weight.alias("weight"))
    rows = rows.withColumn("most", F.col("source_size") * float(passes))
    rows = rows.withColumn("full_at", F.col("most") / F.col("weight"))
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("full_at", "number").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns(
        {
            "words": F.sum("source_size").over(whole).cast("double"),
            "filled": F.coalesce(F.sum("most").over(before), F.lit(0.0)),
            "open": F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        }
    )
    # the level if this source and all that fill later are not full
    level = (F.col("words") - F.col("filled")) / F.col("open")
    rows = rows.withColumn("level", level)
    place = F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "number"))
    rows = rows.withColumn("level", F.min_by("level", place).over(whole))
    target = F.least(F.col("most"), F.coalesce(F.col("level"), F.lit(0.0)) * F.col("weight"))
    return rows.select("source", "number", "source_size", target.alias("target"))


def in_streams(rows: DataFrame) -> DataFrame:
    """Adds ``start``: the words before the document in its source's stream."""
    bits = slice_bits(rows.count())
    ties = ["doc_id", "size"]
    return with_running_total(rows, ["number"], "order", ties, F.col("size"), bits, "start")


def packed(rows: DataFrame, block_words: int) -> DataFrame:
    """``(number, start, block, first, words)``: which words of which block each document
    fills, and the number of the first of them in the document."""
    blocks = F.expr(f"sequence(start div {block_words}, (start + size - 1) div {block_words})")
    cut = rows.where("size > 0").select("number", "start", "size", F.explode(blocks).alias("block"))
    low = F.greatest("start", F.col("block") * block_words)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    return cut.select("number", "start", "block", (low - F.col("start")).alias("first"), (high - low).alias("words"))


def drawn_sources(shares: DataFrame, seed: int) -> DataFrame:
    """``(shard, hit, more)``: a multinomial draw by the ``part`` of each source, of as many
    slots per shard as the parts add up to. A draw is a point on the shard's line of parts and
    hits the first source whose running sum ``upto`` lies beyond it."""
    left = shares.groupBy("shard").agg(F.sum("part").alias("parts"))
    numbers = F.expr("explode(sequence(0L, CAST(round(parts) AS BIGINT)))").alias("draw")
    draws = left.select("shard", "parts", numbers).where("draw > 0")
    at = unit(F.xxhash64(F.lit(seed), F.lit("draw"), "shard", "draw")) * F.col("parts")
    points = draws.select("shard", at.alias("at"), F.lit(None).cast("int").alias("number")).union(
        shares.where("part > 0").select("shard", "upto", "number")
    )
    backward = (
        Window.partitionBy("shard")
        .orderBy(F.col("at").desc(), F.col("number").desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    hits = points.withColumn("hit", F.last("number", ignorenulls=True).over(backward))
    hits = hits.where("number IS NULL AND hit IS NOT NULL")
    return hits.groupBy("shard", "hit").agg(F.count("*").alias("more"))


def slots(targets: DataFrame, block_words: int, shards: int, seed: int, passes: int = MOST_PASSES) -> DataFrame:
    """``(shard, slot, number, pass, block)``, a row per slot of the mix.

    A shard's counts are the whole parts of its expected counts and, for the slots that are
    left, a multinomial draw by the fractions, so each source ends close to its target. Slots
    past ``passes`` passes over a source, which only a draw just above a full target gives,
    stay empty.
    """
    rows = targets.where("source_size > 0 AND target > 0").select(
        "number", F.ceil(F.col("source_size") / float(block_words)).cast("long").alias("blocks"),
        (F.col("target") / F.col("source_size")).alias("turns"),
    )
    rows = rows.withColumn("want", F.col("turns") * F.col("blocks") / float(shards))
    rows = rows.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        "number",
        "blocks",
        "want",
        F.floor("want").cast("long").alias("sure"),
        (F.col("want") - F.floor("want")).alias("part"),
    )
    upto = Window.partitionBy("shard").orderBy("number")
    rows = rows.withColumn("upto", F.sum("part").over(upto))
    rows = saved(rows, "shares")
    hits = drawn_sources(rows, seed)
    hits = hits.select(F.col("shard").alias("_shard"), F.col("hit").alias("_hit"), "more")
    counts = rows.join(hits, [rows["shard"] == hits["_shard"], rows["number"] == hits["_hit"]], "left")
    counts = counts.select(
        "shard", "number", "blocks", (F.col("sure") + F.coalesce("more", F.lit(0))).alias("n")
    )
    before = Window.partitionBy("number").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long"))
    others = Window.partitionBy("shard")
    ahead = others.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumns(
        {
            "ahead": F.coalesce(F.sum("n").over(ahead), F.lit(0)).cast("long"),
            "all": F.sum("n").over(others),
        }
    )
    runs = counts.where("n > 0").select(
        "shard", "number", "blocks", "n", "first", "ahead", "all",
        F.explode(F.expr(f"sequence(0L, (n - 1) div {SLOTS_PER_ROW})")).alias("run"),
    )
    # few bytes that become many rows: the number of tasks follows the rows
    total = rows.agg(F.sum("want")).first()[0] or 0.0
    runs = runs.repartition(math.ceil(total / SLOTS_PER_TASK) or 1, "shard", "number", "run")
    low = F.col("first") + F.col("run") * SLOTS_PER_ROW
    high = F.least(low + SLOTS_PER_ROW, F.col("first") + F.col("n")) - 1
    out = runs.select(
        "shard", "number", "blocks", "first", "ahead", "all", F.explode(F.sequence(low, high)).alias("own")
    )
    out = out.select(
        "shard", "number", "blocks", "all", F.expr("ahead + own - first").alias("at"),
        F.expr("own div blocks").alias("pass"), F.expr("own % blocks").alias("nth"),
    ).where(F.col("pass") < passes)
    block = permuted("nth", "blocks", f"{seed}, number, pass")
    slot = permuted("at", "all", f"{seed}, 'slot', shard")
    return out.select("shard", slot.alias("slot"), "number", "pass", block.alias("block"))


def streams_and_targets(
    documents: DataFrame, weights: tuple[float, ...], passes: int, seed: int
) -> tuple[DataFrame, DataFrame]:
    """``documents (doc_id, source, text)`` with their ``size``, ``order`` and ``start`` in
    their source's stream and its ``number`` and target, and the targets."""
    rows = documents.select(
        "doc_id",
        "source",
        word_count("text").alias("size"),
        F.xxhash64(F.lit(seed), "doc_id").alias("order"),
    )
    rows = saved(rows, "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = saved(source_targets(sizes, weights, passes), "targets")
    named = targets.withColumnRenamed("source", "_source")
    rows = rows.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    return saved(in_streams(rows), "streams"), targets


def drawn_pieces(
    streams: DataFrame, targets: DataFrame, block_words: int, shards: int, seed: int, passes: int
) -> DataFrame:
    """``(shard, slot, number, start, first, words)``: the blocks of the mix, a row per piece
    of a document in the block of a slot; pieces of a block follow each other by ``start``."""
    # a table of known size, or the join would be planned by the size of what the rows come from
    drawn = slots(targets, block_words, shards, seed, passes).select(
        "shard", "slot", F.col("number").alias("_number"), F.col("block").alias("_block")
    )
    drawn = saved(drawn, "draws")
    same = [F.col("number") == F.col("_number"), F.col("block") == F.col("_block")]
    pieces = packed(streams, block_words).join(drawn, same)
    return pieces.select("shard", "slot", "number", "start", "first", "words")


def with_taken(streams: DataFrame, pieces: DataFrame) -> DataFrame:
    """Adds the words that the drawn ``pieces`` hold of a document, and how often its first."""
    taken = pieces.groupBy(F.col("number").alias("_number"), F.col("start").alias("_start")).agg(
        F.sum("words").alias("taken"), F.count_if(F.col("first") == 0).alias("copies")
    )
    same = [F.col("number") == F.col("_number"), F.col("start") == F.col("_start"), F.col("size") > 0]
    found = streams.join(taken, same, "left").drop("_number", "_start")
    return found.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("taken", "copies")})


def mixed_blocks(
    documents: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    passes: int = MOST_PASSES,
    block_words: int = BLOCK_WORDS,
    shards: int = SHARDS,
    seed: int = 10,
) -> DataFrame:
    """``(shard, slot, source, start, doc_id, first, words, text)``: the mix itself.

    A row is the ``words`` words from number ``first`` of a document, joined by blanks, that
    stand in the block of that slot of that shard; a block's pieces are in the order of
    ``start``. All blocks but a source's last have ``block_words`` words.
    """
    key = F.struct(*[h.alias(n) for h, n in zip(row_hashes(documents), "ab", strict=True)])
    rows = documents.select(key.alias("doc_id"), "source", "text")
    streams, targets = streams_and_targets(rows, weights, passes, seed)
    pieces = drawn_pieces(streams, targets, block_words, shards, seed, passes)
    ranges = F.collect_list(F.struct("shard", "slot", "first", "words")).alias("ranges")
    ranges = pieces.groupBy(F.col("number").alias("_number"), F.col("start").alias("_start")).agg(ranges)
    same = [F.col("number") == F.col("_number"), F.col("start") == F.col("_start"), F.col("size") > 0]
    taken = streams.join(ranges, same).select(F.col("doc_id").alias("of"), "source", "start", "ranges")
    # rows alike in everything have one text
    texts = documents.select("doc_id", "text", key.alias("key")).dropDuplicates(["key"])
    texts = texts.select("doc_id", "key", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("tokens"))
    words = lambda r: F.slice("tokens", r["first"].cast("int") + 1, r["words"].cast("int"))
    with_text = F.transform("ranges", lambda r: r.withField("text", F.array_join(words(r), " ")))
    out = taken.join(texts, F.col("of") == F.col("key"))
    out = out.select("source", "start", "doc_id", F.explode(with_text).alias("piece"))
    return out.select(
        "piece.shard", "piece.slot", "source", "start", "doc_id", "piece.first", "piece.words", "piece.text"
    )


def mixed(
    documents: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    passes: int = MOST_PASSES,
    block_words: int = BLOCK_WORDS,
    shards: int = SHARDS,
    seed: int = 10,
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken, copies)``, a row per document.

    ``size`` is its number of words, ``taken`` the words the mix takes of it, at most
    ``passes`` times as many, and ``copies`` how often it takes the first word. Null and empty
    texts have size 0 and give nothing; a null source is a source, the last one; rows that
    repeat count each; other columns play no part.
    """
    rows, targets = streams_and_targets(documents, weights, passes, seed)
    taken = with_taken(rows, drawn_pieces(rows, targets, block_words, shards, seed, passes))
    return taken.select("doc_id", "source", "size", "source_size", "target", "taken", "copies")


def rounded(rows: DataFrame) -> DataFrame:
    """Adds ``once``, 0 or 1 for each of ``rows (doc_id, number, size, order, rest)``.

    Of the documents of a source, in the order of their sizes, those are 1 at which the running
    sum of ``rest / size``, kept in whole 2^-32ths, passes the next whole number and a half. So
    it is 1 with the chance ``rest / size``, and by the order the words of a source's ones differ
    from its rests by no more than the size of its largest document here.
    """
    rows = rows.withColumn("part", F.expr("shiftleft(rest, 32) div size"))
    sums = saved(rows.groupBy("number", "size").agg(F.sum("part").alias("part"), F.count("*").alias("n")), "sizes")
    smaller = Window.partitionBy("number").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("part").over(smaller), F.lit(0)) + F.lit(1 << 31)
    bases = saved(sums.select(F.col("number").alias("_number"), F.col("size").alias("_size"), base.alias("base")), "bases")
    bits = slice_bits(sums.agg(F.max("n")).first()[0] or 0)
    rows = with_running_total(rows, ["number", "size"], "order", ["doc_id"], F.col("part"), bits, "inside")
    rows = rows.join(if_small(bases), (F.col("number") == F.col("_number")) & (F.col("size") == F.col("_size")))
    upto = F.col("base") + F.col("inside")
    once = F.shiftright(upto + F.col("part"), 32) - F.shiftright(upto, 32)
    return rows.withColumn("once", once).drop("part", "inside", "base", "_number", "_size")


def drawn_documents(taken: DataFrame, block_words: int) -> DataFrame:
    """``(doc_id, rows, copies, cut)``: what the blocks that were drawn make of the documents,
    from ``taken``, the streams with the words that the mix takes of each row.

    Rows alike in everything stand together, ``rows`` of them. They come whole as often as their
    words in the drawn blocks fill them, and what is left over of a document, its rest, makes it
    come once more or not, by ``rounded``. Where the words of a source are then further from its
    draw than it may be, one document makes up for it: the largest of those that come once more
    comes with the first ``cut`` words instead, or the largest of those that do not with ``cut``.
    It is never shorter than that, by the order of the sizes.
    """
    kinds = taken.where("taken > 0").groupBy("doc_id", "number", "order", "size", "target").agg(
        F.sum("taken").alias("taken"), F.count("*").alias("rows")
    )
    near = F.greatest(F.lit(float(NEAR_BLOCKS * block_words)), F.col("target") * NEAR_SHARE)
    kinds = kinds.withColumns({"whole": F.expr("taken div size"), "rest": F.col("taken") % F.col("size"), "near": near})
    kinds = saved(kinds, "kinds")
    full = kinds.where("rest = 0").select("doc_id", "rows", F.col("whole").alias("copies"), F.lit(0).cast("long").alias("cut"))
    parts = saved(rounded(kinds.where("rest > 0")), "parts")
    off = F.sum(F.col("once") * F.col("size") - F.col("rest")).alias("off")
    off = parts.groupBy(F.col("number").alias("_number")).agg(off, F.max("near").alias("_near"))
    off = saved(off.where("abs(off) > _near"), "off")
    others = parts.join(if_small(off), F.col("number") == F.col("_number"))
    others = others.where((F.col("once") == 1) == (F.col("off") > 0))
    last = F.max_by("doc_id", F.struct("size", "order", "doc_id")).alias("last")
    ends = saved(others.groupBy("_number").agg(last, F.max("off").alias("off")).drop("_number"), "ends")
    parts = parts.join(if_small(ends), F.col("doc_id") == F.col("last"), "left")
    once = F.when(F.col("off").isNull(), F.col("once")).otherwise(0)
    cut = F.when(F.col("off") > 0, F.greatest(F.col("size") - F.col("off"), F.lit(0)))
    cut = cut.when(F.col("off") < 0, F.least(-F.col("off"), "size")).otherwise(0)
    parts = parts.select("doc_id", "rows", (F.col("whole") + once).alias("copies"), cut.cast("long").alias("cut"))
    return saved(full.union(parts).where("copies > 0 OR cut > 0"), "copies")


def first_words(text: Column, n: Column) -> Column:
    """``text`` up to the end of its word number ``n``."""
    blanks_and_word = F.regexp_extract_all(text, F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    return F.array_join(F.slice(blanks_and_word, F.lit(1), n.cast("int")), "")


def mixed_documents(
    documents: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    passes: int = MOST_PASSES,
    block_words: int = BLOCK_WORDS,
    shards: int = SHARDS,
    seed: int = 10,
) -> DataFrame:
    """``documents`` as the mix takes them, from none to ``passes`` times each.

    The blocks are drawn as for ``mixed``, and a document comes as often as its words in them
    fill it, what is left over being evened out among the documents of a source. At most one of
    a source comes cut, with its first words and its other columns unchanged, and only if the
    source would else be further from its draw than ``NEAR_BLOCKS`` blocks and ``NEAR_SHARE`` of
    its target. A text without words is in no block and goes.
    """
    first, second = row_hashes(documents)
    row = F.struct(first.alias("a"), second.alias("b"))
    rows = given(documents, doc_id=row, source=F.col("source"), text=F.col("text"))
    streams, targets = streams_and_targets(rows, weights, passes, seed)
    taken = with_taken(streams, drawn_pieces(streams, targets, block_words, shards, seed, passes))
    drawn = drawn_documents(taken, block_words).withColumnRenamed("doc_id", "of")
    found = rows.select("given", "doc_id").join(if_small(drawn), F.col("doc_id") == F.col("of"))
    part = F.col("given").withField("text", first_words(F.col("given.text"), F.col("cut")))
    none = F.expr("CAST(array() AS array<bigint>)")
    times = F.when(F.col("copies") >= F.col("rows"), F.expr("sequence(1L, copies div rows)")).otherwise(none)
    cuts = F.when((F.col("rows") == 1) & (F.col("cut") > 0), F.expr("array(0L)")).otherwise(none)
    out = found.select("given", "cut", F.explode(F.concat(times, cuts)).alias("time"))
    out = out.select(F.when(F.col("time") == 0, part).otherwise(F.col("given")).alias("given")).select("given.*")
    # of rows alike, one stands for what does not go evenly into them
    alike = drawn.where("rows > 1 AND (copies % rows > 0 OR cut > 0)")
    if alike.limit(1).count():
        of_one = rows.select("given", "doc_id").join(if_small(alike), F.col("doc_id") == F.col("of"))
        of_one = of_one.dropDuplicates(["doc_id"])
        copies = F.concat(
            F.array_repeat("given", F.expr("CAST(copies % rows AS INT)")),
            F.when(F.col("cut") > 0, F.array(part)).otherwise(F.array()),
        )
        out = out.union(of_one.select(F.explode(copies).alias("given")).select("given.*"))
    return out

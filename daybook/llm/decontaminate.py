"""Benchmark passages in training documents, also with words replaced.

Text becomes lower-case runs of letters and digits. Seeds are words at fixed places: a mask
leaves out places in between, so a replaced word there does not hide a passage. Seeds of
all documents are joined with those of the benchmark; where one hits, the item is laid
along the document at that offset and compared word by word.

A document holds an item if, somewhere along it, at least 80 % of ``WINDOW`` consecutive
words of the item (of all its words, if it has fewer) stand at their places. The masks are
chosen so that every such overlap has at least one seed (the tests try all ways), so the
search adds nothing and misses nothing.

Items of fewer than ``LEAST_WORDS`` words also stand in texts that never saw the benchmark.
A document holds such an item only if its whole text is the item, word by word; inside a
longer text they are not looked for, and ``short_items`` names them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import given, saved

MASKS = [(0, 1, 2, 3, 4), (0, 1, 2, 4, 5), (0, 1, 3, 6, 7)]
SPAN = 8
WINDOW = 13
LEAST_WORDS = 8
SIMILARITY = 0.8
BROADCAST_ROWS = 500_000
"""Rows of two or three longs that are broadcast at most; more are joined by a shuffle."""


def words(text: str) -> Column:
    """The array of a text's words, whole; null for a null text."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def if_small(rows: DataFrame) -> DataFrame:
    """``rows``, a saved table, marked for broadcast if it is small."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def mask_hash(mask: int) -> Column:
    """Of the words ``w0``, ``w1`` ... at a position; null where the mask runs past the end."""
    places = MASKS[mask]
    return F.when(
        F.col(f"w{places[-1]}").isNotNull(), F.xxhash64(F.lit(mask), *[F.col(f"w{p}") for p in places])
    )


def positions(rows: DataFrame, tokens: str, keep: list[str]) -> DataFrame:
    """A row per word with its position and the words from it on."""
    shifted = [
        (F.slice(tokens, k + 1, F.greatest(F.size(tokens) - k, F.lit(0))) if k else F.col(tokens))
        for k in range(SPAN)
    ]
    named = F.arrays_zip(*[s.alias(f"w{k}") for k, s in enumerate(shifted)])
    out = rows.select(*keep, F.posexplode(named).alias("pos", "next"))
    return out.select(*keep, "pos", *[F.col("next").getField(f"w{k}").alias(f"w{k}") for k in range(SPAN)])


def seeds_of(rows: DataFrame, keep: list[str]) -> DataFrame:
    """``(keep, pos, seed)``, a row per position and mask."""
    hashes = F.array(*[mask_hash(m) for m in range(len(MASKS))])
    return rows.select(*keep, "pos", F.explode(hashes).alias("seed")).where("seed IS NOT NULL")


def keyed(documents: DataFrame, text: str) -> DataFrame:
    """``(k0, k1, tokens)``: rows by a 128-bit hash of their text, repeated texts once or more."""
    keys = [F.xxhash64(F.lit(k), text).alias(f"k{k}") for k in range(2)]
    return documents.where(F.col(text).isNotNull()).select(*keys, words(text).alias("tokens"))


def item_tokens(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    rows = benchmark.where(F.col(text).isNotNull()).select(
        F.col(item).alias("item_id"), words(text).alias("item_tokens")
    )
    return rows.where(F.size("item_tokens") > 0).distinct()


def short_items(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """``(item_id, words)``: items that are found as whole texts only or, without a word or
    null, not at all."""
    count = F.coalesce(F.size(words(text)), F.lit(0))
    rows = benchmark.select(F.col(item).alias("item_id"), F.when(F.col(text).isNull(), 0).otherwise(count).alias("words"))
    return rows.where(F.col("words") < LEAST_WORDS)


def whole_texts(rows: DataFrame, short: DataFrame) -> DataFrame:
    """``(k0, k1, item_id, start, words, matches)``: the texts that are a short item."""
    brief = rows.where(F.size("tokens").between(1, LEAST_WORDS - 1)).distinct()
    found = brief.join(if_small(short), F.col("tokens") == F.col("item_tokens"))
    size = F.size("item_tokens")
    return found.select("k0", "k1", "item_id", F.lit(0).alias("start"), size.alias("words"), size.alias("matches"))


def leaks(
    documents: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``(k0, k1, item_id, start, words, matches)``: what a text holds of which item.

    ``k0`` and ``k1`` are the text's hashes; ``matches`` of the item's ``words`` words stand
    in the text, whose word number ``start``, maybe negative, is where the item's first one
    is or would be; of several places the one with most matches, then the first.
    """
    items = saved(item_tokens(benchmark, item, item_text), "items")
    short, items = items.where(F.size("item_tokens") < LEAST_WORDS), items.where(F.size("item_tokens") >= LEAST_WORDS)
    grams = saved(positions(items, "item_tokens", ["item_id"]), "grams")
    seeds = saved(
        seeds_of(grams, ["item_id"]).select("seed", "item_id", F.col("pos").alias("at")).distinct(), "seeds"
    )
    starts = saved(grams.where("w1 IS NOT NULL").select(F.xxhash64("w0", "w1").alias("two")).distinct(), "starts")
    rows = keyed(documents, text)
    # all masks begin with two words: positions whose two begin no seed go before any is made
    begun = positions(rows, "tokens", ["k0", "k1"]).withColumn("_two", F.xxhash64("w0", "w1"))
    begun = begun.join(if_small(starts), F.col("_two") == F.col("two"), "left_semi")
    marked = seeds_of(begun, ["k0", "k1"]).withColumnRenamed("seed", "_seed")
    hits = marked.join(if_small(seeds), F.col("_seed") == F.col("seed"))
    hits = hits.select(
        F.col("k0").alias("h0"), F.col("k1").alias("h1"), "item_id", (F.col("pos") - F.col("at")).alias("start")
    )
    hits = saved(hits.distinct(), "hits")
    near = rows.join(if_small(hits), (F.col("k0") == F.col("h0")) & (F.col("k1") == F.col("h1")))
    near = near.join(
        items.select(F.col("item_id").alias("_item"), "item_tokens"), F.col("item_id").eqNullSafe(F.col("_item"))
    )
    same = F.transform(
        "item_tokens",
        lambda w, i: F.coalesce(F.get("tokens", F.col("start") + i) == w, F.lit(False)).cast("int"),
    )
    near = near.select("k0", "k1", "item_id", "start", F.size("item_tokens").alias("words"), same.alias("same"))
    width = F.least(F.lit(WINDOW), F.col("words"))
    add = lambda a, x: a + x
    best = F.array_max(
        F.transform(
            F.sequence(F.lit(1), F.col("words") - width + 1),
            lambda at: F.aggregate(F.slice("same", at, width), F.lit(0), add),
        )
    )
    found = near.withColumn("best", best).where(F.col("best") >= F.ceil(F.lit(SIMILARITY) * width - F.lit(1e-9)))
    found = found.withColumn("matches", F.aggregate("same", F.lit(0), add))
    found = found.select("k0", "k1", "item_id", "start", "words", "matches")
    if short.limit(1).count():
        found = found.union(whole_texts(rows, short))
    first = F.struct("matches", -F.col("start"))
    return found.groupBy("k0", "k1", "item_id").agg(
        F.max_by("start", first).alias("start"),
        F.max("words").alias("words"),
        F.max("matches").alias("matches"),
    )


def leaking_documents(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, item_id, start, words, matches)``, a row per document and item that it holds.

    Null and empty texts hold nothing, and null items are not looked for; rows that repeat
    come once per row. Other columns play no part.
    """
    rows = documents.select(
        F.col(key).alias("doc_id"), *[F.xxhash64(F.lit(k), text).alias(f"_{k}") for k in range(2)]
    )
    found = saved(leaks(documents, benchmark, text), "leaks")
    found = rows.join(if_small(found), (F.col("_0") == F.col("k0")) & (F.col("_1") == F.col("k1")))
    return found.select("doc_id", "item_id", "start", "words", "matches")


def decontaminated(documents: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` without those that hold an item of ``benchmark``; null texts stay."""
    found = saved(leaks(documents, benchmark, text).select("k0", "k1").distinct(), "leaks")
    hashes = {f"h{k}": F.when(F.col(text).isNotNull(), F.xxhash64(F.lit(k), F.col(text))) for k in range(2)}
    same = (F.col("h0") == F.col("k0")) & (F.col("h1") == F.col("k1"))
    return given(documents, **hashes).join(if_small(found), same, "left_anti").select("given.*")

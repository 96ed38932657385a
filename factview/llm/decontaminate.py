"""Benchmark decontamination by SimHash over windows of an item's size.

A window similar to an item shares a shingle with it, so only windows around
shared shingles are fingerprinted. Windows and items meet in blocks of their
fingerprints: within the radius at least one block is equal. Candidates within
the radius are verified by the exact weighted similarity of their shingles,
where a shingle found in several items weighs less.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factview.llm.common import packed, shingle_hashes, small_or_shuffled, stored, text_of, unpacked, words
from factview.llm.simhash import blocks, distance, simhash

SHINGLE = 5
PERCENT = 75
#: Hamming radius. Shingle sets with a similarity of 0.75 differ in 11 of 64 bits on average, 3 more or less.
RADIUS = 19


def _shingles(tokens: Column) -> Column:
    """Hashes of all runs of five words; of fewer words, the whole sequence makes one."""
    short = F.size(tokens).between(1, SHINGLE - 1)
    return F.when(short, F.array(F.xxhash64(F.array_join(tokens, " ")))).otherwise(shingle_hashes(tokens, SHINGLE))


def _items(benchmark: DataFrame) -> DataFrame:
    """item (a digest of id and text), item_id, n (words), h (distinct shingles), w (their weights)."""
    key = F.xxhash64("item_id", text_of()).alias("item")
    rows = benchmark.select(key, "item_id", words(F.lower(text_of())).alias("_words"))
    rows = rows.where(F.size("_words") > 0).withColumn("n", F.size("_words"))
    each = rows.select("item", "item_id", "n", F.explode(F.array_distinct(_shingles(F.col("_words")))).alias("x")).distinct()
    weight = each.groupBy("x").agg((1 / F.count_distinct("item")).alias("w"))
    return each.join(weight, "x").groupBy("item", "item_id", "n").agg(F.collect_list(F.struct("x", "w")).alias("xw")).select(
        "item", "item_id", "n", F.col("xw.x").alias("h"), F.col("xw.w").alias("w")
    )


def doc_key() -> Column:
    """A digest of a document's doc_id and text."""
    return F.xxhash64(F.col("doc_id"), text_of())


def matches(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, radius: int = RADIUS) -> DataFrame:
    """doc_key, doc_id, item_id, similarity, first_word of each document's best window for each item it holds.

    Words are runs of anything but white space, in lower case. An item of fewer
    than five words is one shingle and matches documents of just these words:
    within a longer text so few are no evidence. Null and empty texts match
    nothing. ``doc_key`` is a digest of doc_id and text: repeated rows give one
    result; a null doc_id stays null, and ids may be of any type. Items are
    named by a digest of item_id and text, so one with a null item_id matches
    like others. Other columns are ignored; empty tables give no rows.
    """
    items = stored(_items(benchmark))
    longest = items.agg(F.max("n")).first()[0]
    spark = docs.sparkSession
    if longest is None:
        kinds = {"doc_key": "long", "doc_id": docs.schema["doc_id"].dataType.simpleString(), "item_id": benchmark.schema["item_id"].dataType.simpleString(), "similarity": "double", "first_word": "int"}
        return spark.createDataFrame([], ", ".join(f"{k} {v}" for k, v in kinds.items()))
    rows = docs.select(doc_key().alias("doc_key"), "doc_id", words(F.lower(text_of())).alias("_words"))

    anchors = items.select("n", F.explode("h").alias("x")).distinct()
    shingled = rows.select("doc_key", F.size("_words").alias("n_words"), F.posexplode(_shingles(F.col("_words"))).alias("p", "x"))
    hits = shingled.join(small_or_shuffled(anchors), "x").select("doc_key", "n_words", "n", "p").distinct()
    last = F.greatest(F.col("n_words") - F.col("n"), F.lit(0))
    starts = F.sequence(F.greatest(F.col("p") - F.col("n") + F.least("n", F.lit(SHINGLE)), F.lit(0)), F.least(F.col("p"), last))
    windows = stored(hits.select("doc_key", "n", F.explode(starts).alias("s")).distinct())

    keys = stored(windows.select("doc_key").distinct())
    texts = rows.join(small_or_shuffled(keys), "doc_key", "left_semi")
    held = stored(texts.select("doc_key", "doc_id", _shingles(F.col("_words")).alias("h")).dropDuplicates(["doc_key"]))

    planes = int(longest).bit_length()
    cut = F.slice(F.col("h"), F.col("s") + 1, F.greatest(F.col("n") - (SHINGLE - 1), F.lit(1)))
    prints = windows.join(held, "doc_key").select("doc_key", "n", "s", cut.alias("h"))
    prints = prints.select("doc_key", "n", "s", simhash(F.col("h"), planes).alias("f"))
    items = items.withColumn("g", simhash(F.col("h"), planes))
    blocked = items.select("item", "n", "g", F.explode(blocks(F.col("g"), radius)).alias("block"))
    near = prints.select("*", F.explode(blocks(F.col("f"), radius)).alias("block")).join(small_or_shuffled(stored(blocked)), ["n", "block"])
    found = stored(near.where(distance(F.col("f"), F.col("g")) <= radius).select("doc_key", "item", "n", "s").distinct())

    pairs = found.join(held, "doc_key").select("doc_key", "doc_id", "item", "s", F.array_distinct(cut).alias("v"))
    pairs = pairs.join(items.select("item", "item_id", "h", "w"), "item")
    shared = F.filter(F.arrays_zip("h", "w"), lambda x: F.array_contains(F.col("v"), x["h"]))
    pairs = pairs.withColumn("shared", shared)
    total = lambda weights: F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)
    inside = total(F.col("shared.w"))
    union = total(F.col("w")) + F.size("v") - F.size("shared")
    pairs = pairs.withColumn("similarity", inside / union).where(F.col("similarity") >= percent / 100 - 1e-9)
    best = F.max(F.struct("similarity", (-F.col("s")).alias("at"))).alias("best")
    out = pairs.groupBy("doc_key", "doc_id", "item", "item_id").agg(best)
    return out.select("doc_key", "doc_id", "item_id", F.col("best.similarity").alias("similarity"), (-F.col("best.at")).alias("first_word"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; all columns and all other rows stay."""
    bad = stored(matches(docs, benchmark).select("doc_key").distinct())
    rows = packed(docs, "doc_id", "text").withColumn("doc_key", doc_key())
    return unpacked(rows.join(small_or_shuffled(bad), "doc_key", "left_anti"), docs.columns, ("doc_id", "text"))

"""Benchmark decontamination: a prefix-filtered set join, in SQL functions.

A window is a run of ``window`` words of an item, and it occurs in a document
only if all its shingles of ``SHINGLE`` words do. So it is enough to look for
one of them, and the rarest in the documents is the cheapest:

1. one pass over the documents cuts words and keeps the places whose shingle
   may be an item's. The test is a bitmap of a fixed size, whatever the
   number of items;
2. those places are counted by shingle: the rarity order;
3. each window keeps its rarest shingle (the prefix for full containment);
   neighbouring windows that share it become one row;
4. documents and windows meet on that shingle, the place in the item gives the
   place in the document, the bounds of both are applied, and the words of
   each window are compared one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorate.llm.common import Stage, lower_ascii

#: Fixed value: what separates words, after A-Z are lowered.
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
SHINGLE = 3
FILTER_BITS = 20  # the bitmap has 2^20 bits, 128 KB


def words(text: Column) -> Column:
    """Words of a text; null has none."""
    cut = F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD)
    return F.filter(cut, lambda w: w != "")


def _shingle_hash(array: Column, at: Column, size: int) -> Column:
    """Hash of ``size`` words from the zero-based place ``at``."""
    return F.xxhash64(F.lit(size), *(F.get(array, at + j) for j in range(size)))


def _bit(h: Column) -> Column:
    return h.bitwiseAND(F.lit((1 << FILTER_BITS) - 1))


def _bitmap(hashes: DataFrame) -> Column:
    """The bits of all hashes as an array of 64-bit numbers. The driver sees
    as many rows as the array has places at most, whatever the benchmark."""
    word = F.shiftright(_bit(F.col("h")), 6).cast("int").alias("word")
    rows = hashes.select(word, F.expr("shiftleft(1L, int(h & 63L))").alias("mask"))
    out = [0] * (1 << (FILTER_BITS - 6))
    for row in rows.groupBy("word").agg(F.bit_or("mask").alias("mask")).toLocalIterator():
        out[row["word"]] = row["mask"]
    # One literal, which Spark folds into an array when it plans.
    return F.split(F.lit(",".join(map(str, out))), ",").cast("array<bigint>")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items,
    items (sorted array of item ids as strings), items_sha256, contaminated.

    An item of fewer words than ``window`` is one window, one without words
    is none. A word of a document is hit if any occurrence of a window covers
    it. A null or empty text has no words and no hits. Null ids and repeated
    rows stay as they are; items of one id are one item; an item without an
    id is looked for under the name of the empty string. Without items, or
    without documents, nothing is hit. Other columns are not looked at.
    """
    spark = docs.sparkSession
    staged = Stage(spark, "decontaminate")
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), words(F.col(item_text_col)).alias("w"))
    items = staged(items.withColumn("n", F.size("w")).where("n > 0").withColumn("item_row", F.monotonically_increasing_id()), "items")
    size = F.least(F.lit(SHINGLE), F.col("n"))
    by_size = F.lit(None).cast("bigint")
    for s in range(SHINGLE, 0, -1):
        by_size = F.when(size == s, _shingle_hash(F.col("w"), F.col("q"), s)).otherwise(by_size)
    placed = items.withColumn("q", F.explode(F.sequence(F.lit(0), F.col("n") - size))).withColumn("h", by_size).withColumn("size", size)
    placed = staged(placed.select("item", "item_row", "n", "w", "q", "h", "size"), "shingles")
    sizes = sorted(r[0] for r in placed.select("size").distinct().collect())  # SHINGLE values at most

    text = docs.select(F.col(id_col).alias("doc_id"), words(F.col(text_col)).alias("w"))
    hits = F.array().cast("array<struct<at:int,h:bigint,first:int,context:array<string>>>")
    if sizes:
        bits = _bitmap(placed.select("h"))
        last = window + SHINGLE

        def may_hit(h: Column) -> Column:
            word = F.get(bits, F.shiftright(_bit(h), 6).cast("int"))
            return F.getbit(word, h.bitwiseAND(F.lit(63)).cast("int")) == 1

        def context(at: Column, h: Column) -> Column:
            first = F.greatest(at - (window - 1), F.lit(0))
            return F.struct(at.alias("at"), h.alias("h"), first.alias("first"), F.slice("w", first + 1, at - first + last).alias("context"))

        def places_of(size: int) -> Column:
            place = F.when(F.size("w") >= size, F.sequence(F.lit(0), F.size("w") - size)).otherwise(F.array().cast("array<int>"))
            hashed = F.transform(place, lambda i: F.struct(i.alias("i"), _shingle_hash(F.col("w"), i, size).alias("h")))
            return F.transform(F.filter(hashed, lambda x: may_hit(x["h"])), lambda x: context(x["i"], x["h"]))

        found = [places_of(s) for s in sizes]
        hits = F.concat(*found)
    scanned = text.select("doc_id", F.size("w").cast("long").alias("n_words"), hits.alias("hits"))
    scanned = staged(scanned.withColumn("row", F.monotonically_increasing_id()), "scanned")

    places = scanned.select("row", F.explode("hits").alias("hit")).select("row", "hit.*")
    # Places that the bitmap let through by chance fall out here.
    rarity = places.groupBy("h").agg(F.count("*").alias("df"))
    order = placed.join(rarity, "h").withColumn("length", F.least(F.lit(window), F.col("n")))
    # The windows that hold the shingle at q start from here to there.
    order = order.withColumn("low", F.greatest(F.lit(0), F.col("q") + F.col("size") - F.col("length")))
    order = order.withColumn("high", F.least("q", F.col("n") - F.col("length")))
    of_window = order.withColumn("start", F.explode(F.sequence("low", "high")))
    # A window whose shingles were not all seen can't occur.
    whole = of_window.groupBy("item_row", "start").agg(
        F.count("*").alias("seen"), F.min(F.struct("df", "h", "q")).alias("prefix"),
        F.first("item").alias("item"), F.first("length").alias("length"), F.first("size").alias("size"),
    ).where("seen = length - size + 1")
    prefixes = whole.groupBy("item_row", "item", "length", F.col("prefix.q").alias("q"), F.col("prefix.h").alias("h")).agg(
        F.min("start").alias("low"), F.max("start").alias("high"), F.collect_set("start").alias("starts")  # window starts around one q: at most window many
    )
    prefixes = prefixes.join(items.select("item_row", "w"), "item_row").select(
        "item", "h", "q", "length", "starts", "low", F.slice("w", F.col("low") + 1, F.col("high") - F.col("low") + F.col("length")).alias("text"),
    )
    prefixes = staged(prefixes, "prefixes")
    met = places.join(prefixes, "h")

    def occurs(start: Column) -> Column:
        at = F.col("at") - F.col("q") + start  # the window's first word in the document
        there = F.slice("context", F.greatest(at - F.col("first"), F.lit(0)) + 1, F.col("length"))
        return (at >= F.col("first")) & (there == F.slice("text", start - F.col("low") + 1, F.col("length")))

    verified = met.withColumn("starts", F.filter("starts", occurs)).where(F.size("starts") > 0)
    place = lambda s: F.struct((F.col("at") - F.col("q") + s).alias("start"), F.col("length").alias("length"))
    spans = verified.select("row", "item", F.transform("starts", place).alias("spans"))
    # One document's spans and items are bounded by its own words.
    per_row = spans.groupBy("row").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"), F.array_sort(F.collect_set("item")).alias("items"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["start"] + s["length"] - F.greatest(acc["end"], s["start"]))).alias("n"),
            F.greatest(acc["end"], s["start"] + s["length"]).alias("end"),
        ),
        lambda acc: acc["n"],
    )
    per_row = staged(per_row.select("row", covered.cast("long").alias("n_hit"), "items"), "per-row")
    out = scanned.select("row", "doc_id", "n_words").join(per_row, "row", "left")
    items_ = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items_).cast("long").alias("n_items"), items_.alias("items"),
        F.sha2(F.array_join(items_, ",").cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents in which a window occurs, all columns as
    they were. Whether one occurs depends on the text alone, so rows are judged
    by a digest of their text; ids are not looked at and may be null or
    repeated. A null text has no words and stays. Without documents or items
    nothing is dropped; columns of ``docs`` may have any names."""
    digest = F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)
    packed = docs.select(F.struct("*").alias("doc"), digest.alias("key"))
    found = decontaminate(docs.select(digest.alias("key"), F.col(text_col).alias("text")), benchmark, window, "key", "text")
    gone = found.where("contaminated").select(F.col("doc_id").alias("key")).distinct()
    return packed.join(gone, "key", "left_anti").select("doc.*")

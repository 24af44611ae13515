"""Sharding by vector bin packing.

Documents of equal text are a group with a vector of bytes, tokens and rows.
Groups stay whole: one that is large against a shard (``HEAVY``) is a unit of
its own, small ones are gathered by a hash of the text into units. Only a group
that is larger than a shard (``WHOLE``) is cut, by a hash of the id, into
slices of about ``SLICE`` of a shard, small enough to level with. There are at most ``UNITS`` units and a
bounded number of heavy groups, whatever the input, so their vectors can be
packed on the driver: in order of falling size, each is put into the shard for
which the dot product of its vector with the residual capacity is highest.
Then units of the fullest shard are placed again, by the dot product weighed
for the law alone (bytes), as long as that levels the shards.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quorate.llm.common import Stage, normal

UNITS = 16_384
OVERHEAD = 16  # bytes that a row takes besides its text
HEAVY = 1 / 32  # share of a shard from which a group is a unit of its own
WHOLE = 1.0  # shards up to which a group stays whole
SLICE = 1 / 32  # share of a shard that a slice of a larger group has


def pack(vectors: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each row of ``vectors`` (any number of dimensions)."""
    total = vectors.sum(0)
    scaled = vectors / np.where(total == 0, 1, total) * shards  # a shard's capacity is 1 in each dimension
    residual = np.ones((shards, vectors.shape[1]))
    places = np.zeros(len(vectors), "i8")
    for row in np.lexsort([np.arange(len(scaled)), -scaled.max(1)]):
        # Of equal products the first shard; residuals may go below zero.
        places[row] = int(np.argmax(residual @ scaled[row])) if scaled[row].any() else int(np.argmax(residual.sum(1)))
        residual[places[row]] -= scaled[row]
    return places


def level(vectors: np.ndarray, places: np.ndarray, shards: int, rounds: int = 20_000) -> np.ndarray:
    """Place units of the shard with most of the law's dimension (the first)
    again, as long as that levels the shards. The dot product of a unit with
    the residual capacity, weighed for that dimension alone, is highest where
    there is least of it."""
    places = places.copy()
    load = np.bincount(places, vectors[:, 0], shards)
    members = [np.flatnonzero(places == s).tolist() for s in range(shards)]
    for _ in range(rounds):
        high, low = int(np.argmax(load)), int(np.argmin(load))
        gap = load[high] - load[low]
        sizes = vectors[members[high], 0]
        fit = np.flatnonzero((sizes > 0) & (sizes < gap))
        if not len(fit):
            break
        best = fit[int(np.argmin(np.abs(sizes[fit] - gap / 2)))]
        unit = members[high].pop(int(best))
        members[low].append(unit)
        places[unit] = low
        load[high] -= vectors[unit, 0]
        load[low] += vectors[unit, 0]
    return places


def shard_documents(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard, slot.

    ``size`` is the UTF-8 bytes of the text (null: none) and 16; slots are
    gapless from 0 in each shard, in order of unit and id. Equal texts are
    in one shard unless their group is larger than ``WHOLE`` shards in bytes,
    tokens or rows; then slices of it are placed. Null ids
    and repeated rows are placed like others. An empty table gives no rows,
    fewer documents than shards leave shards empty. Other columns are not
    looked at.
    """
    spark = docs.sparkSession
    staged = Stage(spark, "sharding")
    text = F.col("text")
    rows = normal(docs, id_col, text_col).select(
        "doc_id",
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.regexp_count(text, F.lit("[^\\x00-\\x20]+")).cast("long").alias("tokens"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("h"),
    )
    rows = staged(rows.withColumn("place", F.monotonically_increasing_id()), "rows")
    total = rows.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("size", "tokens")), F.count("*").alias("rows")).first()
    groups = rows.groupBy("h").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))
    shares = [F.col(c) * (shards / total[c]) if total[c] else F.lit(0.0) for c in ("size", "tokens", "rows")]
    # At most 3 * shards / HEAVY groups can be this large, with 3 * shards /
    # SLICE slices.
    heavy = groups.withColumn("share", F.greatest(*shares)).where(F.col("share") > HEAVY)
    slices = F.when(F.col("share") > WHOLE, F.least(F.ceil(F.col("share") / SLICE), F.col("rows"))).otherwise(1)
    heavy = staged(heavy.select("h", slices.cast("long").alias("slices")), "heavy")
    light = F.pmod("h", F.lit(UNITS)).cast("string")
    cut = F.concat_ws("/", F.col("h").cast("string"), F.pmod(F.xxhash64("doc_id", "place"), F.col("slices")).cast("string"))
    rows = rows.join(F.broadcast(heavy), "h", "left").withColumn("unit", F.when(F.col("slices").isNull(), light).otherwise(cut))
    rows = staged(rows.select("doc_id", "size", "tokens", "text_crc32", "place", "unit"), "units")
    units = rows.groupBy("unit").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))
    table = units.toPandas().sort_values("unit", ignore_index=True)  # bounded: UNITS and the heavy groups
    vectors = table[["size", "tokens", "rows"]].to_numpy("f8").reshape(-1, 3)
    table["shard"] = level(vectors, pack(vectors, shards), shards) if len(table) else 0
    table["first"] = table.groupby("shard")["rows"].cumsum() - table["rows"]
    places = spark.createDataFrame(
        pd.DataFrame(table[["unit", "shard", "first"]]), "unit STRING, shard INT, first BIGINT"
    )
    placed = rows.join(F.broadcast(places), "unit")
    within = F.row_number().over(Window.partitionBy("unit").orderBy("doc_id", "place"))
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("first") + within - 1).alias("slot"))

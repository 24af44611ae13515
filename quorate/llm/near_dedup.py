"""Near-duplicate detection by min-max hashing.

Every permutation of the shingle space gives two signature values, the least
and the greatest shingle, so ``PERMUTATIONS`` evaluations give twice as many
values. Bands of ``ROWS`` of them name buckets. The steps:

1. one pass over the texts: size, digest and bands of every shingle set;
2. equal sets become one class (a copy costs nothing from here on);
3. in each bucket every class is paired with the bucket's first class only,
   and the pairs are confirmed on the full sets;
4. confirmed links give components; a bucket whose classes are all in one
   component is done. In the others, each class outside the bucket's largest
   component is paired with one class inside; this is done ``STAR_ROUNDS``
   times and merges most of what chains of edits have drawn apart;
5. the exact rest: the classes that are still outside meet all classes of
   other components in their bucket. The join itself drops the pairs that a
   bitmap of the two sets rules out (a bound without error), the others are
   confirmed, and components are drawn once more, from all links.

So a bucket of n near copies gives about n pairs, and no pair of a bucket that
could still join two components is left untested. A pair of similarity 0.8
shares no bucket with a probability of (1 - 0.8^5)^32, some 3 in a million.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorate.llm.common import Stage, id_type, map_rows, normal, portions

PERMUTATIONS, ROWS = 80, 5
BANDS = 2 * PERMUTATIONS // ROWS
STAR_ROUNDS = 2  # before the exact rest of a bucket
BITMAP = 2048  # bits of the outline of a set
PIECE = 4096  # shingles handled at a time


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        number = self[word] = xxhash.xxh3_64_intdigest(word)
        return number


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def shingle_set(text: str, k: int, id_of: _Ids) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct k-word shingles. A-Z are lowered;
    words are what ASCII white space separates; fewer than k words are one
    shingle; no words, none."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, "u8")
    ids = np.fromiter(map(id_of.__getitem__, words), "u8", len(words))
    k = min(k, len(ids))
    h = np.full(len(ids) - k + 1, k, "u8")
    for j in range(k):
        h = _mix(h + ids[j : len(ids) - k + 1 + j])
    return np.unique(h)


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(5)
    factors = random.integers(0, 2**63, PERMUTATIONS, dtype="u8") * np.uint64(2) + np.uint64(1)
    return factors[:, None], random.integers(0, 2**63, PERMUTATIONS, dtype="u8")[:, None]


def signature(shingles: np.ndarray, permutations=None) -> np.ndarray:
    """Minima, then maxima, under every permutation of the 64-bit space."""
    factors, shifts = permutations or _permutations()
    low = np.full(PERMUTATIONS, 2**64 - 1, "u8")
    high = np.zeros(PERMUTATIONS, "u8")
    for at in range(0, len(shingles), PIECE):
        # x -> (x xor c) * odd is a permutation of the 64-bit numbers.
        values = (shingles[at : at + PIECE] ^ shifts) * factors
        np.minimum(low, values.min(1), out=low)
        np.maximum(high, values.max(1), out=high)
    return np.concatenate([low, high])


def bands(values: np.ndarray) -> np.ndarray:
    """Bucket names, different for every band."""
    h = np.arange(BANDS, dtype="u8")
    for column in values.reshape(BANDS, ROWS).T:
        h = _mix(h * np.uint64(31) + column)
    return h.view("i8")


def _sketches(rows: DataFrame, k: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        permutations, id_of = _permutations(), _Ids()
        for batch in portions(batches):
            sets = [shingle_set(t, k, id_of) for t in batch.column("text").to_pylist()]
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            names = [bands(signature(s, permutations)) if len(s) else np.zeros(0, "i8") for s in sets]
            columns = [
                batch.column("doc_id"),
                batch.column("place"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(names, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "place", "n", "digest", "bands"])

    return map_rows(rows, work, f"doc_id {id_type(rows)}, place BIGINT, n BIGINT, digest BINARY, bands ARRAY<BIGINT>")


def _sets(rows: DataFrame, k: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_of = _Ids()
        for batch in portions(batches):
            sets = [shingle_set(t, k, id_of) for t in batch.column("text").to_pylist()]
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            columns = [
                pa.array(digests, pa.binary()),
                pa.array([s.view("i8") for s in sets], pa.list_(pa.int64())),
                pa.array([outline(s) for s in sets], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["digest", "shingles", "outline"])

    return map_rows(rows.select("text"), work, "digest BINARY, shingles ARRAY<BIGINT>, outline ARRAY<BIGINT>")


def outline(shingles: np.ndarray) -> np.ndarray:
    """A bitmap with a bit for every shingle, as 64-bit numbers."""
    bits = np.zeros(BITMAP, bool)
    bits[(shingles % np.uint64(BITMAP)).astype("i8")] = True
    return np.packbits(bits, bitorder="little").view("<i8")


def _may_reach(similarity: int, n_a: str, n_b: str, a: str, b: str) -> Column:
    """False only for pairs that can't be similar enough. A bit that one set
    has and the other has not is a shingle that they do not share, so the
    bits bound the intersection from above, without error."""
    words = range(BITMAP // 64)

    def only(x: str, y: str) -> Column:
        return reduce(lambda p, q: p + q, [F.bit_count(F.get(x, F.lit(i)).bitwiseAND(F.bitwise_not(F.get(y, F.lit(i))))) for i in words])

    shared = F.least(F.col(n_a) - only(a, b), F.col(n_b) - only(b, a))
    return (100 + similarity) * shared >= similarity * (F.col(n_a) + F.col(n_b))


def components(staged: Stage, links: DataFrame, label: str) -> DataFrame:
    """(node, component) of all nodes in ``links`` (a, b), by alternating
    large and small stars; every round is written, so lineage stays short."""
    edges, state, round_ = links.select("a", "b").where("a != b").distinct(), None, 0
    while True:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = staged(large, f"{label}-large{round_}")
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.union(root.toDF("u", "v")).distinct().toDF("a", "b"), f"{label}-small{round_}")
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state or not seen[0]:
            break
        state, round_ = seen, round_ + 1
    return edges.toDF("node", "component").union(edges.select("b", "b").distinct())


def _classes(staged: Stage, rows: DataFrame, k: int, similarity: int) -> tuple[DataFrame, DataFrame]:
    """Of rows (doc_id, text, place): their sketches, and for each distinct
    set that is not empty (digest, rep, best, component), where rep is the
    smallest doc_id with the set and best the first row by (id, place), rows
    without an id last."""
    sketches = staged(_sketches(rows, k), "sketches")
    entry = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "place")
    first = F.min_by(F.struct("n", "bands"), "place").alias("first")
    classes = sketches.where("n > 0").groupBy("digest").agg(F.min("place").alias("node"), F.min("doc_id").alias("rep"), F.min(entry).alias("best"), first)
    classes = staged(classes.select("digest", "node", "rep", "best", "first.n", "first.bands"), "classes")

    buckets = classes.select(F.explode("bands").alias("bucket"), "node", "n")
    heads = buckets.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("head"), F.max("node").alias("last"))
    heads = staged(heads.where("head.node < last").select("bucket", F.col("head.node").alias("head"), F.col("head.n").alias("head_n")), "heads")
    members = staged(buckets.join(heads, "bucket"), "members")

    def sizes_allow(x: str, y: str):
        return 100 * F.least(x, y) >= similarity * F.greatest(x, y)

    pairs = members.where((F.col("node") != F.col("head")) & sizes_allow("n", "head_n"))
    pairs = staged(pairs.select(F.col("node").alias("a"), F.col("head").alias("b")).distinct(), "pairs")

    # The sets of all classes that share a bucket, read from the texts once.
    wanted = members.select("node").distinct()
    wanted = staged(classes.select("digest", "node", "rep", "n").join(wanted, "node", "left_semi"), "wanted")
    ids = wanted.select(F.coalesce(F.col("rep").cast("string"), F.lit("null")).alias("key")).distinct()
    texts = rows.withColumn("key", F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).join(ids, "key", "left_semi")
    # Many rows may share the id of a representative, or have none: of equal
    # sets one stays.
    found = _sets(texts, k).join(wanted, "digest").groupBy("node").agg(F.any_value(F.struct("n", "shingles", "outline")).alias("set"))
    sets = staged(found.select("node", "set.*"), "sets")

    def confirmed(pairs: DataFrame, label: str) -> DataFrame:
        whole = sets.select("node", "n", "shingles")
        left = pairs.join(whole.toDF("a", "n_a", "set_a"), "a")
        met = left.join(whole.toDF("b", "n_b", "set_b"), "b")
        common = F.size(F.array_intersect("set_a", "set_b"))
        # common / (n_a + n_b - common) >= similarity / 100
        links = met.where((100 + similarity) * common >= similarity * (F.col("n_a") + F.col("n_b")))
        return staged(links.select("a", "b").distinct(), f"{label}-links")

    links = confirmed(pairs, "star")
    for round_ in range(STAR_ROUNDS + 1):
        known = components(staged, links, f"round{round_}")
        # Buckets in which components still meet.
        placed = members.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
        counted = placed.groupBy("bucket", "component").agg(
            F.count("*").alias("size"), F.min_by(F.struct("node", "n"), F.xxhash64("node", "bucket", F.lit(round_))).alias("one")
        )
        mixed = counted.groupBy("bucket").agg(
            F.max_by(F.struct("component", "one"), F.struct("size", "component")).alias("largest"), F.count("*").alias("parts")
        )
        mixed = staged(mixed.where("parts > 1").select("bucket", "largest.*"), f"mixed{round_}")
        mixed = mixed.select("bucket", F.col("component").alias("largest"), F.col("one.node").alias("one"), F.col("one.n").alias("one_n"))
        open_ = placed.join(mixed, "bucket").where("node != head")
        outside = open_.where("component != largest")
        if round_ < STAR_ROUNDS:
            # Each class outside a bucket's largest component against one
            # class inside, another one for each bucket and round.
            star = outside.where((F.col("one") != F.col("head")) & sizes_allow("n", "one_n")).select(F.col("node").alias("a"), F.col("one").alias("b"))
            star = staged(star.distinct(), f"star{round_}")
            found = confirmed(star, f"star{round_}")
            links = links.union(found)
    # The exact rest. Pairs whose outlines rule out enough similarity fall out
    # in the join and are never written.
    lines = sets.select("node", "outline")
    outside = outside.join(lines, "node").select(
        "bucket", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("component").alias("c_a"), F.col("outline").alias("o_a")
    )
    other = open_.join(lines, "node").select(
        "bucket", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("component").alias("c_b"), F.col("outline").alias("o_b"), "largest"
    )
    outside, other = staged(outside, "outside"), staged(other, "open")
    same = F.col("l.bucket") == F.col("r.bucket")
    apart = F.expr("c_a != c_b AND (c_b = largest OR a < b)") & sizes_allow("n_a", "n_b")
    rest = outside.alias("l").join(other.alias("r"), same & apart & _may_reach(similarity, "n_a", "n_b", "o_a", "o_b"))
    rest = staged(rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "rest")
    known = components(staged, links.union(confirmed(rest, "rest")), "all")

    of_class = classes.select("digest", "node", "rep", "best").join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    return sketches, staged(of_class.select("digest", "rep", "best", "component"), "of-class")


def near_duplicates(
    docs: DataFrame, k: int = 5, similarity: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Two documents are linked when the Jaccard similarity of their sets of
    ``k``-word shingles is at least ``similarity`` per cent; ``component_id``
    is the smallest doc_id that links reach. A null or empty text, or one
    without words, has the empty set and is its own component. A null id is
    never the smallest; where there is no other, ``component_id`` is null and
    ``kept`` is true. Repeated rows share their component. An empty table
    gives no rows. Other columns are not looked at.
    """
    staged = Stage(docs.sparkSession, "near-dedup")
    rows = normal(docs, id_col, text_col).select("doc_id", "text", F.monotonically_increasing_id().alias("place"))
    sketches, of_class = _classes(staged, rows, k, similarity)
    smallest = of_class.groupBy("component").agg(F.min("rep").alias("component_id"), F.count("*").alias("size"))
    # Only components of several classes have another smallest id.
    joined = of_class.join(smallest.where("size > 1"), "component", "left")
    joined = joined.select("digest", F.coalesce("component_id", "rep").alias("component_id"))
    joined = staged(joined, "components")
    out = sketches.select("doc_id", "n", "digest").join(joined, "digest", "left")
    out = out.withColumn("component_id", F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_copies(docs: DataFrame, k: int = 5, similarity: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of every group of near copies, all columns as they were: that of
    the smallest id, rows without an id last, and of equal ids the first in
    the scan. Rows are told apart by their place, so a row of other text stays
    whatever id it has. Rows without words are in no group and stay."""
    staged = Stage(docs.sparkSession, "near-dedup")
    # The place of a row is fixed by writing it once.
    packed = staged(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("place")), "placed")
    doc_id, text = F.col("doc").getField(id_col), F.col("doc").getField(text_col)
    rows = packed.select(doc_id.alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"), "place")
    sketches, of_class = _classes(staged, rows, k, similarity)
    best = of_class.groupBy("component").agg(F.min("best").alias("best")).select("component", "best.place")
    stays = of_class.join(best, "component").select("digest", F.col("place").alias("stays"))
    # Only the rows that go are looked up among the documents; where they are
    # few, Spark broadcasts them and no document is shuffled.
    gone = sketches.where("n > 0").join(stays, "digest").where("place != stays").select("place")
    return packed.join(staged(gone, "gone"), "place", "left_anti").select("doc.*")

"""Secret scans: fixed patterns, and Markov models of random strings.

The patterns give the base spans. Beyond them, long unbroken strings are
candidates, and two first-order Markov models over their characters, one of
random strings and one of ordinary identifiers, decide by the log-likelihood
ratio. The labelled samples come from the corpus itself: values of base spans
are random strings, other strings are ordinary identifiers, both counted over
all documents. Everything is SQL functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorate.llm.common import normal

# The base patterns. Runs are maximal, so that a lower bound on
# their length is the same as dropping short ones; the value of an assignment
# is judged after the match.
KINDS = {
    "assign": "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": "(AKIA[A-Z0-9]{16,})",
    "hex": "([0-9a-f]{24,})",
}
ASSIGN_LEAST = 6
ADDED = "random"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = "([A-Za-z0-9+/_=-]{16,})"
IDENTIFIER = "([A-Za-z0-9+/_=-]{8,})"
SIZE = len(ALPHABET) + 1  # and 0 for the start


def matches(text: Column, pattern: str) -> Column:
    """All matches, leftmost and not overlapping: array of (start, end, value)
    in code points, where value is the pattern's first group."""
    between = F.split(text, pattern, -1)
    whole, value = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    kind = "struct<start:int,end:int,value:string>"
    empty = F.array().cast(f"array<{kind}>")
    parts = F.arrays_zip(between.alias("between"), whole.alias("whole"), value.alias("value"))

    def step(acc: Column, part: Column) -> Column:
        start = acc["at"] + F.length(part["between"])
        end = start + F.length(part["whole"])
        one = F.array(F.struct(start.alias("start"), end.alias("end"), part["value"].alias("value")).cast(kind))
        return F.struct(end.alias("at"), F.concat(acc["spans"], one).alias("spans"))

    # The piece behind the last match has no match of its own.
    walked = F.aggregate(
        F.filter(parts, lambda p: p["whole"].isNotNull()),
        F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda acc: acc["spans"],
    )
    return F.when(text.rlike(pattern), walked).otherwise(empty)


def _named(spans: Column, name: str, rank: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(name).alias("kind")))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _base(docs: DataFrame) -> DataFrame:
    found = docs.select("doc_id", "text", *(matches(F.col("text"), p).alias(f"m_{k}") for k, p in KINDS.items()))
    return found.withColumn("m_assign", F.filter("m_assign", lambda m: F.length(m["value"]) >= ASSIGN_LEAST))


def transition_ratios(docs: DataFrame) -> list[float]:
    """Log-likelihood ratio of every character pair, row by row, from all
    documents: where secrets are rare, a sample of documents holds none.
    Counts are smoothed by one; without strings of a kind all ratios are 0."""
    found = _base(docs)
    secret = F.concat(*(F.transform(f"m_{k}", lambda m: m["value"]) for k in KINDS))
    # What is left of the text when base spans are cut out.
    rest = F.col("text")
    for pattern in KINDS.values():
        rest = F.regexp_replace(rest, pattern, " ")
    plain = F.regexp_extract_all(rest, F.lit(IDENTIFIER), F.lit(1))
    labelled = F.concat(
        F.transform(secret, lambda v: F.struct(F.lit(1).alias("label"), v.alias("value"))),
        F.transform(plain, lambda v: F.struct(F.lit(0).alias("label"), v.alias("value"))),
    )
    strings = found.select(F.explode(labelled).alias("s")).select("s.label", "s.value").distinct()
    pairs = strings.select("label", "value", F.explode(F.sequence(F.lit(1), F.length("value"))).alias("i"))
    after = F.expr(f"instr('{ALPHABET}', substr(value, i, 1))")
    before = F.when(F.col("i") > 1, F.expr(f"instr('{ALPHABET}', substr(value, i - 1, 1))")).otherwise(0)
    # Copies of one string count once: the model is of strings, not of pages.
    counts = pairs.groupBy("label", before.alias("before"), after.alias("after")).agg(F.count("*").alias("n"))
    table = [[[1.0] * SIZE for _ in range(SIZE)] for _ in range(2)]
    seen = [0, 0]
    for row in counts.toLocalIterator():  # 2 * SIZE * SIZE rows at most
        table[row["label"]][row["before"]][row["after"]] += row["n"]
        seen[row["label"]] += row["n"]
    if not all(seen):
        return [0.0] * SIZE * SIZE
    log = [[[math.log(x / sum(line)) for x in line] for line in side] for side in table]
    return [r - o for random, plain_ in zip(log[1], log[0]) for r, o in zip(random, plain_)]


def scan_secrets(docs: DataFrame, least_ratio: float = 12.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base
    (array of start, rank, end, kind), added (the same, of the models), text
    of all base spans and of all spans.

    A null or empty text has no spans. Null ids and repeated rows stay. Where
    the corpus has no random string or no ordinary one, nothing is added. An
    added span overlaps no base span and has a ratio of ``least_ratio`` or
    more. Spans are in code points, the end exclusive. Other columns are not
    looked at.
    """
    rows = normal(docs, id_col, text_col)
    ratios = F.split(F.lit(",".join(f"{r:.6f}" for r in transition_ratios(rows))), ",").cast("array<double>")
    alphabet = F.lit(ALPHABET)

    def score(value: Column) -> Column:
        codes = F.transform(F.split(value, "(?!^)"), lambda c: F.call_function("instr", alphabet, c))
        step = lambda acc, c: F.struct((acc["sum"] + F.get(ratios, acc["before"] * SIZE + c)).alias("sum"), c.alias("before"))
        return F.aggregate(codes, F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("before")), step, lambda acc: acc["sum"])

    found = _base(rows).withColumn("m_long", matches(F.col("text"), CANDIDATE))
    base = F.array_sort(F.concat(*(_named(F.col(f"m_{k}"), k, i) for i, k in enumerate(KINDS))))
    found = found.withColumn("base", base)
    free = F.filter("m_long", lambda m: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    random = F.filter(free, lambda m: score(m["value"]) >= least_ratio)
    found = found.withColumn("added", _named(random, ADDED, len(KINDS)))
    return found.select(
        "doc_id", *(F.size(f"m_{k}").cast("long").alias(f"n_{k}") for k in KINDS), "base", "added",
        _joined(F.col("base")).alias("base_text"),
        _joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )

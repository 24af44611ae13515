"""Keyed loads as table-to-table operators: current rows and a batch in, the
new rows out. Writing is ``store``'s part."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quorate.schemas import ENTITY_KEY, TableSpec
from quorate.sources.staging import new_folder, stage


def apply_defaults(df: DataFrame, spec: TableSpec, now: Column, also: Sequence[str] = ()) -> DataFrame:
    """Cast to the declared columns; missing values take the declared default,
    with ``now`` for load times. A value that does not fit its type is null.
    ``also`` names further columns to carry along."""
    columns = [F.col(c) for c in also]
    for f in spec.schema:
        column = F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        if f.name in spec.defaults:
            default = spec.defaults[f.name]
            column = F.coalesce(column, (now if default == "now" else F.lit(default)).cast(f.dataType))
        columns.append(column.alias(f.name))
    return df.select(*columns)


def schema_problems(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Values that do not fit the declared table, one row per declared column:
    ``(table_name, column_name, problem, rows)``. One scan, one aggregate."""
    checks = []
    for f in spec.schema:
        if f.name not in df.columns:
            checks.append((f.name, "column is missing", F.lit(True)))
            continue
        raw = F.col(f.name)
        checks.append((f.name, "value does not fit the type", raw.isNotNull() & raw.try_cast(f.dataType).isNull()))
        if f.name in spec.max_length:
            checks.append((f.name, "text is too long", F.length(raw.cast("string")) > spec.max_length[f.name]))
    counts = df.agg(*[F.count_if(bad).alias(f"_{i}") for i, (_, _, bad) in enumerate(checks)])
    lines = [
        F.struct(
            F.lit(spec.name).alias("table_name"),
            F.lit(name).alias("column_name"),
            F.lit(problem).alias("problem"),
            F.col(f"_{i}").alias("rows"),
        )
        for i, (name, problem, _) in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*lines)))


def last_per_key(batch: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Last row of each key by ``order``; rows without a key stay as they are.
    Rows that ``order`` leaves open are told apart by their content, so the
    choice does not depend on how the input is dealt."""
    rest = [c for c in batch.columns if c != key]
    picked = (
        batch.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max_by(F.struct(*rest), F.struct(*order, F.xxhash64(*rest))).alias("_last"))
        .select(key, "_last.*")
        .select(*batch.columns)
    )
    return picked.unionByName(batch.where(F.col(key).isNull()))


def upsert(
    current: DataFrame,
    batch: DataFrame,
    key: str,
    order: Sequence[str],
    now: Column,
    keep: Sequence[str] = ("created_at",),
    stamp: str | None = "updated_at",
    fallback: str | None = None,
) -> DataFrame:
    """Insert or overwrite by key.

    The last batch row of a key wins. Columns the batch lacks, and those in
    ``keep``, hold their current value; ``stamp`` is set to ``now`` only if
    something changed. Rows with a null key take no part in the join, where
    they would all meet in one task: they are matched by ``fallback``, so that
    a batch that comes twice is there once, or are plain inserts without it.
    """
    kept = [c for c in keep if c in current.columns]
    stamped = stamp if stamp in current.columns else None
    last = last_per_key(batch, key, order)
    values = [c for c in current.columns if c in batch.columns and c != key]
    compared = [c for c in values if c not in kept and c != stamped]

    new_rows = last.where(F.col(key).isNotNull()).select(key, F.struct(*values).alias("_new"))
    old_rows = current.where(F.col(key).isNotNull()).select(
        key, F.struct(*[c for c in current.columns if c != key]).alias("_old")
    )
    old, new = F.col("_old"), F.col("_new")
    inserted, untouched = old.isNull(), new.isNull()
    changed = reduce(lambda a, b: a | b, [~old[c].eqNullSafe(new[c]) for c in compared], F.lit(False))

    def value(c: str) -> Column:
        if c == key:
            return F.col(key)
        given = new[c] if c in values else F.lit(None).cast(current.schema[c].dataType)
        if c == stamped:
            return F.when(untouched | (~inserted & ~changed), old[c]).otherwise(now)
        if c in kept:
            fresh = F.coalesce(given, now) if isinstance(current.schema[c].dataType, T.TimestampType) else given
            return F.when(inserted, fresh).otherwise(old[c])
        if c in values:
            return F.when(untouched, old[c]).otherwise(given)
        return old[c]

    merged = old_rows.join(new_rows, key, "full_outer").select(
        *[value(c).cast(current.schema[c].dataType).alias(c) for c in current.columns]
    )
    if fallback:
        without = current.where(F.col(key).isNull()), batch.where(F.col(key).isNull())
        return merged.unionByName(upsert(*without, fallback, order, now, keep, stamp))
    unkeyed = current.where(F.col(key).isNull()).unionByName(
        _shaped(last.where(F.col(key).isNull()), current, now, [*kept, *([stamped] if stamped else [])])
    )
    return merged.unionByName(unkeyed)


def _shaped(batch: DataFrame, current: DataFrame, now: Column, times: Sequence[str]) -> DataFrame:
    """Batch rows in the current table's columns, load times filled in."""
    columns = []
    for f in current.schema:
        c = F.col(f.name) if f.name in batch.columns else F.lit(None)
        if f.name in times and isinstance(f.dataType, T.TimestampType):
            c = F.coalesce(c.cast(f.dataType), now)
        columns.append(c.cast(f.dataType).alias(f.name))
    return batch.select(*columns)


def replace_children(current: DataFrame, batch: DataFrame, parent: str = ENTITY_KEY) -> DataFrame:
    """All rows of the batch's parents give way to the batch; other parents'
    rows stay. The parents are made distinct first, so a parent with very many
    batch rows is one row in the anti join."""
    parents = batch.select(parent).distinct()
    return current.join(parents, parent, "left_anti").select(*current.columns).unionByName(
        batch.select(*current.columns)
    )


def new_rows(current: DataFrame, batch: DataFrame, dedupe_keys: Sequence[str] = ()) -> DataFrame:
    """What an append adds: all of the batch, or only keys not yet there."""
    if not dedupe_keys:
        return batch
    known = current.select(*dedupe_keys).distinct()
    return batch.join(known, list(dedupe_keys), "left_anti").select(*batch.columns)


def cascade_delete(
    parents: DataFrame, children: dict[str, DataFrame], deleted: DataFrame, key: str = ENTITY_KEY
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Drop the deleted keys from the parent table and from every child."""
    gone = deleted.select(key).distinct()
    kept = {name: df.join(gone, key, "left_anti").select(*df.columns) for name, df in children.items()}
    return parents.join(gone, key, "left_anti").select(*parents.columns), kept


def enforce(
    df: DataFrame, spec: TableSpec, order: Sequence[str] = (), parents: DataFrame | None = None, held: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split a batch into the rows its table may hold and the others, with a
    ``reason`` (see ``judge``)."""
    return parted(judge(df, spec, order, parents, held))


def parted(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without a reason, and those with one."""
    return marked.where(F.col("reason").isNull()).drop("reason"), marked.where(F.col("reason").isNotNull())


def judge(
    df: DataFrame, spec: TableSpec, order: Sequence[str] = (), parents: DataFrame | None = None, held: DataFrame | None = None
) -> DataFrame:
    """A batch with the ``reason`` why its table may not hold a row: a value
    that does not fit its type, a null or a text too long where the table
    forbids it, a unique value that another key has when the row's turn comes
    (see ``first_come``; ``held`` has the stored rows whose values the batch
    wants), a row whose parent is not in ``parents``. The table's own keys are
    not tested for doubles, they are what a load goes by."""
    reasons = []
    for f in spec.schema:
        if f.name in df.columns:
            raw = F.col(f.name)
            reasons.append((raw.isNotNull() & raw.try_cast(f.dataType).isNull(), f"{f.name} does not fit its type"))
            if f.name in spec.max_length:
                reasons.append((F.length(raw.cast("string")) > spec.max_length[f.name], f"{f.name} is too long"))
        if f.name in spec.not_null:
            reasons.append((F.col(f.name).isNull() if f.name in df.columns else F.lit(True), f"{f.name} is missing"))
    marked = df.withColumn("reason", F.coalesce(*[F.when(bad, why) for bad, why in reasons], F.lit(None).cast("string")))
    for c in unique_columns(spec, df.columns):
        marked = first_come(marked, spec.primary_key, c, order, held)
    if parents is not None and spec.parent_key in df.columns:
        known = parents.select(spec.parent_key).distinct().withColumn("_known", F.lit(True))
        orphan = F.col("reason").isNull() & F.col(spec.parent_key).isNotNull() & F.col("_known").isNull()
        marked = marked.join(known, spec.parent_key, "left").withColumn("reason", F.when(orphan, "parent is not there").otherwise(F.col("reason")))
        marked = marked.select(*df.columns, "reason")
    return marked


def unique_columns(spec: TableSpec, columns: Sequence[str]) -> list[str]:
    """Unique columns of a batch besides the keys that a load goes by."""
    return [c for c in spec.unique if c not in (spec.primary_key, spec.natural_key) and c in columns]


def first_come(marked: DataFrame, key: str, column: str, order: Sequence[str], held: DataFrame | None) -> DataFrame:
    """Refuse rows whose value of a unique column another key has at that
    moment, as if rows came one by one in ``order``. A key gives its value up
    with its next row that is taken; a refused row changes nothing.

    Only values that two keys want are looked at, and all rows of those keys.
    Whether a row is taken depends on rows before it: all are taken at first,
    and each round judges every row by the round before, until nothing changes.
    While rows lie by value, they are judged once more by what came out: most
    often a row is refused over one of its own value that was refused itself.
    A round settles at least the first row that was wrong; chains in which each
    refusal undoes the next are as many rounds as they are long. Of keys that
    were looked at, only the last row that is taken goes on, so that a load
    does not choose another one. What comes back is staged.
    """
    columns = marked.columns
    folder = new_folder(marked.sparkSession, "first-come")
    rows = stage(marked.withColumn("_row", F.xxhash64(*columns)), folder, "rows")
    at = F.struct(*order, F.col(key), "_row")
    events = rows.where("reason IS NULL").select(
        F.col(key).alias("_key"), F.col(column).alias("_value"), at.alias("_at"), F.lit(False).alias("_stored")
    )
    if held is not None:
        kept = held.where(F.col(column).isNotNull()).select(F.col(key).alias("_key"), F.col(column).alias("_value"), F.lit(None).alias("_at"), F.lit(True).alias("_stored"))
        events = events.unionByName(kept.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in events.schema]))
    claims = events.where("_value IS NOT NULL").select("_value", "_key")
    wanted = claims.groupBy("_value").agg(F.min("_key").alias("_a"), F.max("_key").alias("_b")).where("_a != _b").select("_value")
    wanted = stage(wanted, folder, "wanted")
    if wanted.isEmpty():
        return rows.select(*columns)
    keys = claims.join(wanted, "_value", "left_semi").select("_key").distinct()
    # Both windows look back: frames that look ahead cost the square of a key's rows.
    latest_first = Window.partitionBy("_key").orderBy("_stored", F.col("_at").desc())
    later = latest_first.rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("_value", "_spread").orderBy(F.col("_stored").desc(), "_at").rowsBetween(Window.unboundedPreceding, -1)

    def free(taken: str) -> Column:
        """Whether the one who had the value last has ended that, or is the
        row's own key."""
        claim = F.when(F.col(taken) & F.col("_value").isNotNull(), F.struct("_key", "_end"))
        last = F.last(claim, ignorenulls=True).over(earlier)
        is_free = last.isNull() | (last["_key"] == F.col("_key")) | (last["_end"] < F.col("_at"))
        return F.col("_stored") | F.col("_value").isNull() | F.coalesce(is_free, F.lit(False))

    # Copies of a row are one event, or each would end the other's claim.
    state = events.join(keys, "_key", "left_semi").withColumn("_copy", F.coalesce(F.lag("_at").over(latest_first) == F.col("_at"), F.lit(False)))
    state, round_ = state.where("NOT _copy").drop("_copy").withColumn("_taken", F.lit(True)), 0
    while True:
        # What the next taken row of the key ends, and who had the value last.
        ended = state.withColumn("_end", F.last(F.when(F.col("_taken"), F.col("_at")), ignorenulls=True).over(later))
        # Rows without a value do not all meet.
        ended = ended.withColumn("_spread", F.when(F.col("_value").isNull(), F.col("_key")))
        judged = ended.withColumn("_once", free("_taken")).withColumn("_now", free("_once"))
        round_ += 1
        judged = judged.select(
            "_key", "_value", "_at", "_stored", F.col("_now").alias("_taken"),
            (F.col("_taken") != F.col("_once")).alias("_changed"),
            F.col("_end").isNotNull().alias("_over"),
        )
        judged = stage(judged, folder, f"round{round_}")
        state = judged.drop("_changed", "_over")
        if judged.where("_changed").isEmpty():
            break
    # Rows that are refused, and those that a later row of their key replaces.
    undone = judged.where("NOT _stored AND (NOT _taken OR _over)").select(F.col("_key").alias(key), F.col("_at._row").alias("_row"), "_taken")
    told = rows.join(undone, [key, "_row"], "left")
    told = told.where(~F.coalesce(F.col("reason").isNull() & F.col("_taken"), F.lit(False)))
    refused = F.col("reason").isNull() & (F.col("_taken") == F.lit(False))
    told = told.withColumn("reason", F.when(refused, f"{column} is taken").otherwise(F.col("reason")))
    return stage(told.select(*columns), folder, "told")


def check_constraints(
    df: DataFrame,
    table: str,
    not_null: Sequence[str] = (),
    unique: Sequence[str] = (),
    parents: DataFrame | None = None,
    key: str = ENTITY_KEY,
) -> DataFrame:
    """Violations per constraint ``(table_name, constraint_name, column_name,
    violations)``: null rows, values that occur more than once, orphan rows."""

    def line(name: str, column: str, counted: DataFrame) -> DataFrame:
        return counted.select(
            F.lit(table).alias("table_name"),
            F.lit(name).alias("constraint_name"),
            F.lit(column).alias("column_name"),
            F.col("violations"),
        )

    parts = []
    for c in not_null:
        parts.append(line("not_null", c, df.agg(F.count_if(F.col(c).isNull()).alias("violations"))))
    for c in unique:
        repeated = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("_n")).where("_n > 1")
        parts.append(line("unique", c, repeated.agg(F.count("*").alias("violations"))))
    if parents is not None:
        # Count per parent first: a hot parent is then one row in the anti join.
        owned = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
        orphans = owned.join(parents.select(key), key, "left_anti")
        total = orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("violations"))
        parts.append(line("foreign_key", key, total))
    return reduce(DataFrame.unionByName, parts)

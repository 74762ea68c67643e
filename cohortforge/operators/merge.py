"""Upserts on plain tables, and their one-pass form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    on_match: dict[str, Column] | None = None,
    on_insert: dict[str, Column] | None = None,
) -> DataFrame:
    """Update matching rows with `on_match`, add the others with `on_insert`.

    Columns named in neither keep their value on match and are NULL on insert.
    Source columns beyond `keys` are inserted under their own name.

    Two unequal source rows for a row of the target leave open which updates it: the job stops
    there, naming the key. Source rows whose key the target lacks are all inserted, and a key with
    a NULL matches nothing.

    Both tables' rows meet in one list, whose rows stay dealt out as they are: of a chain of
    upserts, with sources dealt out alike, the target is shuffled once and not at each step.
    """
    on_match, on_insert = on_match or {}, on_insert or {}
    types = {f.name: f.dataType for f in target.schema.fields}
    extra = [f for f in source.schema.fields if f.name not in keys]
    if not on_match and extra:
        # insert only: the key may repeat on either side
        return _insert_missing(target, source, keys, on_insert)

    values = [name for name in types if name not in keys]
    nothing = [F.lit(None).cast(f.dataType).alias(f"_new_{f.name}") for f in extra]
    old = target.select(*keys, *values, *nothing, F.lit(True).alias("_old"))
    new = source.distinct().select(
        *keys,
        *(F.lit(None).cast(types[name]).alias(name) for name in values),
        *(F.col(f.name).alias(f"_new_{f.name}") for f in extra),
        F.lit(False).alias("_old"),
    )
    of_key = Window.partitionBy(*keys)
    counted = {"_known": _matches(keys) & F.bool_or("_old").over(of_key)}
    counted["_rows"] = F.when(_matches(keys), F.count_if(~F.col("_old")).over(of_key)).otherwise(0)
    for f in extra:  # a row of the target has the values of the one row that updates it
        incoming = F.first(f"_new_{f.name}", ignorenulls=True).over(of_key)
        incoming = F.when(_matches(keys), incoming)
        counted[f"_new_{f.name}"] = F.when(F.col("_old"), incoming).otherwise(F.col(f"_new_{f.name}"))
    joined = old.unionByName(new).withColumns(counted).where("_old or not _known")
    if extra:
        message = F.concat(F.lit("source rows differ for one key: "), F.to_json(F.struct(*keys)))
        unclear = F.col("_old") & (F.col("_rows") > 1)
        joined = joined.where(F.when(unclear, F.raise_error(message).cast("boolean")).otherwise(True))
    out = []
    named = {f.name for f in extra}
    for name, kind in types.items():
        if name in keys:
            out.append(F.col(name))
            continue
        added = on_insert.get(name, F.col(f"_new_{name}") if name in named else F.lit(None))
        kept = F.col(name)
        if name in on_match:
            kept = F.when(F.col("_rows") > 0, on_match[name].cast(kind)).otherwise(kept)
        out.append(F.when(F.col("_old"), kept).otherwise(added.cast(kind)).alias(name))
    return joined.select(*out)


def _matches(keys: list[str]) -> Column:
    """Whether a key can equal another: it has no NULL."""
    return reduce(Column.__and__, (F.col(k).isNotNull() for k in keys))


def _insert_missing(
    target: DataFrame, source: DataFrame, keys: list[str], on_insert: dict[str, Column]
) -> DataFrame:
    columns = []
    for field in target.schema.fields:
        if field.name in source.columns:
            value = F.col(field.name)
        else:
            value = on_insert.get(field.name, F.lit(None))
        columns.append(value.cast(field.dataType).alias(field.name))
    fresh = source.distinct().select(*columns, F.lit(False).alias("_old"))
    known = _matches(keys) & F.bool_or("_old").over(Window.partitionBy(*keys))
    both = target.withColumn("_old", F.lit(True)).unionByName(fresh).withColumn("_known", known)
    return both.where("_old or not _known").select(*target.columns)


def flag_exists(
    target: DataFrame, source: DataFrame, keys: list[str], column: str, value: Column
) -> DataFrame:
    """Set `column` on the rows whose key occurs in `source`."""
    hits = source.select(*keys).distinct().withColumn("_hit", F.lit(True))
    flagged = F.when(F.col("_hit"), value.cast(target.schema[column].dataType)).otherwise(
        F.col(column)
    )
    names = target.columns
    return target.join(hits, keys, "left").withColumn(column, flagged).select(*names)


def merge_flags(df: DataFrame, keys: list[str], marks: dict[str, Column]) -> DataFrame:
    """Per key, whether any row carries each mark; one shuffle, reduced map-side.

    Marks travel as the bits of longs, up to 63 in each, not as a column each.
    """
    words = [list(marks.items())[k : k + 63] for k in range(0, len(marks), 63)]
    packed = {
        f"_marks{w}": reduce(
            Column.__add__, (F.when(mark, F.lit(1 << k)).otherwise(0).cast("long") for k, (_, mark) in enumerate(word))
        )
        for w, word in enumerate(words)
    }
    merged = df.select(*keys, *(bits.alias(name) for name, bits in packed.items()))
    merged = merged.groupBy(*keys).agg(*(F.bit_or(name).alias(name) for name in packed))
    seen = [
        F.col(f"_marks{w}").bitwiseAND(F.lit(1 << k).cast("long")).__ne__(0).alias(name)
        for w, word in enumerate(words)
        for k, (name, _) in enumerate(word)
    ]
    return merged.select(*keys, *seen)


def table_changes(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """What turns one release of a table into another: (keys, change, columns).

    `change` is inserted, updated or deleted; `columns` are those of an updated row whose values
    differ, by the order of `before`. Columns that only one release has count as NULL in the other.
    Rows are compared by a 64-bit hash of each value, so that keys and hashes are shuffled and not
    the rows. NULL keys are equal to each other. A key that a release has twice stops the job.
    """
    values = [c for c in dict.fromkeys([*before.columns, *after.columns]) if c not in keys]
    sides = ("before", "after")

    def hashed(df: DataFrame, side: str) -> DataFrame:
        known = [F.xxhash64(F.lit(c), c) if c in df.columns else F.xxhash64(F.lit(c), F.lit(None)) for c in values]
        hashes = {s: known if s == side else [F.lit(None).cast("long")] * len(values) for s in sides}
        there = [F.lit(int(s == side)).alias(f"_{s}") for s in sides]
        return df.select(*keys, *there, *(h.alias(f"_{s}_{k}") for s in sides for k, h in enumerate(hashes[s])))

    # both releases in one shuffle: NULL keys are equal there
    sums = [F.sum(f"_{s}").alias(f"_{s}") for s in sides]
    held = [F.max(f"_{s}_{k}").alias(f"_{s}_{k}") for s in sides for k in range(len(values))]
    both = hashed(before, "before").unionByName(hashed(after, "after")).groupBy(*keys).agg(*sums, *held)
    for side in sides:
        message = F.concat(F.lit(f"a key repeats {side} the change: "), F.to_json(F.struct(*keys)))
        both = both.where(F.when(F.col(f"_{side}") > 1, F.raise_error(message).cast("boolean")).otherwise(True))
    differs = [F.col(f"_before_{k}") != F.col(f"_after_{k}") for k in range(len(values))]
    change = (
        F.when(F.col("_before") == 0, "inserted")
        .when(F.col("_after") == 0, "deleted")
        .when(reduce(Column.__or__, differs, F.lit(False)), "updated")
    )
    named = F.array(*(F.when(differ, F.lit(c)) for differ, c in zip(differs, values))).cast("array<string>")
    columns = F.when(F.col("change") == "updated", F.array_compact(named))
    changed = both.withColumn("change", change).where("change is not null")
    return changed.select(*keys, "change", columns.alias("columns"))

"""First and latest events, rule-based events, cohort labels, exclusion."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_event(
    df: DataFrame, key: str, ts: str, pred: Column | None = None, out: str = "first_ts"
) -> DataFrame:
    """Earliest `ts` per `key`; partial minima are taken before the shuffle."""
    if pred is not None:
        df = df.where(pred)
    return df.groupBy(key).agg(F.min(ts).alias(out))


def latest_records(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Rows at the latest non-null `ts` of their key; ties are kept.

    A max per key (reduced map-side) and a semi-join back, not a rank: no task
    has to sort all rows of one key.
    """
    latest = df.groupBy(key).agg(F.max(ts).alias(ts))
    return df.join(latest, [key, ts], "left_semi")


def rule_events(df: DataFrame, rules: list[tuple[Column, Column]], out: list[str]) -> DataFrame:
    """Distinct `out` of the rows in a rule's scope that meet its predicate, in one scan."""
    hit = reduce(or_, (scope & predicate for scope, predicate in rules))
    return df.where(hit).select(*out).distinct()


def label_cohort(
    primary: DataFrame, secondary: DataFrame, key: str, labels: tuple[str, str, str]
) -> DataFrame:
    """One row per key found by either side; `labels` are (both, primary, secondary)."""
    both, only_primary, only_secondary = labels
    joined = primary.withColumn("_p", F.lit(True)).join(
        secondary.withColumn("_s", F.lit(True)), key, "full_outer"
    )
    kind = (
        F.when(F.col("_p") & F.col("_s"), both)
        .when(F.col("_p"), only_primary)
        .otherwise(only_secondary)
    )
    return joined.withColumn("cohort_type", kind).drop("_p", "_s")


def exclude(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not listed."""
    return df.join(ids.select(key), key, "left_anti")


def rule_counts(
    df: DataFrame, rules: dict[str, Column], person: str, event: list[str]
) -> DataFrame:
    """(kind, rules, events, people): what each rule finds, and each combination of rules.

    A row has a bit for each rule that it meets, in one scan; bits are joined by event, then by
    person, so a distinct event counts once a rule. Of a rule: its events, and the people with one.
    Of a combination, named by its rules with `+`: the events that just these rules find, and the
    people for whom just these rules, in whatever events, do.
    """
    if len(rules) > 63:
        raise ValueError("a long has bits for 63 rules")
    bits = [F.when(met, F.lit(1 << k)).otherwise(0).cast("long") for k, met in enumerate(rules.values())]
    marks = F.aggregate(F.array(*bits), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    keys = list(dict.fromkeys([person, *event]))
    events = df.select(*keys, marks.alias("_marks")).where("_marks <> 0")
    events = events.groupBy(*keys).agg(F.bit_or("_marks").alias("_marks"))
    # a row for each person and kind of event: their number is bounded by the rules, not by events
    per_person = events.groupBy(person, "_marks").agg(F.count(F.lit(1)).alias("_events"))
    held = per_person.groupBy(person).agg(
        F.bit_or("_marks").alias("_all"), F.collect_list(F.struct("_marks", "_events")).alias("_of")
    )

    def row(kind: str, marks: str, n_events: str, n_people: str) -> str:
        return f"named_struct('kind', '{kind}', 'marks', {marks}, 'events', {n_events}, 'people', {n_people})"

    singles = [
        row(
            "rule",
            f"{1 << k}L",
            f"aggregate(filter(_of, e -> e._marks & {1 << k}L <> 0), 0L, (n, e) -> n + e._events)",
            f"cast(_all & {1 << k}L <> 0 as bigint)",
        )
        for k in range(len(rules))
    ]
    mixed = f"transform(_of, e -> {row('combination', 'e._marks', 'e._events', '0L')})"
    own = f"array({row('combination', '_all', '0L', '1L')})"
    rows = held.select(F.inline(F.expr(f"concat(array({', '.join(singles)}), {mixed}, {own})")))
    counted = rows.groupBy("kind", "marks").agg(F.sum("events").alias("events"), F.sum("people").alias("people"))
    met = [F.when(F.col("marks").bitwiseAND(1 << k) != 0, F.lit(name)) for k, name in enumerate(rules)]
    names = F.array_join(F.array_compact(F.array(*met)), "+").alias("rules")
    return counted.where("events > 0 or people > 0").select("kind", names, "events", "people")


# no key of the type is less
LOWEST = {"string": "", "long": -(1 << 63), "integer": -(1 << 31)}


def among(df: DataFrame, people: DataFrame, key: str) -> DataFrame:
    """Rows of the people (or orders) listed, pruned before they are shuffled.

    Few keys are broadcast. For more, Spark puts a Bloom filter of them into the scan of
    `df`, and the semi-join behind it is exact; it does so where that side has a comparison, and
    this one holds for every key. `session.configure` sets from which sizes on.
    """
    lowest = LOWEST.get(people.schema[key].dataType.typeName())
    ids = people.select(key) if lowest is None else people.where(F.col(key) >= F.lit(lowest)).select(key)
    return df.join(ids, key, "left_semi")


def among_dealt(df: DataFrame, people: DataFrame, key: str, by: str) -> DataFrame:
    """`among` for rows that are dealt out by `by`, of which a person has few: they stay there.

    The pairs of both keys go to the people and back, not the rows. They meet the rows in an inner
    join, as Spark moves a semi-join before the joins that the rows come from. `by` must not be
    NULL, as after an inner join on it: such rows are left out.
    """
    pairs = among(df.select(by, key).distinct(), people, key).repartition(by)
    return df.join(pairs, [by, key]).select(*df.columns)

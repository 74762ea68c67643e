"""Dense surrogate keys without a one-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dense_key(
    df: DataFrame,
    key: str,
    out: str,
    salt: str = "",
    existing: DataFrame | None = None,
    prefix: int = 4,
) -> DataFrame:
    """Number the distinct non-null keys 1..N in the order of their salted SHA-256.

    The hash's first `prefix` hex digits split the keys into even buckets. Bucket
    counts (at most 16**prefix rows) turn into offsets, and keys are numbered
    inside their bucket, so the order is global but no task sees all keys. The
    numbers depend on the keys and the salt alone: a lost task gives them again.

    `existing` (key, out) keeps its numbers; new keys are numbered after them.
    """
    ids = df.select(key).where(F.col(key).isNotNull()).distinct()
    if existing is not None:
        ids = ids.join(existing.select(key), key, "left_anti")
    digest = F.sha2(F.concat(F.lit(salt), F.col(key).cast("string")), 256)
    hashed = ids.withColumn("_hash", digest).withColumn("_bucket", F.col("_hash").substr(1, prefix))

    counts = hashed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    if existing is not None:
        taken = existing.agg(F.coalesce(F.max(out), F.lit(0)).cast("long").alias("_n"))
        counts = counts.unionByName(taken.withColumn("_bucket", F.lit("")))
    before = F.sum("_n").over(Window.orderBy("_bucket")) - F.col("_n")
    offsets = counts.select("_bucket", before.alias("_before"))

    place = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash", key))
    # offsets hold at most 16**prefix short rows, whatever the data
    numbered = hashed.join(F.broadcast(offsets), "_bucket").select(
        key, (F.col("_before") + place).cast("long").alias(out)
    )
    return numbered if existing is None else existing.select(key, out).unionByName(numbered)

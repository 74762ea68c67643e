"""Source tables by logical name. A source is any `name -> DataFrame` callable."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Sources = Callable[[str], DataFrame]


def blank_is_null(df: DataFrame) -> DataFrame:
    """Empty strings as NULL, as the source database stores them."""
    return df.select(
        *(
            F.nullif(F.col(f.name), F.lit("")).alias(f.name)
            if f.dataType.typeName() == "string"
            else F.col(f.name)
            for f in df.schema.fields
        )
    )


def remembered(read: Sources) -> Sources:
    """Each table opened once, its blank text as NULL."""
    frames: dict[str, DataFrame] = {}

    def get(name: str) -> DataFrame:
        if name not in frames:
            frames[name] = blank_is_null(read(name))
        return frames[name]

    return get


def from_parquet(spark: SparkSession, root: str) -> Sources:
    """Tables stored as `<root>/<name>` parquet."""
    return remembered(lambda name: spark.read.parquet(f"{root}/{name}"))


def from_tables(spark: SparkSession, schema_of: Mapping[str, str], default: str) -> Sources:
    """Metastore tables or views, with the schema that owns each (else `default`)."""
    return remembered(lambda name: spark.table(f"{schema_of.get(name, default)}.{name}"))


def from_frames(frames: Mapping[str, DataFrame], otherwise: Sources | None = None) -> Sources:
    """Frames at hand, falling back to another source."""

    def get(name: str) -> DataFrame:
        if name in frames or otherwise is None:
            return frames[name]
        return otherwise(name)

    return get

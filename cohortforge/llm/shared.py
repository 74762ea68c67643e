"""The folder all executors share, tables staged in it, and groups streamed through Arrow."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder `spark.checkpoint.dir` names; where it is unset (tests), an own one is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier attempt has used."""
    return f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/{name}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: later plans start from the files."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def excerpt(text: str, chars: int, parts: int = 8) -> Column:
    """The text, or of one of over `chars` characters as many from `parts` places spread over all of it."""
    size = chars // parts
    room = F.length(text) - size
    cuts = [F.substr(F.col(text), F.floor(room * k / (parts - 1)).cast("int") + 1, F.lit(size)) for k in range(parts)]
    return F.when(F.length(text) > chars, F.concat_ws(" ", *cuts)).otherwise(F.col(text))


def whole_groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by the integer column `key`.

    Holds one batch and the group that is not over yet, so groups must be bounded.
    """
    carry: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        last = np.flatnonzero(keys != keys[-1])
        cut = int(last[-1]) + 1 if len(last) else 0
        if not cut and carry and carry[-1].column(key)[0].as_py() != keys[0]:
            yield pa.Table.from_batches(carry)
            carry = []
        if cut:
            yield pa.Table.from_batches([*carry, batch.slice(0, cut)])
            carry = []
        carry.append(batch.slice(cut))
    if carry:
        yield pa.Table.from_batches(carry)


def group_bounds(keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys, and the end."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def text_slices(column: pa.Array, most_bytes: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column that hold about `most_bytes` each, one row at least."""
    ends = np.cumsum([0 if n is None else n for n in pc.binary_length(column).to_pylist()])
    start, base = 0, 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, base + most_bytes, "right")))
        yield start, stop
        start, base = stop, int(ends[stop - 1])


def kept_by_worker(key: tuple, make: Callable[[], object]) -> object:
    """What a Python worker keeps from task to task; made anew in another worker.

    Functions reach workers by value, each time with modules of their own; this is kept beside them.
    """
    held = vars(sys.modules.setdefault("_llm_kept_by_worker", ModuleType("_llm_kept_by_worker")))
    if key not in held:
        held[key] = make()
    return held[key]


BITS = 1 << 22


def bitmap(df: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """A set of 64-bit integers as `bits` bits, with one hash: half a megabyte, whatever `df` holds.

    It may hold more than `df` does, so what passes it is joined exactly afterwards.
    """
    place = F.col(column).bitwiseAND(bits - 1)
    words = df.where(F.col(column).isNotNull()).groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(`{column}` & 63 as int))")).alias("held")
    )
    out = np.zeros(bits // 64, np.int64)
    for row in words.collect():  # at most bits / 64 rows
        out[row["word"]] = row["held"]
    return out.view(np.uint64)


def may_hold(held: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether each 64-bit integer may be in the bitmap."""
    place = values.view(np.uint64) & np.uint64(len(held) * 64 - 1)
    return (held[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) != 0

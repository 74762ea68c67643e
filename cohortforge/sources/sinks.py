"""Extract files and staged tables."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortforge.sources.files import Files

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def csv_writer(df: DataFrame):
    """A writer of quoted CSV with a header, in part files."""
    options = {"header": True, "quoteAll": True, "escape": '"', "emptyValue": ""}
    options |= {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    formats = {"timestampFormat": TIME_FORMAT, "timestampNTZFormat": TIME_FORMAT}
    return df.write.options(**options, **formats)


def write_csv(df: DataFrame, path: str) -> None:
    """A review or driver list: quoted CSV with a header, in part files."""
    csv_writer(df).mode("overwrite").csv(path)


@dataclass(frozen=True)
class Stored:
    """What a complete stage left behind."""

    name: str
    version: str  # names what the stage was made from
    path: str
    rows: int  # as counted by the job that wrote them
    schema: str
    sets: str | None = None  # where the sets of its people are
    by: str | None = None  # the key its rows are dealt out by, and into how many buckets
    buckets: int = 0


class StageStore:
    """Parquet tables under one run folder of `folder`.

    On a cluster the folder must be on storage that the driver and all executors share. A stage is
    complete once its record is written, after its rows: a run under the same name, after a lost
    driver, takes complete stages over and writes the others. Every attempt has a path of its own.

    With `buckets`, stages are dealt out by their key as they are written, so that joins of stored
    stages on it shuffle neither side. That is one shuffle of each stage, for tables which many later
    joins read; small tables are better without.
    """

    def __init__(self, spark: SparkSession, folder: str, run: str | None = None, buckets: int = 0):
        if not folder:
            raise ValueError("a stage store needs a folder that all executors can reach")
        self.spark = spark
        self.files = Files(spark)
        self.buckets = buckets
        self.root = f"{folder.rstrip('/')}/{run or f'run-{uuid.uuid4().hex}'}"
        self.written: list[str] = []
        self.stored: dict[str, Stored] = {}  # the version saved last
        self.complete: dict[tuple[str, str], Stored] = {}  # each version: studies may share a store

    def save(
        self,
        df: DataFrame,
        name: str,
        version: str | None = None,
        sets: Callable[[DataFrame], DataFrame] | None = None,
        by: str | None = None,
    ) -> DataFrame:
        """Write a stage and return it read back: later plans start from the files.

        Its rows are counted by the job that writes them. `sets` makes the sets of its people,
        stored beside it. With a `version`, a complete stage of that version is taken instead.
        """
        version = version or uuid.uuid4().hex
        record = self._record(name, version)
        if not self.files.exists(record):
            attempt = f"{self.root}/{name}/{version}/{uuid.uuid4().hex}-{name}"
            self.written.append(attempt)
            counted, buckets = Observation(), self.buckets if by else 0
            rows = df.repartition(buckets, by) if buckets else df
            writer = rows.observe(counted, F.count(F.lit(1)).alias("rows")).write.format("parquet")
            writer.option("compression", "zstd")
            if buckets:
                table = self._table(attempt)
                writer.option("path", attempt).bucketBy(buckets, by).sortBy(by).saveAsTable(table)
            else:
                writer.save(attempt)
            done = Stored(name, version, attempt, counted.get["rows"], df.schema.json(), by=by, buckets=buckets)
            if sets is not None:
                beside = f"{attempt}-people"
                self.written.append(beside)
                sets(self._read(done)).write.parquet(beside)
                done = Stored(**{**asdict(done), "sets": beside})
            self.files.publish(record, json.dumps(asdict(done)))
        self.stored[name] = Stored(**json.loads(self.files.text(record)))
        self.complete[name, version] = self.stored[name]
        return self._read(self.stored[name])

    def _record(self, name: str, version: str) -> str:
        return f"{self.root}/{name}/{version}/complete.json"

    def _table(self, path: str) -> str:
        """The name of a bucketed table in the session's catalog."""
        return f"stage_{hashlib.sha256(path.encode()).hexdigest()[:24]}"

    def _read(self, done: Stored) -> DataFrame:
        schema = StructType.fromJson(json.loads(done.schema))
        if not done.buckets:
            return self.spark.read.schema(schema).parquet(done.path)
        table = self._table(done.path)
        if not self.spark.catalog.tableExists(table):  # written by an earlier session
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            dealt = f"clustered by (`{done.by}`) sorted by (`{done.by}`) into {done.buckets} buckets"
            self.spark.sql(f"create table {table} ({columns}) using parquet {dealt} location '{done.path}'")
        return self.spark.table(table)

    def people(self, versions: dict[str, str]) -> DataFrame:
        """(stage, part, bucket, people, loose, total): the stored sets of some stages' versions, in one scan."""
        done = [self.complete[n, version] for n, version in versions.items()]
        paths = {d.sets: d.name for d in done if d.sets}
        sets = self.spark.read.parquet(*paths)
        folder = F.regexp_extract(F.col("_metadata.file_path"), r"/[0-9a-f]+-(\w+)-people/[^/]*$", 1)
        return sets.select(folder.alias("stage"), *sets.columns)

    def release(self) -> list[str]:
        """Delete the stages this run wrote and its folder if nothing else is in it."""
        for done in self.complete.values():
            if done.buckets:
                self.spark.sql(f"drop table if exists {self._table(done.path)}")
        dropped = [path for path in self.written if self.files.delete(path)]
        for done in self.complete.values():
            if done.path in self.written:
                self.files.delete(self._record(done.name, done.version))
        self.files.delete_empty(self.root)
        self.written, self.stored, self.complete = [], {}, {}
        return dropped

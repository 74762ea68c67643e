"""The views as Spark sources over one data folder, and the test study."""

from __future__ import annotations

import hashlib
import re
import tempfile
import zlib
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from cohortforge import Study, StudyConfig
from cohortforge.session import configure, keep_dealt, partition_by_size
from cohortforge.sources import Files, StageStore, blank_is_null
from testbed.views import BASE_TABLES, VIEWS, view_sql

CONFIG = StudyConfig(
    window_start=date(1996, 3, 2),
    window_end=date(2000, 2, 28),
    as_of=date(2024, 2, 1),
    salt="testbed",
    icd_cutover=date(1998, 1, 1),
)


# Short lists whose views scan a long table: as files, joins know that they are short.
LISTS = ("date_dimension", "dx_code_list", "lz_dx_px_lookup", "zc_disp_enc_type")

# Long tables that views join on one key: dealt out by it once, no join on it shuffles them.
DEALT = {"lineitem": "l_orderkey", "orders": "o_orderkey"}
BUCKET_BYTES, LEAST_BUCKETS = 8 << 20, 8  # of the tables' files, a bucket


class ViewSources:
    """`name -> DataFrame` over the test tables of `sf_dir`; short lists are landed in `folder`.

    So are the long tables, in buckets, once a view of theirs is asked for after another: a single
    view costs less as it is. Without `deal` they are read as they are.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, folder: str | None = None, deal: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.folder = folder
        self.deal = deal
        tag = f"t{zlib.crc32(sf_dir.encode()):08x}"
        self.names = {t: f"{tag}_{t}" for t in BASE_TABLES}
        self.read_from = dict(self.names)
        self.asked = dict.fromkeys(DEALT, 0)
        self.frames: dict[str, DataFrame] = {}
        self.views = {v: f"{tag}_v_{v}" for v in VIEWS}
        for table, view in self.names.items():
            spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(view)

    def table(self, name: str) -> DataFrame:
        """A test table as it is."""
        return self.spark.table(self.names[name])

    def _deal(self) -> None:
        """Land the long tables in buckets; views made from now on read them there."""
        buckets = max(LEAST_BUCKETS, input_bytes(self.spark, self.sf_dir) // BUCKET_BYTES)
        for table, key in DEALT.items():
            path = f"{self.folder}/{table}"
            self.read_from[table] = f"dealt_{hashlib.sha256(path.encode()).hexdigest()[:24]}"
            rows = self.table(table)
            rows = rows.select(*(c for c in rows.columns if any(c in sql for sql in VIEWS.values())))
            writer = rows.repartition(buckets, key).write.format("parquet").option("path", path)
            writer = writer.option("compression", "zstd")
            writer.bucketBy(buckets, key).saveAsTable(self.read_from[table])
        self.frames.clear()

    def _ask(self, sql: str) -> None:
        for table in DEALT:
            self.asked[table] += f"{{{table}}}" in sql
        if self.folder and self.deal and self.read_from == self.names and max(self.asked.values()) > 1:
            self._deal()

    def __call__(self, name: str) -> DataFrame:
        self._ask(VIEWS[name])
        if name not in self.frames:
            sql = view_sql(name, "spark")
            for other in re.findall(r"\bfrom (edg_current_icd\d+)", sql):
                self(other).createOrReplaceTempView(self.views[other])
                sql = re.sub(rf"\bfrom {other}\b", f"from {self.views[other]}", sql)
            rows = self.spark.sql(sql.format(**self.read_from))
            if self.folder and name in LISTS:
                if not Files(self.spark).exists(f"{self.folder}/{name}"):
                    rows.write.parquet(f"{self.folder}/{name}")
                rows = self.spark.read.schema(rows.schema).parquet(f"{self.folder}/{name}")
            self.frames[name] = blank_is_null(rows)
        return self.frames[name]


def stage_folder(spark: SparkSession) -> str:
    """The folder `spark.checkpoint.dir` names; a fresh one where tests left it unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or tempfile.mkdtemp(prefix="cohortforge-")


def input_bytes(spark: SparkSession, sf_dir: str) -> int:
    """The bytes of the test tables' files."""
    files = Files(spark)
    return sum(size for t in BASE_TABLES for _, size, _ in files.listed(f"{sf_dir}/{t}.parquet"))


_studies: dict[tuple[str, str], Study] = {}


def study(spark: SparkSession, sf_dir: str) -> Study:
    """The session's study over a folder: stages read by many queries are written once."""
    configure(spark)
    size = input_bytes(spark, sf_dir)
    partition_by_size(spark, size)
    keep_dealt(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _studies:
        store = StageStore(spark, stage_folder(spark))
        # tables that would not fill the buckets are short: they are not dealt out
        sources = ViewSources(spark, sf_dir, f"{store.root}/sources", deal=size >= LEAST_BUCKETS * BUCKET_BYTES)
        _studies[key] = Study(sources, CONFIG, store)
    return _studies[key]

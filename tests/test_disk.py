"""What is left on the disks while a study or an operator goes on."""

import glob
import os

from pyspark.sql import functions as F

from cohortforge.llm import collocations
from cohortforge.sources import StageStore
from testbed import sources


def shuffled_through(spark, act) -> int:
    """Shuffle files that an action leaves behind."""
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    folders = [d.getPath() for d in env.blockManager().diskBlockManager().localDirs()]
    files = lambda: {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*")}
    before = files()
    act()
    return len(files() - before)


def test_a_stored_stage_leaves_no_shuffle_files(spark, tmp_path):
    rows = spark.range(5000).groupBy((F.col("id") % 100).alias("k")).count()
    kept = []
    assert shuffled_through(spark, lambda: kept.append(StageStore(spark, str(tmp_path)).save(rows, "part"))) == 0
    assert kept[0].count() == 100 and rows.count() == 100  # the same rows once more


def test_collocations_keep_one_relation_and_no_old_shuffles(spark, monkeypatch):
    """Neither what the pieces were shuffled through nor the words are there when phrases are counted."""
    name = next(iter(collocations.NO_OLD_SHUFFLES))
    monkeypatch.setitem(vars(collocations), "seen", [])
    real = collocations.count_groups

    def watched(rows, size, least):
        held = {f.rpartition("/")[0] for f in rows.inputFiles()}
        collocations.seen.append((size, spark.conf.get(name), len(held)))
        return real(rows, size, least)

    monkeypatch.setattr(collocations, "count_groups", watched)
    dropped = []
    keep_last = collocations.Relations.keep_last

    def kept(self, tables):
        paths = dict(self.paths)
        keep_last(self, tables)
        dropped.extend(p for n, p in paths.items() if n not in self.paths)
        assert len(self.paths) == min(tables, len(paths))
        assert not any(os.path.exists(p.removeprefix("file:")) for p in dropped)

    monkeypatch.setattr(collocations.Relations, "keep_last", kept)
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        docs = spark.createDataFrame([(k, "one two three four. two three", "en") for k in range(30)], "doc_id long, text string, lang string")
        found = collocations.collocations(docs).collect()
        assert spark.conf.get(name) == "false"
    finally:
        spark.conf.set(name, before)
    assert collocations.seen == [(2, "true", 1), (3, "true", 1)] and len(dropped) == 2
    assert [r["phrase"] for r in found if r["a"] == 30]


def test_short_tables_are_not_dealt_out(spark, sf_dir, monkeypatch):
    """Views of tables that would not fill the buckets read them as they are."""
    enough = sources.LEAST_BUCKETS * sources.BUCKET_BYTES
    for size, dealt in ((enough - 1, False), (enough, True)):
        monkeypatch.setattr(sources, "_studies", {})
        monkeypatch.setattr(sources, "input_bytes", lambda spark, sf_dir, size=size: size)
        s = sources.study(spark, sf_dir)
        for name in ("order_results", "pat_enc_dx"):
            files = s.src(name).inputFiles()
        assert any("/sources/" in f for f in files) == dealt

"""Phrase collocations by set-oriented relational mining (SETM) over sorted occurrence relations.

An occurrence relation has a row for each place where a phrase stands: (deal, piece, pos, word ids,
copies). Relations are written bucketed by `deal` and sorted by piece and position, so that phrases
are made one word longer by a merge join on piece and adjacent position without another shuffle;
they are counted, and only occurrences of frequent phrases are extended to the next length.

Equal pieces of a language are one piece with a number of copies, so a passage that a third of all
documents share is held, joined and counted once.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortforge.llm.shared import new_path, staged

LEAST = 10  # occurrences a phrase must have
SHARE = 50  # per cent of a phrase's occurrences within a longer one from which it is dropped
TOP = 2000  # phrases reported for a language
LONGEST = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PIECE_END = r"[.,;:!?\x0A-\x0D]"
BLANKS = r"[\x20\x09]+"
DEALS = 16  # values of `deal` for each bucket: more make buckets more even
SMALL = 1_000_000  # frequent groups that a semi-join broadcasts, as 64-bit keys; more are shuffled
SALTS = 64  # first-round rankings for each language


def pieces(docs: DataFrame) -> DataFrame:
    """(lang, piece, copies): the distinct pieces of each language, without the blanks around them.

    Pieces without a word are left out.
    """
    lang = F.coalesce("lang", F.lit("und"))
    split = docs.select(lang.alias("lang"), F.explode(F.split(F.coalesce("text", F.lit("")), PIECE_END)).alias("piece"))
    whole = split.withColumn("piece", F.btrim("piece", F.lit(" \t"))).where("piece <> ''")
    # of ASCII letters only, `lower` is much faster than to translate
    ascii_only = F.octet_length("piece") == F.length("piece")
    lowered = F.when(ascii_only, F.lower("piece")).otherwise(F.translate("piece", UPPER, LOWER))
    return whole.select("lang", lowered.alias("piece")).groupBy("lang", "piece").agg(F.count("*").alias("copies"))


def words(piece: str) -> Column:
    """The words of a piece that neither begins nor ends with a blank."""
    return F.split(piece, BLANKS)


def lexicon(found: DataFrame) -> tuple[DataFrame, int]:
    """(word, lang, text, f) of every word, and the seed of its 64-bit ids.

    Where two words had one id, the ids are drawn anew: they are never taken for one another.
    """
    seed = 0
    while True:
        every = found.select("lang", "copies", F.explode(words("piece")).alias("text"))
        counted = every.groupBy("lang", "text").agg(F.sum("copies").alias("f"))
        known = staged(counted.withColumn("word", word_id("lang", "text", seed)), "words")
        if known.groupBy("word").count().where("count > 1").isEmpty():
            return known, seed
        seed += 1


def word_id(lang: str | Column, text: str | Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), lang, text)


def key(*ids: str) -> Column:
    """One 64-bit key of a group of words; equal keys of different groups only spare no work."""
    return F.col(ids[0]) if len(ids) == 1 else F.xxhash64(*ids)


def only_frequent(rows: DataFrame, ids: list[str], frequent: DataFrame) -> DataFrame:
    """The rows whose words `ids` form a group of `frequent` (and perhaps a few more)."""
    kept = frequent.select(key(*frequent.columns[: len(ids)]).alias("_key"))
    # at most SMALL 64-bit keys are broadcast; beyond, the semi-join is a shuffle, split on skew
    kept = F.broadcast(kept) if frequent.count() <= SMALL else kept
    return rows.withColumn("_key", key(*ids)).join(kept, "_key", "left_semi").drop("_key")


# joins take relations bucketed by `deal` as they lie though it is one of several keys, and sorted
# as they are written, where each bucket is one file
AS_THEY_LIE = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
}


# what a table was shuffled through goes from the disks when the table is written
NO_OLD_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def with_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def co_partitioned(spark: SparkSession) -> AbstractContextManager[None]:
    return with_settings(spark, AS_THEY_LIE)


class Relations:
    """Occurrence relations written as bucketed, sorted tables in the shared folder."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.paths: dict[str, str] = {}

    def write(self, rows: DataFrame) -> DataFrame:
        name = f"occurrences_{uuid.uuid4().hex}"
        self.paths[name] = new_path(self.spark, name)
        writer = rows.write.format("parquet").option("path", self.paths[name])
        writer.bucketBy(self.buckets, "deal").sortBy("deal", "piece", "pos").saveAsTable(name)
        return self.spark.table(name)

    def drop(self) -> None:
        """Forget the tables and delete their files; what was counted from them is staged."""
        self.keep_last(0)

    def keep_last(self, tables: int) -> None:
        """Drop all tables but so many of those written last."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in list(self.paths)[: len(self.paths) - tables]:
            self.spark.sql(f"drop table if exists {name}")
            folder = jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            folder.getFileSystem(conf).delete(folder, True)


def single_words(found: DataFrame, seed: int, relations: Relations) -> DataFrame:
    """Each place of a word in a distinct piece of several words."""
    deal = F.pmod(F.xxhash64("lang", "piece"), F.lit(relations.buckets * DEALS)).cast("int")
    # sorted while they are pieces, so that the words come in the order they are written in
    several = found.where((F.instr("piece", " ") > 0) | (F.instr("piece", "\t") > 0))
    dealt = several.withColumn("deal", deal).repartition(relations.buckets, "deal").sortWithinPartitions("deal")
    # numbers the pieces of a task, which has all of a deal; set before the words are listed
    dealt = dealt.withColumn("id", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    each = dealt.select("deal", "id", "lang", "copies", F.posexplode(words("piece")).alias("pos", "text"))
    return each.select("deal", F.col("id").alias("piece"), "pos", word_id("lang", "text", seed).alias("w1"), "copies")


def extend(rows: DataFrame, size: int) -> DataFrame:
    """Occurrences of `size` words made one longer: those at the next position end with the new word."""
    following = rows.select("deal", "piece", (F.col("pos") - 1).alias("pos"), F.col(f"w{size}").alias(f"w{size + 1}"))
    return rows.hint("merge").join(following, ["deal", "piece", "pos"])


def count_groups(rows: DataFrame, size: int, least: int) -> DataFrame:
    """(w1 .. w<size>, f) of the groups with `least` occurrences or more, staged."""
    ids = [f"w{k + 1}" for k in range(size)]
    counted = rows.groupBy(*ids).agg(F.sum("copies").alias("f")).where(F.col("f") >= least)
    return staged(counted, f"groups_{size}")


def frequent_groups(docs: DataFrame, least: int, longest: int) -> tuple[DataFrame, dict[int, DataFrame]]:
    """The words, and for each length up to `longest` the frequent groups (w1 .., f)."""
    spark = docs.sparkSession
    found = staged(pieces(docs), "pieces")
    known, seed = lexicon(found)
    groups = {1: staged(known.where(F.col("f") >= least).select(F.col("word").alias("w1"), "f"), "groups_1")}
    relations = Relations(spark)
    try:
        with co_partitioned(spark):
            rows = only_frequent(single_words(found, seed, relations), ["w1"], groups[1])
            for size in range(1, longest):
                rows = relations.write(rows)
                relations.keep_last(1)  # longer phrases are made from the last
                grown = extend(rows, size)
                groups[size + 1] = count_groups(grown, size + 1, least)
                rows = only_frequent(grown, [f"w{k + 1}" for k in range(size + 1)], groups[size + 1])
    finally:
        relations.drop()
    return known, groups


def cuts(groups: dict[int, DataFrame], words_: DataFrame, size: int) -> DataFrame:
    """(lang, w1 .., a, l, r, score): for each candidate of `size` words its lowest-scoring cut."""
    ids = [f"w{k + 1}" for k in range(size)]
    rows = groups[size].withColumnRenamed("f", "a")
    for k in range(1, size):
        for name, own in ((f"l{k}", ids[:k]), (f"r{k}", ids[k:])):
            part = words_ if len(own) == 1 else groups[len(own)]
            renamed = [F.col(f"w{i + 1}").alias(w) for i, w in enumerate(own)]
            lang = ["lang"] if own == ids[:1] else []
            rows = rows.join(part.select(*renamed, F.col("f").alias(name), *lang), own)
    whole = "decimal(19,0)"  # products have up to 38 digits
    scored = []
    for k in range(1, size):
        score = F.expr(f"(cast(a as {whole}) * a * 1000000) div (cast(l{k} as {whole}) * r{k})")
        scored.append(F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
    best = F.array_min(F.array(*scored))
    return rows.select("lang", *ids, "a", best["l"].alias("l"), best["r"].alias("r"), best["score"].alias("score"))


def within(longer: DataFrame, size: int, inner: int) -> DataFrame:
    """(w1 .. w<inner>, most): the largest count of a group of `size` words around each inner one."""
    parts = [
        F.struct(*(F.col(f"w{start + k + 1}").alias(f"w{k + 1}") for k in range(inner)))
        for start in range(size - inner + 1)
    ]
    inside = longer.select("f", F.explode(F.array(*parts)).alias("p")).select("p.*", "f")
    return inside.groupBy(*(f"w{k + 1}" for k in range(inner))).agg(F.max("f").alias("most"))


def candidates(groups: dict[int, DataFrame], words_: DataFrame, share: int) -> DataFrame:
    """(lang, ids, a, l, r, score) of every candidate that no longer one covers."""
    out = None
    for size in range(2, max(groups) + 1):
        ids = [f"w{k + 1}" for k in range(size)]
        rows = groups[size]
        for longer in range(size + 1, max(groups) + 1):
            covered = within(groups[longer], longer, size)
            rows = rows.join(covered, ids, "left").where(
                f"most is null or cast(most as decimal(20,0)) * 100 < cast(f as decimal(20,0)) * {share}"
            ).drop("most")
        rows = cuts({**groups, size: rows}, words_, size)
        rows = rows.select("lang", F.array(*ids).alias("ids"), "a", "l", "r", "score")
        out = rows if out is None else out.unionByName(rows)
    return out


def leading(rows: DataFrame, top: int) -> DataFrame:
    """Rows that can be among the first `top` of their language: by score and count, ties all kept.

    Ranked in salted parts before the whole.
    """
    order = (F.desc("score"), F.desc("a"))
    for by in (["lang", "_salt"], ["lang"]):
        place = F.rank().over(Window.partitionBy(*by).orderBy(*order))
        rows = rows.withColumn("_salt", F.pmod(F.xxhash64("ids"), F.lit(SALTS))).withColumn("_place", place)
        rows = rows.where(F.col("_place") <= top).drop("_salt", "_place")
    return rows


def spelt(rows: DataFrame, known: DataFrame) -> DataFrame:
    """`rows` with `phrase`, their words joined; only the words of these rows are looked up."""
    each = rows.select("ids", F.posexplode("ids").alias("k", "word"))
    texts = each.join(known.select("word", "text"), "word").groupBy("ids").agg(
        F.sort_array(F.collect_list(F.struct("k", "text"))).alias("words")  # two or three a phrase
    )
    phrase = F.array_join(F.transform("words", lambda w: w["text"]), " ").alias("phrase")
    return rows.join(texts.select("ids", phrase), "ids").drop("ids")


def collocations(docs: DataFrame, least: int = LEAST, share: int = SHARE, top: int = TOP, longest: int = LONGEST) -> DataFrame:
    """Each language's strongest phrases: lang, rank, phrase, a, l, r, n, score.

    A null text is an empty one, a null lang is `und`; documents that repeat count each time. Ties
    are ordered by the phrase. Texts of any length are split whole. An empty table, or one without
    a frequent phrase, gives an empty result. Columns other than text and lang are not read.
    """
    with with_settings(docs.sparkSession, NO_OLD_SHUFFLES):
        known, groups = frequent_groups(docs.select("lang", "text"), least, longest)
    totals = known.groupBy("lang").agg(F.sum("f").alias("n"))
    words_ = known.where(F.col("f") >= least).select(F.col("word").alias("w1"), "lang", "f")
    best = spelt(staged(leading(candidates(groups, words_, share), top), "leading"), known)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

"""I-Match fingerprints with column functions only.

A document's terms are its lower-cased runs of letters and digits. The terms' hashes divide the
whole lexicon into `SUBSETS` random subsets of one term in `RATES[0]`; as many subsets of one in
`RATES[1]` are drawn besides, so that long texts too have subsets with few of their terms. Terms
whose document frequency lies in a band are kept; each subset's distinct terms are sorted and hashed.

Copies do not make a term common: a term that is in too many rows leaves the lexicon only if it is
in as large a share of the texts' signatures, which near copies mostly have in common.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortforge.llm.shared import staged

NOT_TERM = r"[^\p{L}\p{N}]+"
SUBSETS = 128  # of each rate: at the first, every term is in one
RATES = (128, 1024)
LEAST_DOCS = 2  # rows a term must occur in at least; a rarer one is in one row only
MOST_SHARE = 0.25  # share of all documents it may occur in
RAREST = 8  # terms above the band that stand for a text that has no others
SHINGLE = 5  # words of the run that signs a text
ERROR = 0.02  # standard error of the share of signatures
DIGEST_BITS, TERM_BITS = 20, 48
LEAST_BUCKETS, MOST_BUCKETS = 1024, 16_384  # of neighbouring documents
STRIDE = 128


def subset(term: Column, level: int) -> Column:
    """The subset of a level a term hash falls in; `SUBSETS` and above: none."""
    return F.pmod(F.shiftright(term, 20 * level), F.lit(RATES[level]))


def word_hashes(text: Column) -> Column:
    """The hashes of a text's words, in order."""
    return F.transform(F.array_remove(F.split(F.lower(text), NOT_TERM), ""), lambda w: F.xxhash64(w))


def distinct_terms(text: Column) -> Column:
    """The distinct hashes of a text's terms."""
    words = F.array_remove(F.array_distinct(F.split(F.lower(text), NOT_TERM)), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def signature(words: str) -> Column:
    """The least hash of a run of five words, which near copies mostly share; of a shorter text, of all."""
    runs = F.transform(
        words,
        lambda w, i: F.when(
            (i == 0) | (i <= F.size(words) - SHINGLE),
            F.xxhash64(w, *(F.get(F.col(words), i + k) for k in range(1, SHINGLE))),  # null past the end
        ),
    )
    return F.coalesce(F.array_min(runs), F.lit(0))


def too_many(total: Column) -> Column:
    return F.greatest(F.lit(LEAST_DOCS), total * MOST_SHARE)


def lexicon(docs: DataFrame) -> DataFrame:
    """(term, docs, doc_id, hash): all terms and the rows they are in.

    A term below the band is in the one row that doc_id and hash, its text's, name.
    """
    text = F.coalesce("text", F.lit(""))
    terms = docs.select("doc_id", F.xxhash64(text).alias("hash"), F.explode(distinct_terms(text)).alias("term"))
    return terms.groupBy("term").agg(
        F.count("*").alias("docs"), F.min("doc_id").alias("doc_id"), F.min("hash").alias("hash")
    )


def common_terms(docs: DataFrame, seen: DataFrame) -> DataFrame:
    """One row, `common`: the terms above the band, the rarer first.

    Those of more than a share of the rows are few: no more than a text's mean number of terms over
    the share. Of these, the ones in a share of the signatures are above the band.
    """
    total = docs.agg(too_many(F.count("*")).alias("most"))  # one row
    often = seen.join(F.broadcast(total)).where("docs > most").select("term", "docs")
    often = staged(often, "often")
    listed = F.broadcast(often.agg(F.collect_list("term").alias("listed")))
    words = docs.select(word_hashes(F.coalesce("text", F.lit(""))).alias("words")).join(listed)
    # the null stands for any term
    marks = F.concat(F.array(F.lit(None).cast("long")), F.array_intersect("listed", "words"))
    signed = words.select(signature("words").alias("signature"), marks.alias("marks")).select("signature", F.explode("marks").alias("term"))
    shares = staged(signed.groupBy("term").agg(F.approx_count_distinct("signature", ERROR).alias("signatures")), "shares")
    every = shares.where("term is null").select(too_many(F.col("signatures")).alias("most"))
    above = shares.join(F.broadcast(every)).where("term is not null and signatures > most")
    kept = often.join(above.select("term"), "term").agg(F.sort_array(F.collect_list(F.struct("docs", "term"))).alias("kept"))
    return kept.select(F.transform("kept", lambda k: k["term"]).alias("common"))


def bucketing(docs: DataFrame) -> Callable[[Column, Column], Column]:
    """The bucket of a document by its id, or by its text's hash where it has none.

    Buckets hold neighbouring ids and about as many rows each, however the ids are spread.
    """
    wished = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 16
    n = max(LEAST_BUCKETS, min(MOST_BUCKETS, wished))
    found = docs.agg(F.approx_percentile("doc_id", [k / n for k in range(1, n)], 10 * n)).first()[0]
    bounds = sorted(set(found or []))  # under MOST_BUCKETS numbers

    def listed(values: list[int]) -> Column:
        return F.expr(f"array({', '.join(f'{v}L' for v in values)})")

    def bucket(doc_id: Column, text_hash: Column) -> Column:
        loose = F.pmod(text_hash, F.lit(n)).cast("int")
        if not bounds:
            return F.when(doc_id.isNull(), loose).otherwise(0)
        # how many bounds are not over the id: first in strides, then in the last of them
        strides = F.size(F.filter(listed(bounds[::STRIDE]), lambda b: b <= doc_id))
        start = F.greatest(strides - 1, F.lit(0)) * STRIDE
        rest = F.size(F.filter(F.slice(listed(bounds), start + 1, STRIDE), lambda b: b <= doc_id))
        return F.when(doc_id.isNull(), loose).otherwise(start + rest)

    return bucket


def with_next(docs: DataFrame, bucket: Callable[[Column, Column], Column]) -> DataFrame:
    """Each document's text and terms beside the next one's in descending doc_id.

    Columns: doc_id, bucket, alone (no id), text, hash, terms, next_id, next_text, next_terms.

    Buckets of ids are ordered each in a task; the first document of the next bucket is copied to
    the end of this one. Repeated ids are ordered by text. Rows without an id have no next one.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        text.alias("text"),
        bucket(F.col("doc_id"), F.xxhash64(text)).alias("bucket"),
        F.col("doc_id").isNull().alias("alone"),
        F.lit(0).alias("copy"),
    )
    ids = docs.where("doc_id is not null").select("doc_id", bucket(F.col("doc_id"), F.lit(0)).alias("target"))
    heads = staged(ids.groupBy("target").agg(F.max("doc_id").alias("head")), "heads")
    # a row for each bucket: a bounded number
    after = F.coalesce(F.lead("head").over(Window.orderBy(F.desc("head"))), F.max("head").over(Window.partitionBy()))
    wanted = F.broadcast(heads.select("target", after.alias("doc_id")))
    first = docs.select("doc_id", text.alias("text")).join(wanted, "doc_id").groupBy("doc_id", "target").agg(F.min("text").alias("text"))
    copied = first.select("doc_id", "text", F.col("target").alias("bucket"), F.lit(False).alias("alone"), F.lit(1).alias("copy"))
    # dealt out before the terms are listed, as the window needs it
    dealt = rows.unionByName(copied).repartition("bucket", "alone")
    listed = dealt.withColumns({"hash": F.xxhash64("text"), "terms": distinct_terms(F.col("text"))})
    ordered = Window.partitionBy("bucket", "alone").orderBy("copy", F.desc("doc_id"), "text")
    beside = {
        f"next_{new}": F.when(~F.col("alone"), F.lead(name).over(ordered))
        for new, name in {"id": "doc_id", "text": "text", "hash": "hash", "terms": "terms"}.items()
    }
    return listed.withColumns(beside).where("copy = 0").drop("copy")


def edited_text(text: Column, following_text: Column) -> Column:
    """The last half of the code points replaced by as many of the next document's first."""
    half = F.floor(F.length(text) / 2).cast("int")
    kept = F.substr(text, F.lit(1), F.length(text) - half)
    return F.concat(kept, F.substr(F.coalesce(following_text, F.lit("")), F.lit(1), half))


def banded(rows: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """The terms of these columns in the band; if there are none, those below it, or the rarest of those above.

    Takes the columns `rare` and `common` of terms below and above the band, and drops them.
    """
    inside = {f"_{name}": F.array_except(name, F.concat("rare", "common")) for name in names}

    def kept(name: str) -> Column:
        below = F.array_intersect(name, "rare")
        above = F.slice(F.array_intersect("common", name), 1, RAREST)
        return F.when(F.size(f"_{name}") > 0, F.col(f"_{name}")).when(F.size(below) > 0, below).otherwise(above)

    return rows.withColumns(inside).withColumns({name: kept(name) for name in names}).drop("rare", "common", *inside)


def subset_codes(terms: Column) -> Column:
    """For each subset that has terms, its number and, in the low bits, the hash of its sorted terms."""
    low = (1 << TERM_BITS) - 1

    def drawn(level: int) -> Column:
        own = F.filter(terms, lambda h: subset(h, level) < SUBSETS)
        number = lambda h: (subset(h, level) + level * SUBSETS).cast("long")
        return F.transform(own, lambda h: F.shiftleft(number(h), TERM_BITS) + h.bitwiseAND(low).bitwiseOR(F.lit(1)))

    # a mark with no low bits comes before each subset's terms
    marks = F.expr(f"transform(sequence(0L, {len(RATES) * SUBSETS - 1}L), k -> shiftleft(k, {TERM_BITS}))")
    in_order = F.sort_array(F.concat(marks, *map(drawn, range(len(RATES)))))
    part = lambda e: e.bitwiseAND(low)
    pieces = F.transform(in_order, lambda e: F.when(part(e) == 0, "|").otherwise(F.concat(F.lit(","), part(e).cast("string"))))
    joined = F.split(F.substr(F.array_join(pieces, ""), F.lit(2)), r"\|")
    digest = lambda own: F.xxhash64(own).bitwiseAND((1 << DIGEST_BITS) - 1)
    codes = F.transform(
        joined, lambda own, k: F.when(own != "", F.shiftleft(k.cast("long"), DIGEST_BITS) + digest(own))
    )
    return F.array_compact(codes)


def fingerprint(codes: Column, text_hash: Column) -> Column:
    """The codes of all subsets with terms, joined; a text without a term has its own hash instead."""
    own = F.concat(F.lit("text:"), F.hex(text_hash))
    return F.when(F.size(codes) > 0, F.array_join(F.transform(codes, lambda c: F.hex(c)), "-")).otherwise(own)


def likeness(a: Column, b: Column) -> Column:
    """Of the subsets that either has terms in, the share that agree: 0 to 1; texts without a term: 0.

    The rate with the larger share counts: dense subsets tell short texts apart, sparse ones long.
    """

    def share(level: int) -> Column:
        first, last = (level * SUBSETS) << DIGEST_BITS, ((level + 1) * SUBSETS) << DIGEST_BITS
        one, other = (F.filter(c, lambda x: (x >= first) & (x < last)) for c in (a, b))
        number = lambda codes: F.transform(codes, lambda x: F.shiftright(x, DIGEST_BITS))
        either = F.size(F.array_union(number(one), number(other)))
        return F.coalesce(F.size(F.array_intersect(one, other)) / F.nullif(either, F.lit(0)), F.lit(0.0))

    return F.greatest(*(share(level) for level in range(len(RATES))))


def cut_words(text: Column, following_text: Column) -> Column:
    """The words, with what touches them, at the edited text's cut and at its end: all others are whole ones."""
    half = F.floor(F.length(text) / 2).cast("int")
    head = F.substr(F.coalesce(following_text, F.lit("")), F.lit(1), half)
    backwards = F.reverse(F.substr(text, F.lit(1), F.length(text) - half))
    unspaced = lambda c: F.regexp_extract(c, r"^[^\x20\x09-\x0D]*", 0)
    before, after, end = F.reverse(unspaced(backwards)), unspaced(head), F.reverse(unspaced(F.reverse(head)))
    # the whole head may be a part of the word at the cut
    return F.concat(before, after, F.lit(" "), F.when(end == head, "").otherwise(end))


def below_band(rows: DataFrame, seen: DataFrame, bucket: Callable[[Column, Column], Column]) -> DataFrame:
    """(bucket, alone, id, hash, rare): the terms below the band that a row may meet.

    They are in its text, in the next one, or come up where its edited text is cut.
    """
    new = distinct_terms(cut_words(F.col("text"), F.col("next_text")))
    joints = rows.select("doc_id", "hash", "next_id", "next_hash", new.alias("new"))
    cut = joints.select("doc_id", "hash", F.explode("new").alias("term"))
    cut = cut.join(seen.where(F.col("docs") >= LEAST_DOCS).select("term"), "term", "left_anti")
    own = seen.where(F.col("docs") < LEAST_DOCS).select("doc_id", "hash", "term")
    before = joints.select("doc_id", "hash", "next_id", "next_hash").where("next_id is not null").distinct()
    following = own.withColumnsRenamed({"doc_id": "next_id", "hash": "next_hash"}).join(before, ["next_id", "next_hash"])
    every = own.unionByName(following.select("doc_id", "hash", "term")).unionByName(cut.select("doc_id", "hash", "term"))
    each = every.groupBy("doc_id", "hash").agg(F.collect_set("term").alias("rare"))  # a text's own terms
    return each.select(
        bucket(F.col("doc_id"), F.col("hash")).alias("bucket"),
        F.col("doc_id").isNull().alias("alone"),
        F.coalesce("doc_id", F.lit(0)).alias("id"),
        "hash",
        "rare",
    )


def compare(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, both fingerprints, near_edited and near_next.

    A null text is an empty one. Repeated rows are rows of their own, in the order of their texts.
    A row without doc_id has no next document: its edited text is cut, and near_next is 0. An empty
    table gives an empty result. Texts without a term are alike only if they are equal.

    The texts are shuffled once: what the lexicon says of a row comes to where its text lies.
    """
    docs = docs.select("doc_id", "text")
    # the join below takes rows as they are dealt, by two of its four keys
    docs.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    seen = staged(lexicon(docs), "lexicon")
    common = F.broadcast(staged(common_terms(docs, seen), "common"))  # one row
    bucket = bucketing(docs)
    rows = with_next(docs, bucket)
    rare = below_band(rows, seen, bucket)
    edited = edited_text(F.col("text"), F.col("next_text"))
    own = rows.withColumn("edited", edited).select(
        "doc_id",
        "bucket",
        "alone",
        F.coalesce("doc_id", F.lit(0)).alias("id"),
        "hash",
        "next_hash",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.xxhash64("edited").alias("edited_hash"),
        "terms",
        "next_terms",
        distinct_terms(F.col("edited")).alias("new_terms"),
    )
    known = own.join(rare, ["bucket", "alone", "id", "hash"], "left").join(common)
    known = known.withColumn("rare", F.coalesce("rare", F.array().cast("array<long>")))
    names = ("terms", "next_terms", "new_terms")
    known = banded(known, names).withColumns({name: subset_codes(F.col(name)) for name in names})
    known = known.withColumns(
        {
            "fingerprint": fingerprint(F.col("terms"), F.col("hash")),
            "edited_fingerprint": fingerprint(F.col("new_terms"), F.col("edited_hash")),
            "next_fingerprint": fingerprint(F.col("next_terms"), F.col("next_hash")),
        }
    )

    def near(codes: str, prints: str) -> Column:
        equal = F.col("fingerprint") == F.col(prints)
        return F.when(F.col("next_hash").isNull() & F.lit(codes == "next_terms"), 0.0).when(equal, 1.0).otherwise(
            likeness(F.col("terms"), F.col(codes))
        )

    return known.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        near("new_terms", "edited_fingerprint").alias("near_edited"),
        near("next_terms", "next_fingerprint").alias("near_next"),
    )

"""Benchmark passages in training documents: rare seeds, then Smith-Waterman alignment.

A seed is two words of an item, next to each other or with one word between, found so in a document.
Of an alignment that reaches the least score, so many item words begin such a pair that an item's
commonest seeds can be left out: the rest, its rarest, miss none.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortforge.llm.shared import BITS, bitmap, may_hold, staged, text_slices
from cohortforge.llm.words import STEP_SEED, mix, ngram_hashes, word_hashes

MATCH, MISMATCH, GAP = 2, -1, -1
ALIGNED = 0.4  # share of a whole item's score from which a document is contaminated
SHORT = 2  # words up to which an item is found only as a whole
MOST_BITS = 1 << 26

def seeds_of(hashes: np.ndarray, owner: np.ndarray, short: Iterable[int]) -> tuple[np.ndarray, ...]:
    """(seeds, where each begins, 0 for a pair of words or the size of an n-gram) of many texts."""
    grams, places, kinds = [], [], []
    with np.errstate(over="ignore"):
        first, second = mix(hashes, 101), mix(hashes, 102) * np.uint64(3)
        for between in (1, 2):
            at = np.flatnonzero(owner[:-between] == owner[between:])
            # one key for both distances, so an edit between the two words does not matter
            grams.append(mix(first[at] + second[at + between], STEP_SEED))
            places.append(at)
            kinds.append(np.zeros(len(at), np.int8))
    for size in short:
        at = np.flatnonzero(owner[: max(0, len(owner) - size + 1)] == owner[size - 1 :])
        grams.append(~ngram_hashes(hashes, size)[at])
        places.append(at)
        kinds.append(np.full(len(at), size, np.int8))
    return np.concatenate(grams), np.concatenate(places), np.concatenate(kinds)


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, word hashes, first word of each text and the end, text of each word), by slices."""
    for batch in batches:
        for a, b in text_slices(batch.column(1)):
            part = batch.slice(a, b - a)
            hashes, starts = word_hashes(part.column(1).to_pylist(), marks=False)
            ids = part.column(0).to_numpy(zero_copy_only=False)
            yield ids, hashes, starts, np.repeat(np.arange(len(ids)), np.diff(starts))


def _item_seeds(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """An item's pairs of words with their places; a short item is one n-gram."""
    for ids, hashes, starts, owner in _texts(batches):
        grams, at, kinds = seeds_of(hashes, owner, range(1, SHORT + 1))
        words = np.diff(starts)[owner[at]]
        own = kinds == np.where(words <= SHORT, words, 0)
        doc = owner[at[own]]
        columns = [ids[doc], grams[own].view(np.int64), (at[own] - starts[doc]).astype(np.int32), words[own].astype(np.int32)]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["key", "gram", "at", "words"])


def _hits(
    batches: Iterable[pa.RecordBatch], held: np.ndarray, short: list[int], count: bool
) -> Iterator[pa.RecordBatch]:
    """Seeds that the bitmap may hold, in documents: with their places, or how many of each."""
    for ids, hashes, starts, owner in _texts(batches):
        grams, at, _ = seeds_of(hashes, owner, short)
        may = may_hold(held, grams)
        grams, at = grams[may], at[may]
        if count:
            found, n = np.unique(grams, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], ["gram", "n"])
        else:
            doc = owner[at]
            columns = [ids[doc], grams.view(np.int64), (at - starts[doc]).astype(np.int32)]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["id", "gram", "pos"])


def align(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman over words: the best score, and where in `region` it starts and ends."""
    columns = np.arange(len(region) + 1)
    score = np.zeros(len(region) + 1, np.int64)
    start = columns.copy()
    best = (0, 0, 0)
    for word in item:
        step = np.where(region == word, MATCH, MISMATCH)
        diagonal = score[:-1] + step
        down = score[1:] + GAP
        new = np.zeros_like(score)
        new[1:] = np.maximum(0, np.maximum(diagonal, down))
        origin = columns.copy()
        origin[1:] = np.where(new[1:] == 0, columns[1:], np.where(diagonal >= down, start[:-1], start[1:]))
        # a gap along the row: the best of all earlier cells less what the way costs
        level = new - GAP * columns
        reach = np.maximum.accumulate(level)
        from_cell = np.maximum.accumulate(np.where(level == reach, columns, 0))
        score, start = np.maximum(0, reach + GAP * columns), origin[from_cell]
        end = int(score.argmax())
        if score[end] > best[0]:
            best = (int(score[end]), int(start[end]), end)
    return best


def reachable(item: np.ndarray, region: np.ndarray) -> int:
    """No alignment scores more: item words that the region lacks cost a mismatch or a gap each."""
    gain = np.where(np.isin(item, region), MATCH, max(MISMATCH, GAP))
    total = np.concatenate([[0], np.cumsum(gain)])
    return int((total - np.minimum.accumulate(total)).max())


def regions(diagonals: list[int], words: int, length: int, least: float) -> list[tuple[int, int]]:
    """Stretches of a document in which an item with seeds on these diagonals may lie.

    An alignment of at least `least` has no more gaps on either side of a seed than its score spares.
    """
    spare = int((1 - least) * MATCH * words / -GAP) + 2
    out: list[list[int]] = []
    for d in sorted(set(diagonals)):
        low, high = max(0, d - spare), min(length, d + words + spare)
        if out and low <= out[-1][1]:
            out[-1][1] = max(high, out[-1][1])
        else:
            out.append([low, high])
    return [(a, b) for a, b in out]


ALIGNMENTS = "doc_id long, item_id long, score double, start_word int, end_word int"


def _align(batches: Iterable[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Rows of (doc_id, text, pairs): alignments of at least `least` of an item's own score."""
    for batch in batches:
        for a, b in text_slices(batch.column(1)):
            rows = batch.slice(a, b - a).to_pylist()
            hashes, starts = word_hashes([r["text"] for r in rows], marks=False)
            names = {p["key"]: p["item"] for r in rows for p in r["pairs"]}
            item_hashes, item_starts = word_hashes(list(names.values()), marks=False)
            place = {i: (item_starts[k], item_starts[k + 1]) for k, i in enumerate(names)}
            out = []
            for k, row in enumerate(rows):
                words = hashes[starts[k] : starts[k + 1]]
                for pair in row["pairs"]:
                    item = item_hashes[slice(*place[pair["key"]])]
                    best, needed = (0, 0, 0), least if len(item) > SHORT else 1.0
                    for low, high in regions(pair["diagonals"], len(item), len(words), needed):
                        if reachable(item, words[low:high]) < needed * MATCH * len(item):
                            continue
                        s, first, end = align(item, words[low:high])
                        best = max(best, (s, low + first, low + end), key=lambda x: x[0])
                    score = best[0] / (MATCH * len(item))
                    if score >= needed:
                        out.append((row["doc_id"], pair["item_id"], score, best[1], best[2]))
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32()]
            names5 = ["doc_id", "item_id", "score", "start_word", "end_word"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names5)


def _only(batches: Iterable[pa.RecordBatch], held: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        yield batch.filter(pa.array(may_hold(held, ids)))


def chosen_seeds(items: DataFrame, counts: DataFrame, least: float) -> DataFrame:
    """(gram, key, at): of each item the seeds of its rarest words in documents, enough to miss nothing.

    Of consecutive aligned words, those two or more gaps or mismatches apart gain nothing: a score
    of `least` needs least * words - 1 pairs that are closer, each a seed that begins at another
    word of the item. So of its words - 1 beginnings all but that many, and one, are looked up.
    """
    rarity = items.join(counts, "gram", "left").groupBy("key", "at", "words").agg(
        F.sum(F.coalesce("n", F.lit(0))).alias("n"), F.collect_set("gram").alias("grams")  # two at most
    )
    close = F.greatest(F.lit(1), F.ceil(F.col("words") * least - 1 - 1e-9))
    place = F.row_number().over(Window.partitionBy("key").orderBy("n", "at"))
    rare = rarity.withColumn("k", place).where((F.col("words") <= SHORT) | (F.col("k") <= F.col("words") - close))
    return rare.select(F.explode("grams").alias("gram"), "key", "at")


def bits_for(rows: int) -> int:
    """Bits of a bitmap that passes few others than `rows` keys; bounded, as the join behind is exact."""
    return min(MOST_BITS, max(BITS, 1 << (16 * rows).bit_length()))


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = ALIGNED) -> DataFrame:
    """Pairs of a document and a benchmark item it contains, copied or edited.

    doc_id, item_id, score (share of the score of a whole copy), start_word and end_word (the
    aligned words of the document, end exclusive), for scores of `least` up: all such pairs are
    found. Words are compared without case and ASCII punctuation. Items of one or two words are
    found only as a whole; null or empty ones never. Documents and items without an id are left out;
    of rows that repeat an id each text is compared, and the best score counts. Empty tables give
    an empty result.
    """
    key = F.xxhash64("item_id", "text").alias("id")
    texts_of = benchmark.where("item_id is not null and text is not null").select(key, "item_id", "text").distinct()
    items = staged(texts_of, "items")
    layout = "key long, gram long, at int, words int"
    seeds = staged(items.select("id", "text").mapInArrow(_item_seeds, layout), "seeds")
    short = [r["words"] for r in seeds.where(F.col("words") <= SHORT).select("words").distinct().collect()]
    texts = docs.select(F.col("doc_id").alias("id"), "text").where("id is not null and text is not null")
    number = seeds.select("gram").distinct().count()
    every = partial(_hits, held=bitmap(seeds, "gram", bits_for(number)), short=short, count=True)
    counts = texts.mapInArrow(every, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    chosen = staged(chosen_seeds(seeds, counts, least), "chosen")
    rare = partial(_hits, held=bitmap(chosen, "gram", bits_for(number)), short=short, count=False)
    hits = texts.mapInArrow(rare, "id long, gram long, pos int")
    pairs = (
        hits.join(chosen, "gram")
        .groupBy("id", "key")
        .agg(F.collect_set(F.col("pos") - F.col("at")).alias("diagonals"))
        .join(items.select(F.col("id").alias("key"), "item_id", F.col("text").alias("item")), "key")
    )
    found = staged(
        pairs.groupBy("id").agg(F.collect_list(F.struct("key", "item_id", "item", "diagonals")).alias("pairs")), "pairs"
    )
    # the bitmap spares the other documents' texts the shuffle; the join is exact
    held = bitmap(found, "id", bits_for(found.count()))
    near = texts.mapInArrow(partial(_only, held=held), "id long, text string")
    aligned = near.join(found, "id").select(F.col("id").alias("doc_id"), "text", "pairs")
    rows = aligned.mapInArrow(partial(_align, least=least), ALIGNMENTS)
    best = F.max_by(F.struct("score", "start_word", "end_word"), F.struct("score", -F.col("start_word")))
    return rows.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` without those that contain a benchmark item; rows without doc_id stay."""
    found = contaminated(docs, benchmark).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)

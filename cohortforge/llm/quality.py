"""Document quality: random-indexing word vectors, pooled, then a small calibrated network.

Terms are the commonest words of the fitting sample as they are written; any other word counts as
its shape (letters, digits and marks, runs shortened), so unseen words are known by how they look.
A term that repeats the word before it is a term of its own. A term's vector is its own sparse
ternary index vector plus the index vectors of its neighbours within `WINDOW` words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.llm.shared import excerpt, text_slices

FIT_ROWS = 2000  # labelled rows a class that the model is fitted on
FIT_CHARS = 20_000  # of a text, at most, are fitted on; all texts are scored whole
LONGEST_WORD = 64  # characters; a longer run without white space is cut into such words
WORDS, SHAPES, DIMENSIONS, WINDOW, HIDDEN = 2000, 512, 64, 2, 32
THRESHOLD = 0.7
REMEMBERED = 200_000

LETTERS = re.compile(r"[^\W\d_]+")
DIGITS = re.compile(r"\d+")
RUNS = re.compile(r"(.)\1{2,}")


def shape(word: str) -> str:
    """Letters as a, Aa or A, digits as 9, other marks as they are, at most two alike in a row."""

    def letters(found: re.Match) -> str:
        run = found.group()
        return "a" if run.islower() else "A" if run.isupper() and len(run) > 1 else "Aa"

    return RUNS.sub(r"\1\1", DIGITS.sub("9", LETTERS.sub(letters, word)))


class Terms(dict):
    """Word -> term number; shapes and the vocabulary have numbers below `WORDS + SHAPES`."""

    def __init__(self, vocabulary: list[str]):
        super().__init__()
        self.known = {w: k for k, w in enumerate(vocabulary)}

    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        term = self.known.get(word)
        if term is None:
            term = WORDS + zlib.crc32(shape(word).encode("utf-8", "surrogatepass")) % SHAPES
        self[word] = term
        return term

    def of(self, text: str | None) -> np.ndarray:
        """The terms of a whole text, in order."""
        words = (text or "").split()
        if max(map(len, words), default=0) > LONGEST_WORD:
            words = [w[k : k + LONGEST_WORD] for w in words for k in range(0, len(w), LONGEST_WORD)]
        terms = np.fromiter(map(self.__getitem__, words), np.int32, len(words))
        again = np.fromiter(map(eq, words, islice(words, 1, None)), bool, max(0, len(words) - 1))
        terms[1:] += np.where(again, WORDS + SHAPES, 0).astype(np.int32)
        return terms


def index_vectors(seed: int = 5, ones: int = 4) -> np.ndarray:
    """A sparse random vector per term: `ones` places of +1 and as many of -1."""
    rng = np.random.default_rng(seed)
    out = np.zeros((2 * (WORDS + SHAPES), DIMENSIONS), np.float32)
    for row in out:
        places = rng.choice(DIMENSIONS, 2 * ones, replace=False)
        row[places[:ones]], row[places[ones:]] = 1, -1
    return out


def word_vectors(texts: list[np.ndarray], block: int = 50_000) -> np.ndarray:
    """Own index vector plus the direction of the neighbours' sum, per term."""
    index = index_vectors()
    context = np.zeros_like(index)
    gap = np.full(WINDOW, -1, np.int32)
    line = np.concatenate([x for t in texts for x in (t, gap)] or [gap])
    for offset in range(1, WINDOW + 1):
        for a, b in ((line[:-offset], line[offset:]), (line[offset:], line[:-offset])):
            real = (a >= 0) & (b >= 0)
            a, b = a[real], b[real]
            for at in range(0, len(a), block):
                own, near = a[at : at + block], b[at : at + block]
                order = np.argsort(own, kind="stable")
                terms, first = np.unique(own[order], return_index=True)
                context[terms] += np.add.reduceat(index[near[order]], first, axis=0)
    for vectors in (index, context):
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    return index + context


def pooled(texts: list[np.ndarray], vectors: np.ndarray) -> np.ndarray:
    """The mean of each text's word vectors; zeros for a text without words."""
    out = np.zeros((len(texts), vectors.shape[1]), np.float32)
    for k, terms in enumerate(texts):
        if len(terms):
            at, counts = np.unique(terms, return_counts=True)
            out[k] = (counts.astype(np.float32) @ vectors[at]) / len(terms)
    return out


@dataclass
class QualityModel:
    """What scoring needs; `share` alone scores where there was nothing to tell apart."""

    share: float
    vocabulary: list[str]
    vectors: np.ndarray | None = None
    scale: tuple[np.ndarray, np.ndarray] | None = None
    layers: tuple[np.ndarray, ...] = ()
    temperature: float = 1.0

    def probabilities(self, terms: list[np.ndarray]) -> np.ndarray:
        if self.vectors is None:
            return np.full(len(terms), self.share)
        x = (pooled(terms, self.vectors) - self.scale[0]) / self.scale[1]
        return 1 / (1 + np.exp(-np.clip(logits(x, self.layers) / self.temperature, -30, 30)))


def logits(x: np.ndarray, layers: tuple[np.ndarray, ...]) -> np.ndarray:
    w1, b1, w2, b2 = layers
    return np.tanh(x @ w1 + b1) @ w2 + b2


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 400) -> tuple[np.ndarray, ...]:
    """Two layers by Adam on the weighted logistic loss, with a little weight decay."""
    rng = np.random.default_rng(3)
    layers = [
        rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
        np.zeros(()),
    ]
    first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    for step in range(1, rounds + 1):
        hidden = np.tanh(x @ layers[0] + layers[1])
        z = np.clip(hidden @ layers[2] + layers[3], -30, 30)
        error = weight * (1 / (1 + np.exp(-z)) - y)
        back = np.outer(error, layers[2]) * (1 - hidden**2)
        slopes = [x.T @ back + 1e-3 * layers[0], back.sum(0), hidden.T @ error + 1e-3 * layers[2], error.sum()]
        for k, slope in enumerate(slopes):
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.999 * second[k] + 0.001 * slope**2
            size = 0.02 / (1 - 0.9**step) * np.sqrt(1 - 0.999**step)
            layers[k] = layers[k] - size * first[k] / (np.sqrt(second[k]) + 1e-8)
    return tuple(layers)


def calibrate(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The temperature at which held-back labels are likeliest."""

    def loss(t: float) -> float:
        p = 1 / (1 + np.exp(-np.clip(z / t, -30, 30)))
        return float(-(weight * np.where(y == 1, np.log(p + 1e-12), np.log(1 - p + 1e-12))).sum())

    return min(np.geomspace(0.25, 8, 41), key=loss)


def sample(docs: DataFrame, labels: DataFrame, rows: int, chars: int) -> tuple[list[tuple[str, int]], list[int]]:
    """At most `rows` labelled texts a class, by hash order of doc_id, and how many rows each class has.

    Of a doc_id that repeats, the text of the least hash; of a text of over `chars` characters,
    excerpts from all of it.
    """
    usable = labels.where("quality in (0, 1) and doc_id is not null")
    usable = usable.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    usable = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    counted = {r["quality"]: r["count"] for r in usable.groupBy("quality").count().collect()}
    chosen: dict[int, int] = {}
    for quality in (0, 1):
        of_class = usable.where(F.col("quality") == quality).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        chosen.update((r["doc_id"], quality) for r in of_class.select("doc_id").collect())
    texts = docs.where(F.col("doc_id").isin(list(chosen))).where("text is not null").select("doc_id", "text")
    single = texts.groupBy("doc_id").agg(F.min_by(excerpt("text", chars), F.xxhash64("text")).alias("text"))
    # in one job: at most 2 * rows texts of at most `chars` characters
    found = {r["doc_id"]: r["text"] for r in single.collect()}
    return [(found[i], chosen[i]) for i in sorted(found)], [counted.get(0, 0), counted.get(1, 0)]


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, chars: int = FIT_CHARS) -> QualityModel:
    """Fit on labelled rows whose crc32(doc_id as text) mod 4 is not 2, at most `rows` a class.

    A fifth of them is held back for the temperature. Labels other than 0 and 1 are left out; of
    contradicting labels of one document the lower counts. Where a class is missing, the score is
    the share of label 1, and 1 where there are no labels at all.
    """
    texts, counts = sample(docs, labels, rows, chars)
    y = np.array([label for _, label in texts], np.float64)
    share = counts[1] / sum(counts) if sum(counts) else 1.0
    if len(set(y.tolist())) < 2:
        return QualityModel(share, [])
    words = Counter(w for text, _ in texts for w in text.split() if len(w) <= LONGEST_WORD)
    vocabulary = [w for w, n in sorted(words.items(), key=lambda x: (-x[1], x[0]))[:WORDS] if n > 1]
    numbers = Terms(vocabulary)
    terms = [numbers.of(text) for text, _ in texts]
    vectors = word_vectors(terms)
    x = pooled(terms, vectors)
    scale = (x.mean(0), x.std(0) + 1e-3)
    x = (x - scale[0]) / scale[1]
    # classes count as often as they occur, though the sample has as many of each
    prior = np.where(y == 1, share / max(1, (y == 1).sum()), (1 - share) / max(1, (y == 0).sum()))
    held = np.arange(len(y)) % 5 == 4
    if len(set(y[~held].tolist())) < 2 or len(set(y[held].tolist())) < 2:
        held[:] = False
    layers = train(x[~held], y[~held], prior[~held] / prior[~held].sum())
    temperature = calibrate(logits(x[held], layers), y[held], prior[held]) if held.any() else 1.0
    return QualityModel(share, vocabulary, vectors, scale, layers, temperature)


def _score(
    batches: Iterable[pa.RecordBatch], model: QualityModel, text: int, out: str
) -> Iterator[pa.RecordBatch]:
    numbers = Terms(model.vocabulary)
    for batch in batches:
        for a, b in text_slices(batch.column(text)):
            part = batch.slice(a, b - a)
            scores = model.probabilities([numbers.of(t) for t in part.column(text).to_pylist()])
            columns = dict(zip(part.schema.names, part.columns))
            yield pa.RecordBatch.from_pydict({**columns, out: pa.array(scores.astype(np.float64))})


def score(docs: DataFrame, model: QualityModel, out: str = "score") -> DataFrame:
    """`docs` with `out`: the probability that the whole text is of label 1.

    Null and empty texts get the score of a text without words. Only the text is looked at; other
    columns pass through, one called as `out` is replaced. An empty table stays empty.
    """
    docs = docs.drop(out)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    work = partial(_score, model=model, text=docs.columns.index("text"), out=out)
    return docs.mapInArrow(work, ", ".join([*fields, f"`{out}` double"]))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (1 from a score of `THRESHOLD` up)."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    return scored.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` without those of a score under `THRESHOLD`."""
    scored = score(docs, fit(docs, labels), "__quality__")
    return scored.where(F.col("__quality__") >= THRESHOLD).drop("__quality__")

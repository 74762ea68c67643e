"""Language identification by a convolutional network over bytes.

A text's UTF-8 bytes are cut into windows of `LENGTH` bytes. Filters of several widths run over
each window, the largest answer of each filter is kept, and a softmax layer names the language. A
document's language is the one with the largest mean log-probability over all its windows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortforge.llm.shared import excerpt, text_slices

LENGTH = 256  # bytes of a window; the last one of a text is padded
WIDTHS = (2, 3, 4)
FILTERS = 16  # of each width
EMBEDDING = 8
BATCH = 64  # windows scored at once; their answers fit a core's cache

FIT_ROWS = 300  # rows a language that the network is fitted on
FIT_WINDOWS = 4  # windows of each, spread over its text
FIT_CHARS = 20_000  # of a text, at most, are fitted on; all texts are scored whole
ROUNDS, STEP = 12, 0.01

PAD = 256
LETTERS = r"\p{L}"
UNDETERMINED = "und"


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(windows, first window of each text and the end); a text has one window at least."""
    counts = np.array([max(1, -(-len(t) // LENGTH)) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(counts)])
    out = np.full(starts[-1] * LENGTH, PAD, np.int16)
    for t, start in zip(texts, starts.tolist()):
        out[start * LENGTH : start * LENGTH + len(t)] = np.frombuffer(t, np.uint8)
    return out.reshape(-1, LENGTH), starts


@dataclass
class LanguageModel:
    """Byte embedding, filters by width, and the softmax layer over their largest answers."""

    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    dense: np.ndarray
    offset: np.ndarray

    def features(self, batch: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The largest answer of every filter in every window, and the places of those answers."""
        values, places = [], []
        for width, weights, bias in zip(WIDTHS, self.filters, self.biases):
            answers = self.convolve(batch, width, weights)
            at = answers.argmax(axis=1)
            best = np.take_along_axis(answers, at[:, None, :], axis=1)[:, 0, :]
            values.append(np.maximum(best + bias, 0))
            places.append(at)
        return np.concatenate(values, axis=1), places

    def convolve(self, batch: np.ndarray, width: int, weights: np.ndarray) -> np.ndarray:
        seen = self.embedding[batch].reshape(len(batch), -1)
        size = LENGTH - width + 1
        patches = np.lib.stride_tricks.sliding_window_view(seen, width * EMBEDDING, axis=1)[:, ::EMBEDDING][:, :size]
        return (patches.reshape(-1, width * EMBEDDING) @ weights).reshape(len(batch), size, -1)

    def log_probabilities(self, batch: np.ndarray) -> np.ndarray:
        """Like `features`, without the places, then the softmax layer."""
        pooled = [
            np.maximum(self.convolve(batch, width, weights).max(axis=1) + bias, 0)
            for width, weights, bias in zip(WIDTHS, self.filters, self.biases)
        ]
        z = np.concatenate(pooled, axis=1) @ self.dense + self.offset
        z = z - z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        """Each text's language and its probability: the mean over all windows."""
        if len(self.languages) == 1:
            return self.languages * len(texts), np.ones(len(texts))
        parts, starts = windows(texts)
        logs = [self.log_probabilities(parts[k : k + BATCH]) for k in range(0, len(parts), BATCH)]
        sums = np.add.reduceat(np.concatenate(logs), starts[:-1], axis=0)
        mean = sums / np.diff(starts)[:, None]
        odds = np.exp(mean - mean.max(axis=1, keepdims=True))
        odds /= odds.sum(axis=1, keepdims=True)
        best = odds.argmax(axis=1)
        return [self.languages[k] for k in best], odds[np.arange(len(best)), best].astype(np.float64)


def fresh(languages: list[str], seed: int = 1) -> LanguageModel:
    rng = np.random.default_rng(seed)
    embedding = rng.normal(0, 0.5, (PAD + 1, EMBEDDING)).astype(np.float32)
    embedding[PAD] = 0
    filters = [rng.normal(0, 1 / np.sqrt(w * EMBEDDING), (w * EMBEDDING, FILTERS)).astype(np.float32) for w in WIDTHS]
    biases = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    dense = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))).astype(np.float32)
    return LanguageModel(languages, embedding, filters, biases, dense, np.zeros(len(languages), np.float32))


def gradients(model: LanguageModel, batch: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Slopes of the mean cross-entropy: embedding, filters, biases, dense layer, offset."""
    hidden, places = model.features(batch)
    z = hidden @ model.dense + model.offset
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(len(y)), y] -= 1
    p /= len(y)
    back = (p @ model.dense.T) * (hidden > 0)
    embedding, filters, biases = np.zeros_like(model.embedding), [], []
    rows = np.arange(len(batch))[:, None, None]
    for k, (width, at) in enumerate(zip(WIDTHS, places)):
        own = back[:, k * FILTERS : (k + 1) * FILTERS]
        # only the bytes under each filter's largest answer have a slope
        seen = batch[rows, at[:, :, None] + np.arange(width)]
        patches = model.embedding[seen].reshape(len(batch), FILTERS, -1)
        filters.append(np.einsum("bfd,bf->df", patches, own))
        biases.append(own.sum(axis=0))
        slope = np.einsum("bf,df->bfd", own, model.filters[k]).reshape(-1, EMBEDDING)
        for d in range(EMBEDDING):
            embedding[:, d] += np.bincount(seen.ravel(), slope[:, d], minlength=PAD + 1)
    embedding[PAD] = 0
    return [embedding, *filters, *biases, hidden.T @ p, p.sum(axis=0)]


def train(texts: list[tuple[bytes, int]], languages: list[str], rounds: int = ROUNDS) -> LanguageModel:
    """Adam over shuffled windows of the fitting texts."""
    model, rng = fresh(languages), np.random.default_rng(2)
    parts, labels = [], []
    for raw, label in texts:
        own, _ = windows([raw])
        take = np.unique(np.linspace(0, len(own) - 1, FIT_WINDOWS).astype(int))
        parts.append(own[take])
        labels += [label] * len(take)
        if len(raw) > 60:  # short texts occur too
            parts.append(windows([raw[: 20 + 40 * (len(parts) % 3)]])[0])
            labels.append(label)
    x, y = np.concatenate(parts), np.array(labels)
    weights = [model.embedding, *model.filters, *model.biases, model.dense, model.offset]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for done in range(rounds):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 64):
            rows = order[at : at + 64]
            step += 1
            for k, slope in enumerate(gradients(model, x[rows], y[rows])):
                first[k] += 0.1 * (slope - first[k])
                second[k] += 0.001 * (slope**2 - second[k])
                rate = STEP * (1 - done / rounds) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                weights[k] -= (rate * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
    return model


def fit(docs: DataFrame, rows: int = FIT_ROWS, chars: int = FIT_CHARS) -> LanguageModel | None:
    """Fit on rows with a language whose crc32(doc_id as text) mod 3 is not 1, `rows` a language.

    Rows are taken in hash order of doc_id among texts with a letter; of a doc_id that repeats, the
    text of the least hash. Every lang that has such a row can be predicted. Of texts of over `chars`
    characters, excerpts from the whole text are fitted. None where there is no such row.

    The rows wanted come to the driver in one job: at most `rows` a language, of `chars` characters.
    """
    usable = docs.where("lang is not null and doc_id is not null")
    usable = usable.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    usable = usable.where(F.col("text").rlike(LETTERS)).select("doc_id", "lang", "text")
    ids = F.approx_count_distinct("doc_id").alias("ids")
    counted = {r["lang"]: max(1, r["ids"]) for r in usable.groupBy("lang").agg(ids).collect()}
    if not counted:
        return None
    languages = sorted(counted)
    # about twice the rows wanted of each language are looked at, by hash; the bound then holds
    share = F.create_map(*(F.lit(x) for lang, n in counted.items() for x in (lang, min(1.0, 2 * rows / n))))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(1 << 20)
    near = usable.where(place < share[F.col("lang")])
    part = F.struct("lang", excerpt("text", chars).alias("text"))
    single = near.groupBy("doc_id").agg(F.min_by(part, F.struct(F.xxhash64("text"), "lang")).alias("row"))
    in_order = Window.partitionBy("row.lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = single.withColumn("k", F.row_number().over(in_order)).where(F.col("k") <= rows)
    found = sorted((r["doc_id"], r["row"]) for r in chosen.select("doc_id", "row").collect())
    if len(languages) == 1:
        return fresh(languages)
    return train([(row["text"].encode(), languages.index(row["lang"])) for _, row in found], languages)


def _predict(batches: Iterable[pa.RecordBatch], model: LanguageModel | None, text: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in text_slices(batch.column(text)):
            part = batch.slice(a, b - a)
            texts = part.column(text).to_pylist()
            lettered = pc.match_substring_regex(part.column(text), LETTERS).to_pylist()
            names, scores = [UNDETERMINED] * len(texts), np.ones(len(texts))
            rows = [k for k, yes in enumerate(lettered) if yes] if model else []
            if rows:
                found, odds = model.predict([texts[k].encode() for k in rows])
                scores[rows] = odds
                for k, name in zip(rows, found):
                    names[k] = name
            columns = dict(zip(part.schema.names, part.columns))
            yield pa.RecordBatch.from_pydict({**columns, "lang_pred": names, "score": pa.array(scores)})


def predict(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """`docs` with `lang_pred` and `score`, its probability.

    A null text or one without a letter is `und` with score 1; so is every text where there was
    nothing to learn from. Other columns pass through; own ones of these names are replaced.
    """
    docs = docs.drop("lang_pred", "score")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    work = partial(_predict, model=model, text=docs.columns.index("text"))
    return docs.mapInArrow(work, ", ".join([*fields, "lang_pred string", "score double"]))


def identify(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    return predict(docs.select("doc_id", "text"), fit(docs)).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )

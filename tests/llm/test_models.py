import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortforge.llm import language, quality
from cohortforge.llm.shared import excerpt

LABELS = "doc_id long, quality int, toxic int"


def held_out(doc, modulus):
    return zlib.crc32(str(doc).encode()) % modulus


def auc(good, bad):
    good, bad = np.asarray(good), np.asarray(bad)
    return (good[:, None] > bad).mean() + (good[:, None] == bad).mean() / 2


def test_quality_on_held_out_labels(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    found = {r["doc_id"]: r for r in quality.classify(docs, labels).collect()}
    assert len(found) == docs.count()
    assert all(r["held_out"] == (held_out(d, 4) == 2) for d, r in found.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found.values())
    marked = {r["doc_id"]: r["quality"] for r in labels.collect()}
    for held in (True, False):
        scores = [[found[d]["score"] for d, q in marked.items() if q == c and found[d]["held_out"] == held] for c in (1, 0)]
        assert auc(*scores) > 0.9


def test_quality_never_learns_from_held_out_rows(spark, frame):
    """Labels of held-out rows that say the opposite change nothing."""
    rows = [(k, ("fine words in a row " if k % 2 else "bad!! bad!! bad!! ") * 9) for k in range(200)]
    docs = frame(rows)
    honest = [(k, k % 2, 0) for k in range(200) if held_out(k, 4) != 2]
    lies = [(k, 1 - k % 2, 0) for k in range(200) if held_out(k, 4) == 2]
    score = lambda marks: sorted(map(tuple, quality.classify(docs, spark.createDataFrame(marks, LABELS)).collect()))
    assert score(honest) == score(honest + lies)
    assert all((s >= 0.7) == bool(d % 2) for d, _, s, _ in score(honest))


def test_quality_edges(spark, edges, nothing):
    none = spark.createDataFrame([], LABELS)
    odd = spark.createDataFrame([(1, None, 0), (None, 1, 0), (4, 7, 0), (999, 1, 0), (999, 0, 0)], LABELS)
    for labels in (none, odd):
        found = quality.classify(edges, labels).collect()
        assert len(found) == edges.count()
    assert {r["score"] for r in quality.classify(edges, none).collect()} == {1.0}
    assert quality.classify(nothing, none).collect() == []
    kept = quality.keep_good(edges, none)
    assert kept.columns == edges.columns and kept.count() == edges.count()
    assert {r["score"] for r in kept.collect()} == {"mine"}


def test_random_index_vectors_and_shapes():
    index = quality.index_vectors()
    assert set(np.unique(index)) == {-1, 0, 1} and (index.sum(axis=1) == 0).all()
    assert [quality.shape(w) for w in ("word", "Word.", "WORD!!!!", "a1-22b", "x$$$$y")] == ["a", "Aa.", "A!!", "a9-9a", "a$$a"]
    terms = quality.Terms(["the"])
    same, other = terms.of("the the cat"), terms.of("the cat the")
    assert same[0] == other[0] and same[1] == same[0] + quality.WORDS + quality.SHAPES and other[2] == other[0]


def test_temperature_restores_calibration():
    rng = np.random.default_rng(0)
    z = rng.normal(0, 2, 4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-z))).astype(float)
    assert 2.5 < quality.calibrate(3 * z, y, np.ones(4000)) < 3.6


def test_language_on_held_out_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = {r["doc_id"]: r for r in language.identify(docs).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    assert all(r["held_out"] == (held_out(d, 3) == 1) and 0 <= r["score"] <= 1 for d, r in found.items())
    right = [found[d]["lang_pred"] == lang for d, lang in truth.items() if found[d]["held_out"]]
    assert np.mean(right) > 0.95


def test_language_edges(edges, nothing, frame):
    found = language.identify(edges).collect()
    assert {r["lang_pred"] for r in found} == {"und"} and len(found) == edges.count()
    assert language.identify(nothing).collect() == []
    rows = [(k, None if k == 3 else "12 34 !" if k == 4 else "some words here") for k in range(12)]
    one = frame(rows).withColumn("lang", F.lit("xx"))
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(one).collect()}
    assert found == {k: "und" if k in (3, 4) else "xx" for k in range(12)}


def words(k, stems):
    random.seed(k)
    return " ".join(random.choice(stems) for _ in range(40))


def test_a_language_of_long_texts_only_is_learnt(spark, frame):
    """Each text of one language is longer than what is fitted of a text; ids repeat, too."""
    german, english = ["und", "nicht", "schön", "Straße"], ["and", "not", "nice", "street"]
    rows = [(k, words(k, german) * 200 if k % 2 else words(k, english)) for k in range(240)]
    rows += [(1, rows[1][1] + " x")] * 150
    lang = F.when(F.col("doc_id") % 2 == 1, "de").otherwise("en")
    docs = frame(rows).withColumn("lang", lang)
    assert docs.where("lang = 'de' and length(text) <= 20000").count() == 0
    found = language.identify(docs).collect()
    assert len(found) == len(rows)
    assert all(r["lang_pred"] == ("de" if r["doc_id"] % 2 else "en") for r in found if r["held_out"])


def test_excerpts_come_from_the_whole_text(spark):
    df = spark.createDataFrame([("ab" * 10,), ("x" * 50 + "y" * 50 + "z" * 50,), (None,)], "text string")
    out = [r[0] for r in df.select(excerpt("text", 24, 3)).collect()]
    assert out == ["ab" * 10, "x" * 8 + " " + "y" * 8 + " " + "z" * 8, None]


def plain_language(model, text):
    """The network's answer for a text, by loops over windows, widths, filters and places."""
    logs = []
    for at in range(0, max(1, len(text)), language.LENGTH):
        window = list(text[at : at + language.LENGTH])
        window += [language.PAD] * (language.LENGTH - len(window))
        pooled = []
        for width, filters, biases in zip(language.WIDTHS, model.filters, model.biases):
            for f in range(language.FILTERS):
                best = max(
                    sum(
                        float(model.embedding[window[p + j]] @ filters[j * language.EMBEDDING : (j + 1) * language.EMBEDDING, f])
                        for j in range(width)
                    )
                    for p in range(language.LENGTH - width + 1)
                )
                pooled.append(max(0.0, best + float(biases[f])))
        z = np.array(pooled) @ model.dense + model.offset
        logs.append(z - np.log(np.exp(z - z.max()).sum()) - z.max())
    odds = np.exp(np.mean(logs, axis=0))
    return model.languages[int(odds.argmax())], float(odds.max() / odds.sum())


def test_language_against_plain_loops(frame):
    model = language.fresh(["x", "y", "z"], seed=7)
    texts = ["short é", "long " * 60]
    found = {r["doc_id"]: r for r in language.predict(frame(list(enumerate(texts))), model).collect()}
    for k, text in enumerate(texts):
        name, score = plain_language(model, text.encode())
        assert found[k]["lang_pred"] == name and abs(found[k]["score"] - score) < 1e-4


def test_quality_against_plain_sums(spark, frame):
    """The score of a text is that of its words' mean vector, through both layers and the temperature."""
    rows = [(k, ("fine words in a row " if k % 2 else "bad!! bad!! 123 ") * (1 + k % 9)) for k in range(160)]
    docs, marks = frame(rows), spark.createDataFrame([(k, k % 2, 0) for k in range(160)], LABELS)
    model = quality.fit(docs, marks)
    found = {r["doc_id"]: r["score"] for r in quality.score(docs.select("doc_id", "text"), model).collect()}
    w1, b1, w2, b2 = model.layers
    numbers = quality.Terms(model.vocabulary)
    for doc, text in rows[:40]:
        before, total = None, np.zeros(quality.DIMENSIONS)
        for word in text.split():
            repeated = (quality.WORDS + quality.SHAPES) * (word == before)
            total, before = total + model.vectors[numbers[word] + repeated], word
        x = (total / len(text.split()) - model.scale[0]) / model.scale[1]
        z = sum(np.tanh(x @ w1[:, h] + b1[h]) * w2[h] for h in range(quality.HIDDEN)) + b2
        assert abs(found[doc] - 1 / (1 + np.exp(-z / model.temperature))) < 1e-4


def test_text_without_spaces_is_judged_whole():
    terms = quality.Terms([]).of("a" * 64 + "7" * 64 + "!" * 10)
    assert len(terms) == 3 and len(set(terms.tolist())) == 3


def test_windows_cover_the_whole_text():
    parts, starts = language.windows([b"", b"a" * 256, b"b" * 257])
    assert starts.tolist() == [0, 1, 2, 4] and parts.shape == (4, 256)
    assert (parts == ord("b")).sum() == 257 and (parts == language.PAD).sum() == 256 + 255


def test_gradients_are_right():
    model = language.fresh(["x", "y"])
    rng = np.random.default_rng(3)
    batch, y = rng.integers(0, 256, (5, language.LENGTH)).astype(np.int16), np.array([0, 1, 1, 0, 1])

    def loss():
        return -model.log_probabilities(batch)[np.arange(5), y].mean()

    slopes = language.gradients(model, batch, y)
    weights = [model.embedding, *model.filters, *model.biases, model.dense, model.offset]
    for w, slope in zip(weights, slopes):
        place = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        kept = w[place]
        sides = []
        for step in (1e-3, -1e-3):
            w[place] = kept + step
            sides.append(float(loss()))
        w[place] = kept
        assert (sides[0] - sides[1]) / 2e-3 == pytest.approx(float(slope[place]), rel=0.1, abs=2e-3)

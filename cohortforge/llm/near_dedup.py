"""Near-duplicate documents by chosen-path set similarity join, confirmed on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.llm.components import components
from cohortforge.llm.shared import group_bounds, staged, whole_groups, text_slices
from cohortforge.llm.words import mix, shingle_sets

SHINGLE = 5
PERCENT = 75
TOKENS = 128  # minwise tokens a document
TREES = 16  # independent trees
DEPTH = 3  # most branchings in a tree
NODE = 512  # documents a node may hold to be compared exhaustively
# A pair at the similarity asked for agrees on 96 of 128 tokens with a deviation of 4.9; seven
# deviations below that a pair is still handed on to be confirmed.
AGREE = 62
BLOCK_SHINGLES = 2_000_000  # shingles a confirming group may hold on average

SKETCHES = (
    "id long, n long, h1 long, h2 long, sketch binary, "
    "paths array<struct<p1: bigint, p2: bigint, p3: bigint>>"
)


def minwise(sets: list[np.ndarray], tokens: int = TOKENS) -> np.ndarray:
    """Row per non-empty set: the least of each of `tokens` hash functions over it."""
    rng = np.random.default_rng(7)
    factors = rng.integers(1, 1 << 63, tokens, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 1 << 63, tokens, dtype=np.uint64)
    out = np.empty((len(sets), tokens), np.uint64)
    with np.errstate(over="ignore"):
        for k, s in enumerate(sets):
            best = None
            for at in range(0, len(s), 1024):
                part = (s[at : at + 1024, None] * factors + shifts).min(axis=0)
                best = part if best is None else np.minimum(best, part)
            out[k] = best
    return out >> np.uint64(32)


def chosen_paths(tokens: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> np.ndarray:
    """(document, tree, level) -> node. A node picks the token its documents branch on next."""
    rows = np.arange(len(tokens))
    out = np.empty((len(tokens), trees, depth), np.uint64)
    with np.errstate(over="ignore"):
        for tree in range(trees):
            node = mix(np.full(len(tokens), tree, np.uint64), 11)
            for level in range(depth):
                pick = (mix(node, 13) % np.uint64(tokens.shape[1])).astype(np.int64)
                node = mix(node ^ mix(tokens[rows, pick], 17), 19 + level)
                out[:, tree, level] = node
    return out


def _sketch_batch(ids: pa.Array, texts: list[str | None]) -> pa.RecordBatch:
    sets = shingle_sets(texts, SHINGLE)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    full = np.flatnonzero(sizes)
    tokens = minwise([sets[k] for k in full])
    with np.errstate(over="ignore"):
        sums = [
            np.array([mix(s, seed).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            for seed in (23, 29)
        ]
    low = (tokens & np.uint64(255)).astype(np.uint8)
    sketches: list[bytes | None] = [None] * len(sets)
    for row, k in enumerate(full):
        sketches[k] = low[row].tobytes()
    nodes = chosen_paths(tokens).view(np.int64)
    counts = np.zeros(len(sets) + 1, np.int32)
    counts[full + 1] = TREES
    names = ["p1", "p2", "p3"]
    steps = pa.StructArray.from_arrays(
        [pa.array(nodes[:, :, level].ravel(), pa.int64()) for level in range(DEPTH)], names
    )
    paths = pa.ListArray.from_arrays(pa.array(np.cumsum(counts, dtype=np.int32)), steps)
    columns = [ids, pa.array(sizes), *map(pa.array, sums), pa.array(sketches, pa.binary()), paths]
    return pa.RecordBatch.from_arrays(columns, ["id", "n", "h1", "h2", "sketch", "paths"])


def _sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in text_slices(batch.column(1)):
            yield _sketch_batch(batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a).to_pylist())


def sketch(docs: DataFrame) -> DataFrame:
    """Per row of `docs` (doc_id, text): set size, 128-bit set digest, minwise sketch, tree paths."""
    return docs.select("doc_id", "text").mapInArrow(_sketch, SKETCHES)


def _linked(ids: np.ndarray, near) -> Iterator[tuple[np.ndarray, int]]:
    """Components of a group, given `near(k, rest)`: which of `rest` are linked with k.

    Breadth first, each document against those not reached yet, so a group of copies takes a pass.
    """
    rest = np.arange(len(ids))
    while len(rest) > 1:
        queue, found = [rest[0]], [rest[0]]
        rest = rest[1:]
        while queue and len(rest):
            hit = near(queue.pop(), rest)
            new = rest[hit]
            queue.extend(new)
            found.extend(new)
            rest = rest[~hit]
        if len(found) > 1:
            members = ids[found]
            yield members, int(members.min())


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of (key, id, n, sketch): documents whose sketches agree, with their least id."""
    for table in whole_groups(batches, "key"):
        bounds = group_bounds(table["key"].to_numpy())
        ids, sizes = table["id"].to_numpy(), table["n"].to_numpy()
        sketches = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(len(ids), -1)
        out_ids, out_labels = [], []
        starts, lengths = bounds[:-1], np.diff(bounds)
        two = starts[lengths == 2]  # most nodes hold a pair: all at once
        same = (sketches[two] == sketches[two + 1]).sum(axis=1) >= AGREE
        sized = _sizes_fit(sizes[two], sizes[two + 1])
        two = two[same & sized]
        least = np.minimum(ids[two], ids[two + 1])
        out_ids += [ids[two], ids[two + 1]]
        out_labels += [least, least]
        for a, n in zip(starts[lengths > 2].tolist(), lengths[lengths > 2].tolist()):
            own, own_sizes = sketches[a : a + n], sizes[a : a + n]

            def near(k, rest, own=own, own_sizes=own_sizes):
                agree = (own[rest] == own[k]).sum(axis=1) >= AGREE
                return agree & _sizes_fit(own_sizes[rest], own_sizes[k])

            for members, label in _linked(ids[a : a + n], near):
                out_ids.append(members)
                out_labels.append(np.full(len(members), label))
        columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in (out_ids, out_labels)]
        yield pa.RecordBatch.from_arrays(columns, ["id", "label"])


def _sizes_fit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 100 * np.minimum(a, b) >= PERCENT * np.maximum(a, b)


def _confirm(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Groups of (key, id, text): the exact components of each, as (u, v) with v the least id."""
    for table in whole_groups(batches, "key"):
        bounds, ids = group_bounds(table["key"].to_numpy()), table["id"].to_numpy()
        texts = table["text"].combine_chunks()
        us, vs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a < 2:
                continue
            part = texts.slice(a, b - a)
            sets = []
            for i, j in text_slices(part):
                sets += shingle_sets(part.slice(i, j - i).to_pylist(), SHINGLE)
            for members, label in _linked(ids[a:b], _exact(sets, percent)):
                us.append(members)
                vs.append(np.full(len(members), label))
        columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in (us, vs)]
        yield pa.RecordBatch.from_arrays(columns, ["u", "v"])


def _exact(sets: list[np.ndarray], percent: int):
    """`near` on full sets, by an inverted index of the group's shared shingles."""
    sizes = np.array([len(s) for s in sets])
    if len(sets) == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        linked = 100 * both >= percent * (sizes.sum() - both)
        return lambda k, rest: np.full(len(rest), linked)
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
    values, local = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(local, kind="stable")
    holders, places = owner[order], np.searchsorted(local[order], np.arange(len(values) + 1))
    ends = np.concatenate([[0], np.cumsum(sizes)])

    def near(k, rest):
        own = local[ends[k] : ends[k + 1]]
        lengths = places[own + 1] - places[own]
        own, lengths = own[lengths > 1], lengths[lengths > 1]
        skip = np.cumsum(lengths) - lengths
        take = np.repeat(places[own] - skip, lengths) + np.arange(lengths.sum())
        both = np.bincount(holders[take], minlength=len(sizes))[rest]
        return (100 * both >= percent * (sizes[k] + sizes[rest] - both)) & (both > 0)

    return near


def _leaves(rows: DataFrame) -> DataFrame:
    """(key, id) of nodes to compare: a node that is too large is branched once more.

    What is too large after the last branching (copies of each other, mostly) is cut into blocks,
    and every pair of blocks is a node of its own.
    """
    leaves = []
    for level in range(1, DEPTH + 1):
        key = f"p{level}"
        if level > 1:
            sizes = rows.groupBy(key).agg(F.count("*").alias("size")).where("size > 1")
            rows = rows.drop("size").join(sizes, key)
        leaves.append(rows.where(F.col("size") <= NODE).select(F.col(key).alias("key"), "id"))
        rows = rows.where(F.col("size") > NODE)
    leaves.append(in_blocks(rows, F.col(f"p{DEPTH}"), F.ceil(F.col("size") / (NODE // 2))).select("key", "id"))
    out = leaves[0]
    for leaf in leaves[1:]:
        out = out.unionByName(leaf)
    return out


def in_blocks(rows: DataFrame, key, blocks) -> DataFrame:
    """Rows of a group dealt to `blocks` blocks; `key` becomes that of each pair of blocks."""
    own = F.pmod(F.xxhash64("id"), F.col("_blocks"))
    other = F.col("_other")
    return (
        rows.withColumn("_blocks", blocks.cast("long"))
        .withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
        .withColumn("key", F.xxhash64(key, F.least("_own", other), F.greatest("_own", other)))
        .drop("_blocks", "_own", "_other")
    )


def _one_of_each(leaves: DataFrame) -> DataFrame:
    """Of nodes with the same documents, in whichever tree, one."""
    members = leaves.groupBy("key").agg(
        F.count("*").alias("size"), *(F.sum(F.xxhash64("id", F.lit(s)).bitwiseAND((1 << 40) - 1)).alias(f"s{s}") for s in (1, 2))
    )
    chosen = members.where("size > 1").groupBy("size", "s1", "s2").agg(F.min("key").alias("key"))
    return leaves.join(chosen.select("key"), "key")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * intersection >= percent * union of their shingle sets
    (`percent` from 75 up). Equal sets are first collapsed to their least doc_id. A tree sends a
    document down one path: each node picks, by its own hash, the minwise token to branch on. Nodes
    of at most `NODE` documents are compared exhaustively by sketch, and what agrees is confirmed
    on full sets, once, in groups of bounded size. A pair at the threshold that meets at the first
    branching, as all but those in crowded nodes do, is missed by all trees with a chance of
    0.25 ** 16 = 2e-10; in nodes branched three times with one of 0.02 %.

    Null and empty texts have no shingles and are linked with nothing. Rows that repeat a doc_id are
    one document, kept or dropped together. Rows without doc_id come back unlinked, with a null
    component and kept. An empty table gives an empty result; other columns are ignored.
    """
    sketches = staged(sketch(docs), "sketches")
    known = sketches.where("id is not null and n > 0")
    classes = staged(
        known.groupBy("h1", "h2", "n").agg(F.min("id").alias("rep")), "classes"
    )
    # one row a class: every row of the least id has the same set, but for repeated ids
    reps = known.join(classes.select("h1", "h2", F.col("rep").alias("id")), ["h1", "h2", "id"])
    reps = staged(reps.dropDuplicates(["id", "h1", "h2"]).select("id", "n", "sketch", "paths"), "reps")
    steps = reps.select("id", F.explode("paths").alias("p")).select("id", "p.*")
    sizes = steps.groupBy("p1").agg(F.count("*").alias("size")).where("size > 1")
    rows = staged(steps.join(sizes, "p1"), "nodes")

    leaves = _one_of_each(staged(_leaves(rows), "leaves"))
    nodes = leaves.join(reps.select("id", "n", "sketch"), "id").select("key", "id", "n", "sketch")
    labelled = staged(
        nodes.repartition("key").sortWithinPartitions("key").mapInArrow(_compare, "id long, label long").distinct(),
        "labels",
    )
    # labels of one document are one label: groups that overlap are confirmed together
    least = labelled.groupBy("id").agg(F.min("label").alias("least"))
    renamed = labelled.join(least.withColumnRenamed("id", "label"), "label")
    groups = staged(renamed.select(F.col("least").alias("label"), "id").distinct(), "groups")

    members = groups.join(reps.select("id", "n"), "id")
    sums = members.groupBy("label").agg(F.sum("n").alias("shingles"), F.count("*").alias("docs"))
    blocks = F.when(F.col("shingles") <= 2 * BLOCK_SHINGLES, 1).otherwise(F.ceil(F.col("shingles") / BLOCK_SHINGLES))
    blocks = F.greatest(blocks, F.when(F.col("docs") <= 4096, 1).otherwise(F.ceil(F.col("docs") / 2048)))
    dealt = in_blocks(groups.join(sums.where("docs > 1"), "label"), F.col("label"), blocks).select("key", "id")
    texts = docs.select(F.col("doc_id").alias("id"), "text").where("id is not null")
    pairs = dealt.join(texts, "id").select("key", "id", "text")
    edges = pairs.repartition("key").sortWithinPartitions("key").mapInArrow(
        partial(_confirm, percent=percent), "u long, v long"
    )
    roots = components(edges)

    named = classes.join(roots.withColumnRenamed("id", "rep"), "rep", "left").select(
        "h1", "h2", F.coalesce("root", "rep").alias("component")
    )
    with_set = known.select("id", "n", "h1", "h2").join(named, ["h1", "h2"])
    without = sketches.where("id is null or n = 0").select("id", "n", F.col("id").alias("component"))
    every = with_set.select("id", "n", "component").unionByName(without)
    return every.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """`docs` without the near copies of a kept document; rows without doc_id stay."""
    gone = near_duplicates(docs, percent).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)

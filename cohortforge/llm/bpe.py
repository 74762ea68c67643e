"""Byte-pair encoding and decoding with a public byte-level vocabulary.

A word's parts stand in one contiguous array beside the ranks of adjacent pairs. The least rank is
found by a scan, its boundary deleted, and the two neighbouring ranks refreshed, until no adjacent
pair has a rank. Very long words (over `SHORT` bytes) keep the same order of merges in a heap.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.llm.chunks import KEPT, PIECES, ChunkMemory, cut
from cohortforge.llm.shared import text_slices

NONE = 1 << 60  # the rank of a pair that does not merge
SHORT = 200


def byte_letters() -> dict[str, int]:
    """The letter byte-level vocabularies write each byte as: printable ones as themselves."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class Bpe:
    """A byte-level vocabulary file: ranks of pairs, bytes of tokens, special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        letters = byte_letters()
        vocab = model["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.bytes_of = {i: bytes(letters[c] for c in token) for token, i in vocab.items()}
        self.bytes_of |= {i: content.encode() for content, i in self.special.items()}
        self.of_byte = [vocab[letter] for letter, _ in sorted(letters.items(), key=lambda x: x[1])]
        # the rank of a pair by its left and right id, and the id a rank's merge gives
        self.ranks: list[dict[int, int]] = [{} for _ in range(max(vocab.values()) + 1)]
        self.merged: list[int] = []
        for rank, pair in enumerate(model["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[a]][vocab[b]] = rank
            self.merged.append(vocab[a + b])
        self.memory = ChunkMemory(lambda chunks: map(self.chunk, chunks))
        self.marks: dict[str, list[int]] = {}  # pieces of one or two characters

    def word(self, raw: bytes) -> list[int]:
        """The ids of one pre-token."""
        parts = list(map(self.of_byte.__getitem__, raw))
        if len(parts) > SHORT:
            return self.long_word(parts)
        ranks_of, merged = self.ranks, self.merged
        ranks = [ranks_of[a].get(b, NONE) for a, b in zip(parts, parts[1:])]
        while ranks and (least := min(ranks)) != NONE:
            at = ranks.index(least)
            new = parts[at] = merged[least]
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = ranks_of[parts[at - 1]].get(new, NONE)
            if at < len(ranks):
                ranks[at] = ranks_of[new].get(parts[at + 1], NONE)
        return parts

    def long_word(self, parts: list[int]) -> list[int]:
        """The same merges in the same order, the leftmost of the least rank first."""
        ranks_of, n = self.ranks, len(parts)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        pairs = enumerate(zip(parts, parts[1:]))
        heap = [(ranks_of[a][b], k) for k, (a, b) in pairs if b in ranks_of[a]]
        heapq.heapify(heap)
        while heap:
            rank, k = heapq.heappop(heap)
            right = after[k]
            if parts[k] < 0 or right >= n or ranks_of[parts[k]].get(parts[right]) != rank:
                continue
            parts[k], parts[right] = self.merged[rank], -1
            after[k] = after[right]
            if after[k] < n:
                before[after[k]] = k
                if (new := ranks_of[parts[k]].get(parts[after[k]])) is not None:
                    heapq.heappush(heap, (new, k))
            left = before[k]
            if left >= 0 and (new := ranks_of[parts[left]].get(parts[k])) is not None:
                heapq.heappush(heap, (new, left))
        return [p for p in parts if p >= 0]

    def chunk(self, chunk: str) -> bytes:
        """The ids of a chunk as bytes."""
        ids: list[int] = []
        for piece in PIECES.findall(chunk):
            if len(piece) > 2:
                ids += self.word(piece.encode())
                continue
            if piece not in self.marks:
                if len(self.marks) > KEPT:
                    self.marks.clear()
                self.marks[piece] = self.word(piece.encode())
            ids += self.marks[piece]
        return array("I", ids).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """All ids of each text as little-endian 32-bit integers; special tokens are special."""
        return encode_all(texts, self.special, self.memory)

    def decode(self, ids: bytes) -> str:
        """The text of ids; what is not UTF-8 becomes the replacement character."""
        tokens = np.frombuffer(ids, "<u4").tolist()
        return b"".join(map(self.bytes_of.__getitem__, tokens)).decode("utf-8", "replace")


def split_special(text: str, special: dict[str, int]) -> list[str | int]:
    """Stretches of text, with the ids of the special tokens between them."""
    parts: list[str | int] = [text]
    for content, token in special.items():
        if content in text:
            split: list[str | int] = []
            for part in parts:
                stretches = part.split(content) if isinstance(part, str) else [part]
                for k, stretch in enumerate(stretches):
                    split += [token, stretch] if k else [stretch]
            parts = split
    return parts


def encode_all(texts: list[str | None], special: dict[str, int], memory: ChunkMemory) -> list[bytes]:
    """Ids of texts by way of their chunks; a chunk that many of them have is encoded once."""
    split = [
        [cut(part) if isinstance(part, str) else part for part in split_special(text or "", special)]
        for text in texts
    ]
    memory.learn(set().union(*(part for parts in split for part in parts if isinstance(part, list))))
    return [
        b"".join(memory.ids(p) if isinstance(p, list) else np.array([p], "<u4").tobytes() for p in parts)
        for parts in split
    ]


def _encode(batches: Iterable[pa.RecordBatch], path: str, text: int, decode: bool) -> Iterator[pa.RecordBatch]:
    bpe = Bpe(path)
    for batch in batches:
        for a, b in text_slices(batch.column(text)):
            part = batch.slice(a, b - a)
            ids = bpe.encode(part.column(text).to_pylist())
            new = {"ids": pa.array(ids, pa.binary())}
            if decode:
                new["decoded"] = pa.array([bpe.decode(i) for i in ids], pa.string())
            columns = {**dict(zip(part.schema.names, part.columns)), **new}
            yield pa.RecordBatch.from_pydict(columns)


def _decode(batches: Iterable[pa.RecordBatch], path: str, ids: int) -> Iterator[pa.RecordBatch]:
    bpe = Bpe(path)
    for batch in batches:
        texts = [None if i is None else bpe.decode(i) for i in batch.column(ids).to_pylist()]
        columns = {**dict(zip(batch.schema.names, batch.columns)), "decoded": pa.array(texts, pa.string())}
        yield pa.RecordBatch.from_pydict(columns)


def encode(docs: DataFrame, path: str, decoded: bool = False) -> DataFrame:
    """`docs` with `ids`: the text's token ids as little-endian 32-bit integers (binary).

    `decoded` adds the text that the ids give back. Null and empty texts have no ids. Other columns
    pass through; own columns called `ids` or `decoded` are replaced. An empty table stays empty.
    """
    docs = docs.drop("ids", "decoded")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields] + ["ids binary"]
    if decoded:
        fields.append("decoded string")
    work = partial(_encode, path=path, text=docs.columns.index("text"), decode=decoded)
    return docs.mapInArrow(work, ", ".join(fields))


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """`tokens` (with `ids`) with `decoded`, the text of the ids; null for null ids."""
    tokens = tokens.drop("decoded")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema.fields]
    work = partial(_decode, path=path, ids=tokens.columns.index("ids"))
    return tokens.mapInArrow(work, ", ".join([*fields, "decoded string"]))


def round_trip_digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256 of an encoding and its decoding."""
    both = encode(docs.select("doc_id", "text"), path, decoded=True)
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (binary), n_tokens and exact: whether the ids decode to the very text."""
    both = encode(docs.select("doc_id", "text"), path, decoded=True)
    return both.select(
        "doc_id",
        "ids",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("exact"),
    )

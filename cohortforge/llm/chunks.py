"""Cut texts where a byte-level BPE tokenizer always cuts them, and keep what chunks encode to.

The pattern below never lets a piece run across a space that is followed by a non-space, nor
across one that a non-space precedes. Chunks between such spaces encode independently of their
surroundings, so most of a corpus is looked up chunk by chunk.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import regex

# Fixed value: the public pre-tokenization pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECES = regex.compile(PATTERN)
ODD_SPACE = re.compile(r"[^\S \n]")
KEPT = 300_000  # chunks remembered a generation


def clean_spaces(text: str) -> bool:
    """Whether every space stands before a non-space, and other white space is line feeds only."""
    return not ("  " in text or " \n" in text or text.endswith(" ") or ODD_SPACE.search(text))


def cut(text: str) -> list[str]:
    """Chunks that join to `text`; what BPE gives for each, joined, is what it gives for the text."""
    if not clean_spaces(text):
        return PIECES.findall(text)
    first, *others = text.split(" ")
    return [first, *[" " + x for x in others]] if first else [" " + x for x in others]


class ChunkMemory:
    """Encoded chunks, bounded: two generations, the older dropped when the newer is full.

    `encode` takes a list of distinct chunks and returns each one's ids as little-endian bytes.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]], kept: int = KEPT):
        self.encode, self.kept = encode, kept
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def learn(self, chunks: Iterable[str]) -> None:
        """Have distinct chunks at hand, until the next call; those not known are encoded at once."""
        if len(self.new) > self.kept:
            self.old, self.new = self.new, {}
        new, old, missing = self.new, self.old, []
        for chunk in chunks:
            if chunk not in new:
                if (known := old.get(chunk)) is None:
                    missing.append(chunk)
                else:
                    new[chunk] = known
        if missing:
            new.update(zip(missing, self.encode(missing)))

    def each(self, chunks: list[str]) -> list[bytes]:
        """The ids of each of some distinct chunks, in one pass over those that are known."""
        if len(self.new) > self.kept:
            self.old, self.new = self.new, {}
        out = list(map(self.new.get, chunks))
        at = [k for k, known in enumerate(out) if known is None]
        if at:
            missing = [chunks[k] for k in at]
            found = list(map(self.old.get, missing))
            fresh = iter(self.encode([c for c, known in zip(missing, found) if known is None]))
            found = [next(fresh) if known is None else known for known in found]
            self.new.update(zip(missing, found))
            for k, known in zip(at, found):
                out[k] = known
        return out

    def ids(self, chunks: list[str]) -> bytes:
        """The ids of learnt chunks, in order."""
        return b"".join(map(self.new.__getitem__, chunks))

"""Word shingles of many texts at once, as 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from larkspur.llm.common import GOLDEN, Powers, mix

#: Words of a shingle.
WORDS = 5
#: Bytes of text that are hashed at once; a longer text is hashed alone.
PIECE = 1 << 20

#: Bytes between words: all of ASCII but letters and digits.
_GAP = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_powers = Powers(0x5851F42D4C957F2D)
_TURNS = mix(np.arange(1, WORDS + 1, dtype=np.uint64) * GOLDEN) | np.uint64(1)


def pieces(texts: list[bytes], limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of up to ``limit`` bytes together."""
    start = size = 0
    for i, x in enumerate(texts):
        if i > start and size + len(x) > limit:
            yield start, i
            start, size = i, 0
        size += len(x) + 1
    if start < len(texts):
        yield start, len(texts)


def cells(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each piece (first text, cell hashes, text of each cell), sorted by text and hash.

    A cell is one unit of weight: the j-th time that a text has a shingle. The Jaccard similarity of two sets of cells is
    the weighted similarity of the shingles with their counts. A text of one to four words has one shingle of them all,
    a text without words has none.
    """
    data = [x.lower().encode() if x else b"" for x in texts]
    for a, b in pieces(data):
        size = np.array([len(x) + 1 for x in data[a:b]])
        raw = np.frombuffer(b"\n".join(data[a:b]) + b"\n", np.uint8)
        gap = _GAP[raw]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if not gap[0]:
            edge = np.concatenate([[0], edge])
        start, end = edge[0::2], edge[1::2]
        word = _powers.spans(_powers.prefix(raw), start, end)
        text = np.searchsorted(np.cumsum(size), start, side="right")
        n = len(word)
        if n == 0:
            yield a, np.zeros(0, np.uint64), np.zeros(0, np.int64)
            continue
        first = np.searchsorted(text, np.arange(b - a))
        last = np.searchsorted(text, np.arange(b - a), side="right")
        count = last - first
        length = np.minimum(count, WORDS)
        at = np.arange(n)
        good = at + length[text] <= last[text]
        at, doc = at[good], text[good]
        h = length[doc].astype(np.uint64)
        for i in range(WORDS):
            use = i < length[doc]
            h = h + np.where(use, word[np.minimum(at + i, n - 1)] * _TURNS[i], np.uint64(0))
        h = mix(h)
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])
        run = np.flatnonzero(new)
        nth = np.arange(len(h)) - np.repeat(run, np.diff(np.concatenate([run, [len(h)]])))
        yield a, mix(h + nth.astype(np.uint64) * GOLDEN), doc

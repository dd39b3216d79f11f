"""Word and shingle hashes of whole texts, computed on bytes in batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np

BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
BASE, STEP = np.uint64(0x9E6C63D0876A9A47), np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers after which every bit depends on every bit (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, A-Z lower-cased, and where each text's words end."""
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(parts) + b" ", dtype=np.uint8)
    ends = np.cumsum([len(p) + 1 for p in parts])
    solid = ~BLANK[data]
    starts = np.flatnonzero(solid & ~np.r_[False, solid[:-1]])
    stops = np.flatnonzero(~solid & np.r_[False, solid[:-1]])
    if not len(starts):
        return np.empty(0, dtype=np.uint64), np.zeros(len(texts), dtype=np.int64)
    lengths = stops - starts
    powers = np.full(int(lengths.max()), BASE, dtype=np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    values = (FOLD[data[solid]].astype(np.uint64) + np.uint64(1)) * powers[place]
    hashes = mix(np.add.reduceat(values, first) + lengths.astype(np.uint64) * STEP)
    return hashes, np.searchsorted(starts, ends)


def shingle_sets(texts: Sequence[str], width: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of ``width`` words.

    With fewer words, the whole sequence is one shingle; without words there is none.
    """
    hashes, ends = word_hashes(texts)
    n = len(hashes)
    rolled = np.zeros(max(n - width + 1, 0), dtype=np.uint64)
    for i in range(width if len(rolled) else 0):
        rolled = rolled * STEP + hashes[i : n - width + 1 + i]
    rolled = mix(rolled)
    start = 0
    for end in ends:
        end = int(end)
        if end - start >= width:
            yield np.unique(rolled[start : end - width + 1])
        elif end > start:
            whole = np.array([end - start], dtype=np.uint64)
            for i in range(start, end):
                whole = mix(whole * STEP + hashes[i : i + 1])
            yield whole
        else:
            yield np.empty(0, dtype=np.uint64)
        start = end


def in_chunks(texts: Iterable[str | None], characters: int = 1 << 20) -> Iterator[list[str]]:
    """Consecutive texts, null as empty, in lists of about so many characters."""
    held, size = [], 0
    for text in texts:
        held.append(text or "")
        size += len(held[-1])
        if size >= characters:
            yield held
            held, size = [], 0
    if held:
        yield held

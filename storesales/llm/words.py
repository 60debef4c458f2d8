"""Words of many texts at once, as arrays of 64-bit hashes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: White space between words: the blank and the control characters 9 to 13.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

#: A-Z to a-z; every other byte stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

# Bytes hashed at a time.
BLOCK_BYTES = 1 << 20

_POWERS = 1 << 16
_BYTE_CODES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWER_CODES = np.cumprod(np.full(_POWERS, 0xD6E8FEB86659FD93, np.uint64), dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits, one to one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def run_codes(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of strings of a byte or more that lie end to end; ``ends`` holds where each begins, and the last one's end."""
    lengths = np.diff(ends)
    hashes = np.empty(len(lengths), np.uint64)
    i = 0
    while i < len(lengths):  # in blocks, since the codes take many times the place of the bytes
        j = max(i + 1, int(np.searchsorted(ends[1:], ends[i] + BLOCK_BYTES, side="right")))
        firsts = ends[i:j] - ends[i]
        place = np.arange(int(ends[j] - ends[i])) - np.repeat(firsts, lengths[i:j])
        codes = _BYTE_CODES[data[ends[i] : ends[j]]] * _POWER_CODES[place % _POWERS]
        hashes[i:j] = mix(np.add.reduceat(codes, firsts) + lengths[i:j].astype(np.uint64))
        i = j
    return hashes


@dataclass
class Words:
    """Texts laid end to end, each closed by a line feed, and the words in them."""

    data: np.ndarray  # bytes
    text_starts: np.ndarray  # place of each text's first byte, and one past the last line feed
    starts: np.ndarray  # place of each word's first byte
    lengths: np.ndarray  # bytes of each word
    hashes: np.ndarray
    bounds: np.ndarray  # number of each text's first word, and the number of words


def words_of(texts: list[str], lower: bool = False) -> Words:
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"".join(x for r in raw for x in (r, b"\n")), np.uint8)
    text_starts = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)])
    if lower:
        data = LOWER[data]
    inside = ~SPACES[data]
    edges = np.diff(inside.astype(np.int8), prepend=0)
    starts = np.flatnonzero(edges == 1)
    lengths = np.flatnonzero(edges == -1) - starts  # the last line feed closes the last word
    hashes = run_codes(data[inside], np.concatenate([[0], np.cumsum(lengths)]))
    return Words(data, text_starts, starts, lengths, hashes, np.searchsorted(starts, text_starts))


def run_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` neighbouring words; run i starts at word i."""
    size = max(0, len(hashes) - n + 1)
    h = np.full(size, n, np.uint64)
    for i in range(n):
        h = mix((h ^ hashes[i : i + size]) * np.uint64(0x9E3779B97F4A7C15))
    return h

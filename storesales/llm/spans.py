"""Runs of bytes of many texts at once, as Arrow strings without a Python object each."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from storesales.llm.words import LOWER


@dataclass
class Runs:
    """The maximal runs of wanted bytes of each text, in the order of the texts."""

    strings: pa.Array
    counts: np.ndarray  # runs of each text
    pieces: np.ndarray  # number of the piece that each run lies in; texts and cutting bytes start new ones


def byte_class(*chosen: int | range) -> np.ndarray:
    """Truth for each of the 256 bytes."""
    table = np.zeros(256, bool)
    for some in chosen:
        table[some if isinstance(some, int) else list(some)] = True
    return table


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of ``texts`` (without NULL) laid end to end, and where each begins, and the last one ends."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    held = texts.buffers()[2]
    raw = np.frombuffer(held, np.uint8) if held is not None and held.size else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def strings_of(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Strings that lie end to end in ``data``; ``ends`` holds where each begins, and the last one's end."""
    buffers = [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.large_string(), len(ends) - 1, buffers)


def runs_of(texts: pa.Array, wanted: np.ndarray, cutting: np.ndarray | None = None, lower: bool = True) -> Runs:
    """Runs of the bytes that ``wanted`` tells, of ``texts`` without NULL; it must hold all bytes from 128 on or none.

    ``cutting`` tells the bytes that end a piece; ``lower`` puts A-Z into lower case.
    """
    data, offsets = bytes_of(texts)
    data = LOWER[data] if lower else data
    inside = wanted[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = offsets[:-1][offsets[:-1] < len(data)]
    first[starts] = inside[starts]
    kept = data[inside]
    places = np.flatnonzero(first)
    strings = strings_of(kept, np.append(np.flatnonzero(first[inside]), len(kept)))
    counts = np.diff(np.searchsorted(places, offsets))
    pieces = np.empty(0, np.int64)
    if cutting is not None:
        breaks = cutting[data]
        breaks[starts] = True
        pieces = np.searchsorted(np.flatnonzero(breaks), places, side="right")
    return Runs(strings, counts, pieces)

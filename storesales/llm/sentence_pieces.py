"""SentencePiece encoding and decoding by a weighted finite-state transducer.

Three transducers are compiled from a model: its normaliser (a blank becomes the
sign for blanks, one is put in front), its pieces (a trie whose ends give ids,
at the cost of the piece's score with the sign turned) and the byte fallback (a
character of no piece gives the ids of its bytes). They are composed with each
input as it is read, and the shortest path in the tropical semiring, where costs
along a path are added and the least one wins, is the encoding.

For a unigram model that is all. In a vocabulary of byte-pair merges the encoding
is not the segmentation of the best scores but the one that merging gives: each
two neighbouring pieces must be what merging makes of the two together. There
the states of the composition also hold the last piece, and an arc costs infinity
behind a piece that it cannot follow.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storesales.llm.common import slices, texts_of, type_of
from storesales.llm.pretokens import PretokenCache
from storesales.llm.spans import bytes_of, strings_of

#: Fixed value: the character that stands for a blank inside pieces.
BLANK = "▁"

IDS = np.dtype("<u4")

# Pairs of pieces that a worker remembers.
PAIRS = 300_000

_START = -1

_transducers: dict[str, Transducer] = {}


def fields(message: bytes) -> dict[int, list]:
    """The fields of a serialised protocol buffer: numbers as they are, the rest as bytes."""
    found: dict[int, list] = {}
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(message):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            value = varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            value, at = message[at : at + size], at + size
        found.setdefault(number, []).append(value)
    return found


class Transducer:
    """The normaliser, the pieces and the byte fallback of one model, ready to be composed with texts."""

    #: Numbers of fields in a serialised model, and kinds of models.
    TRAINER, NORMALISER, KIND, CHARACTER_MAP, PREFIX, EXTRA_BLANKS, BLANK_SIGN = 2, 3, 3, 2, 3, 4, 5
    UNIGRAM, MERGES = 1, 2

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        described = fields(model.serialized_model_proto())
        rules = fields(described.get(self.NORMALISER, [b""])[-1])
        # Only blanks are normalised here: a map of characters would be lost.
        if rules.get(self.CHARACTER_MAP, [b""])[-1]:
            raise ValueError(f"{path}: it normalises characters by a compiled map")
        if rules.get(self.EXTRA_BLANKS, [1])[-1] or not rules.get(self.BLANK_SIGN, [1])[-1]:
            raise ValueError(f"{path}: blanks must be kept, and written by their sign")
        self.prefix = BLANK if rules.get(self.PREFIX, [1])[-1] else ""
        self.kind = fields(described.get(self.TRAINER, [b""])[-1]).get(self.KIND, [self.UNIGRAM])[-1]
        if self.kind not in (self.UNIGRAM, self.MERGES):
            raise ValueError(f"{path}: only unigram models and those of merges are known")
        self.pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
        self.bytes_from = {bytes([int(p[3:5], 16)]): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        if len(self.bytes_from) != 256:
            raise ValueError(f"{path}: a piece for every byte is needed")
        special = {i for i in range(len(self.pieces)) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)}
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in special}
        self.scores = [model.get_score(i) for i in range(len(self.pieces))]
        if any(BLANK in p.lstrip(BLANK) for p in self.ids):
            raise ValueError(f"{path}: a piece has a blank inside")
        #: What an arc costs; a character of no piece costs more than any way through pieces saves.
        self.costs = [-x for x in self.scores]
        self.unknown = max((self.costs[i] for i in self.ids.values()), default=0.0) + 10.0
        self._odd: set[int] = set()
        # Every beginning of a piece: the piece's id where it is a whole one, else -1.
        self.prefixes = {p[:n]: -1 for p in self.ids for n in range(1, len(p))} | self.ids
        # Neighbouring ASCII characters of some piece: no piece reaches across others.
        self.joined = np.zeros((256, 256), bool)
        for piece in self.ids:
            for a, b in zip(piece, piece[1:], strict=False):
                if a < "\x80" and b < "\x80":
                    self.joined[ord(a), ord(b)] = True
        byte_of = {i: b for b, i in self.bytes_from.items()}
        # What a piece is as text; control pieces are nothing.
        self.raw = [
            byte_of[i] if i in byte_of else b"" if i in special else p.replace(BLANK, " ").encode()
            for i, p in enumerate(self.pieces)
        ]
        merges = self.kind == self.MERGES
        self._halves = {i: self._last_merge(i) for i in self.ids.values()} if merges else {}
        self._pairs: dict[int, bool] = {}
        self.segments = PretokenCache(
            lambda words: map(self.path if merges else self.free_path, map(self.normalised, words)), lambda ids: array("I", ids).tobytes()
        )

    @staticmethod
    def of(path: str) -> Transducer:
        if path not in _transducers:
            _transducers[path] = Transducer(path)
        return _transducers[path]

    @staticmethod
    def normalised(text: str) -> str:
        return text.replace(" ", BLANK)

    def merged(self, text: str, stop: int = 1) -> list[str]:
        """The pieces that merging gives: always the best pair, of equal ones the first; or the last ``stop`` before."""
        parts = list(text)
        while len(parts) > stop:
            best, at = None, -1
            for i in range(len(parts) - 1):
                piece = self.ids.get(parts[i] + parts[i + 1])
                if piece is not None and (best is None or self.scores[piece] > best):
                    best, at = self.scores[piece], i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _last_merge(self, piece: int) -> tuple[int, int] | None:
        """The two pieces whose merge makes this one last; None for a single character.

        Merges must come in the order of their scores, each after those it
        needs; pieces that break this are set apart, and their pairs merged.
        """
        text = self.pieces[piece]
        if len(text) == 1:
            return None
        for i in range(1, len(text)):
            left, right = self.ids.get(text[:i]), self.ids.get(text[i:])
            if left is None or right is None or self.merged(text[:i]) != [text[:i]] or self.merged(text[i:]) != [text[i:]]:
                continue
            if self._ordered(left, piece) and self._ordered(right, piece) and self._splits_last(text, i):
                return left, right
        self._odd.add(piece)
        return None

    def _ordered(self, part: int, piece: int) -> bool:
        return len(self.pieces[part]) == 1 or self.scores[part] > self.scores[piece] and part not in self._odd

    def _splits_last(self, text: str, i: int) -> bool:
        return self.merged(text, stop=2) == [text[:i], text[i:]]

    def _beside(self, first: int, second: int) -> bool:
        """Whether merging leaves the two pieces as they are.

        A merge across their border joins a piece on the right edge of the first
        one's making with one on the left edge of the second's. Both must be
        there at the same time, and the merge must score higher than the one
        that would take the left of them, and no lower than that of the right.
        """
        key = first << 32 | second
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= PAIRS:
                self._pairs.clear()
            if first in self._odd or second in self._odd:
                a, b = self.pieces[first], self.pieces[second]
                known = self.merged(a + b) == [a, b]
            else:
                known = not any(self._crosses(a, b) for a in self._edge(first, 1) for b in self._edge(second, 0))
            self._pairs[key] = known
        return known

    def _edge(self, piece: int, side: int) -> list[tuple[str, float, float]]:
        """Pieces at one edge in the making of a piece: text, score that makes it, score that takes it."""
        found, taken = [], -math.inf
        while True:
            halves = self._halves[piece]
            found.append((self.pieces[piece], self.scores[piece] if halves else math.inf, taken))
            if halves is None:
                return found
            taken, piece = self.scores[piece], halves[side]

    def _crosses(self, left: tuple[str, float, float], right: tuple[str, float, float]) -> bool:
        text, made, taken = left
        other, made_too, taken_too = right
        joined = self.ids.get(text + other)
        if joined is None or min(made, made_too) <= max(taken, taken_too):
            return False
        score = self.scores[joined]
        return score > taken and score >= taken_too

    def _arcs(self, text: str, place: int) -> list[tuple[int, int, float]]:
        """Arcs from a place of a segment, as id, end and cost: the bytes of a character that is no piece, and pieces by length."""
        arcs, find = [], self.prefixes.get
        for end in range(place + 1, len(text) + 1):
            piece = find(text[place:end])
            if piece is None:
                break
            if piece >= 0:
                arcs.append((piece, end, self.costs[piece]))
        if not arcs or arcs[0][1] > place + 1:
            arcs.insert(0, (_START, place + 1, self.unknown))
        return arcs

    def free_path(self, text: str) -> list[int]:
        """Shortest path where a piece may follow any other: states are places."""
        costs: list[float] = [0.0] + [math.inf] * len(text)
        back: list[tuple[int, int]] = [(0, _START)] * (len(text) + 1)
        for place in range(len(text)):
            for piece, end, more in self._arcs(text, place):
                if costs[place] + more < costs[end]:
                    costs[end], back[end] = costs[place] + more, (place, piece)
        path, place = [], len(text)
        while place:
            start, piece = back[place]
            path.append((start, piece))
            place = start
        return self._output(text, path[::-1])

    def path(self, text: str) -> list[int]:
        """Shortest path where a piece may only follow some: states are places with the last piece.

        Merging leaves one segmentation into pieces, so only one path costs less
        than infinity, but for paths through the bytes of a character that could
        have been part of a piece, which cost more. So arcs are followed depth
        first, the longest piece first and bytes last, and the first path that
        reaches the end is the shortest. A state that leads nowhere is never
        entered again, so the search takes no more steps than the composition
        has arcs, and most of these are never looked at.
        """
        n, beside = len(text), self._beside
        dead: set[tuple[int, int]] = set()
        place, last = 0, _START
        way: list[tuple[int, int, list[tuple[int, int, float]]]] = []  # place, piece before it, arcs still to try
        left: list[tuple[int, int, float]] | None = None
        while place < n:
            if left is None:
                left = self._arcs(text, place)
            while left:
                piece, end, _ = left.pop()
                if (piece < 0 or last < 0 or beside(last, piece)) and (not dead or (end, piece) not in dead):
                    way.append((place, last, left))
                    place, last, left = end, piece, None
                    break
            else:
                dead.add((place, last))
                place, last, left = way.pop()
        pieces = [last for _, last, _ in way[1:]] + [last]
        return self._output(text, [(start, piece) for (start, _, _), piece in zip(way, pieces, strict=True)])

    def _output(self, text: str, path: list[tuple[int, int]]) -> list[int]:
        ids: list[int] = []
        for start, piece in path:
            if piece == _START:
                ids.extend(self.bytes_from[bytes([b])] for b in text[start].encode("utf-8", "surrogatepass"))
            else:
                ids.append(piece)
        return ids

    def encode(self, texts: pa.Array) -> pa.Array:
        """Ids of whole texts as little-endian 32-bit numbers.

        The composition is cut where all paths meet: before each run of blanks
        behind something else, and between two ASCII characters that are
        neighbours in no piece. Distinct segments are looked up, and their ids
        put together by the segments' numbers.
        """
        plain = texts.cast(pa.large_string())
        if self.prefix:
            # Inside a segment a blank and its sign are one; in front of a text there is one more.
            one, none = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
            plain = pc.if_else(pc.equal(pc.binary_length(plain), 0), plain, pc.binary_join_element_wise(one, plain, none))
        data, offsets = bytes_of(plain)
        blank = data == 0x20
        # The sign written out in a text is a blank, too.
        signs = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)) if len(data) > 2 else np.empty(0, np.int64)
        ends = blank.copy()
        blank[signs] = ends[signs + 2] = True
        cuts = np.zeros(len(data), bool)
        cuts[offsets[:-1][offsets[:-1] < len(data)]] = True
        cuts[1:] |= blank[1:] & ~ends[:-1]
        before, after = data[:-1], data[1:]
        cuts[1:] |= (before < 0x80) & (after < 0x80) & (before != 0x20) & (after != 0x20) & ~self.joined[before, after]
        places = np.flatnonzero(cuts)
        coded = strings_of(data, np.append(places, len(data))).dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        held = self.segments.values_of(coded.dictionary.to_pylist())
        ids = np.frombuffer(b"".join(held), IDS)
        lengths = np.array([len(h) // IDS.itemsize for h in held], np.int64)
        firsts = np.cumsum(lengths) - lengths
        parts = lengths[codes]
        before = np.concatenate([[0], np.cumsum(parts)])
        flat = ids[np.repeat(firsts[codes] - before[:-1], parts) + np.arange(before[-1])]
        bounds = before[np.searchsorted(places, offsets)] * IDS.itemsize
        buffers = [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(flat))]
        return pa.Array.from_buffers(pa.large_binary(), len(texts), buffers).cast(pa.binary())

    def decode(self, ids: bytes) -> str:
        """Text of some ids; bytes that are no UTF-8 become U+FFFD, control pieces nothing."""
        raw = b"".join(map(self.raw.__getitem__, np.frombuffer(ids, IDS).tolist()))
        return raw.decode("utf-8", "replace").removeprefix(" " if self.prefix else "")

    def decode_all(self, ids: pa.Array) -> pa.Array:
        """The same for many at once."""
        raw, offsets = bytes_of(ids)
        numbers, offsets = np.frombuffer(raw.tobytes(), IDS), offsets // IDS.itemsize
        lengths = np.array([len(r) for r in self.raw], np.int64)
        firsts = np.cumsum(lengths) - lengths
        parts = lengths[numbers]
        before = np.concatenate([[0], np.cumsum(parts)])
        table = np.frombuffer(b"".join(self.raw), np.uint8)
        flat = table[np.repeat(firsts[numbers] - before[:-1], parts) + np.arange(before[-1])]
        bounds = before[offsets]
        if self.prefix:
            starts = bounds[:-1][bounds[:-1] < bounds[1:]]
            dropped = np.zeros(len(flat) + 1, bool)
            dropped[starts[flat[starts] == 0x20]] = True
            bounds = bounds - np.concatenate([[0], np.cumsum(dropped)])[bounds]
            flat = flat[~dropped[:-1]]
        found = strings_of(flat, bounds)
        try:
            found.validate(full=True)
        except pa.ArrowInvalid:
            return pa.array([self.decode(i) for i in ids.to_pylist()], pa.string())
        return found.cast(pa.string())


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` of whole texts: ids as little-endian unsigned 32-bit numbers.

    NULL and empty texts have no ids. Every row gives a row, repeated rows and
    NULL ids too; an empty table gives an empty result; other columns are not
    read. A text is cut where no piece reaches across, segments seen before are
    looked up in a bounded cache of the worker, and nothing is shuffled. Models
    that normalise by a map of characters are refused.
    """
    texts = texts_of(docs, id_col, text_col)
    kind = type_of(texts, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = Transducer.of(path)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), transducer.encode(batch.column("text"))], ["doc_id", "ids"])

    return texts.mapInArrow(run, f"doc_id {kind}, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, text``: the texts of ids that ``encode`` made; NULL ids give an empty text."""
    rows = encoded.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids"))
    kind = type_of(rows, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = Transducer.of(path)
        for batch in slices(batches, "ids"):
            texts = transducer.decode_all(batch.column("ids"))
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], ["doc_id", "ids", "text"])

    return rows.mapInArrow(run, f"doc_id {kind}, ids binary, text string")

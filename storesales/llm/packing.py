"""Packing of token sequences along a space-filling curve through hashed document vectors."""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storesales.llm.common import cut, slices, texts_of, type_of
from storesales.llm.pretokens import PretokenCache, merge_bytes, parts_of, tokenizer, unusual

# Dimensions of the projected document vectors, and bits of each in the curve's key.
DIMENSIONS, BITS = 4, 12

# Ids are held as unsigned 16-bit numbers; vocabularies must be no larger.
IDS = np.dtype("<u2")

_caches: dict[str, PretokenCache] = {}


def _ids_of(path: str) -> PretokenCache:
    if path not in _caches:
        _caches.clear()
        _caches[path] = PretokenCache(merge_bytes(path), lambda ids: array("H", ids).tobytes())
    return _caches[path]


def encode(texts: pa.Array, path: str, special: tuple[str, ...], end: int, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ids of all texts, each closed by ``end``, laid end to end; their numbers, and the sums of their directions.

    Ids and sums are looked up by distinct part and put together by the parts' numbers.
    """
    whole = unusual(texts, special, mixed_space=True)
    found, counts = parts_of(pc.if_else(pa.array(whole), "", texts) if whole.any() else texts, keep_space=True)
    coded = found.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    held = _ids_of(path).values_of(coded.dictionary.to_pylist())
    closing = len(held)
    held.append(np.array([end], IDS).tobytes())
    # A text that is encoded whole has a single part of its own.
    ends, added = np.cumsum(counts), []
    for i, alone in enumerate(whole.tolist()):
        if alone:
            added.append((ends[i], len(held)))
            held.append(np.array(tokenizer(path).encode(texts[i].as_py(), add_special_tokens=False).ids, IDS).tobytes())
        added.append((ends[i], closing))
    codes = np.insert(codes, *np.array(added, np.int64).T)
    counts = counts + 1 + whole

    ids = np.frombuffer(b"".join(held), IDS)
    lengths = np.array([len(h) // IDS.itemsize for h in held])
    firsts = np.cumsum(lengths) - lengths
    running = np.concatenate([np.zeros((1, directions.shape[1]), np.int64), np.cumsum(directions[ids], axis=0)])
    sums = running[firsts + lengths] - running[firsts]
    parts = lengths[codes]
    before = np.cumsum(parts) - parts
    flat = ids[np.repeat(firsts[codes] - before, parts) + np.arange(int(parts.sum()))]
    starts = np.cumsum(counts) - counts
    places = np.column_stack([np.add.reduceat(sums[:, j][codes], starts) for j in range(sums.shape[1])])
    return flat, np.add.reduceat(parts, starts), places


def _directions() -> np.ndarray:
    """A hashed direction for every possible id, in units of 2**-23: the random projection of its one-hot vector."""
    ids = np.arange(1 << 16, dtype=np.uint64)[:, None] * np.uint64(DIMENSIONS) + np.arange(DIMENSIONS, dtype=np.uint64)
    ids = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    ids = (ids ^ (ids >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    ids ^= ids >> np.uint64(27)
    return (ids >> np.uint64(40)).astype(np.int64) - (1 << 23)


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of points with coordinates from 0 to 2**bits - 1 (a row per point).

    Coordinates are turned into the curve's transposed key by exchanging and
    inverting low bits from the highest bit down and Gray-coding the result.
    """
    x = points.astype(np.int64).T.copy()
    n = len(x)
    for b in range(bits - 1, 0, -1):
        q, low = 1 << b, (1 << b) - 1
        for i in range(n):
            set_ = (x[i] & q) != 0
            t = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(set_, x[0] ^ low, x[0] ^ t)
            x[i] ^= t
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        t = np.where((x[n - 1] & (1 << b)) != 0, t ^ ((1 << b) - 1), t)
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def pack(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 2048,
    end_id: int = 1,
    special: tuple[str, ...] = ("<|endoftext|>",),
) -> DataFrame:
    """Documents cut into pieces that fill sequences of ``length`` tokens, a row per piece.

    ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids``:
    which tokens of the document (``ids`` holds them as little-endian 16-bit
    numbers) lie where in which sequence. Every document ends in ``end_id``.
    All sequences are full but the last, so padding is below one sequence.

    A document's vector is the mean of hashed directions of its ids, projected
    to a few dimensions; documents are range-sorted by their place on a Hilbert
    curve through that space, so similar ones share sequences. Only keys and
    sizes are sorted, with running sizes per range; what crosses ranges is one
    sum per range, so no task sees the whole order. Texts are encoded once and
    written out; the ids move once, to meet their places.

    NULL and empty texts have one token, the end. Documents at the same place
    are ordered by id and place in the written table; repeated rows are packed
    each. An empty table gives an empty result. Other columns are ignored.
    """
    texts = texts_of(docs, id_col, text_col)
    kind = type_of(texts, "doc_id")

    def encoded_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions = _directions()
        for batch in slices(batches):
            flat, sizes, sums = encode(batch.column("text"), path, special, end_id, directions)
            means = sums / sizes[:, None] / (1 << 23)
            cells = np.clip((means * 2 + 0.5) * (1 << BITS), 0, (1 << BITS) - 1)
            bounds = np.concatenate([[0], np.cumsum(sizes)]) * IDS.itemsize
            ids = pa.Array.from_buffers(
                pa.large_binary(), len(sizes), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(flat))]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(hilbert_key(cells)), pa.array(sizes), ids.cast(pa.binary())],
                ["doc_id", "curve", "size", "ids"],
            )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            ends = before + np.cumsum(sizes, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(sizes), bucket, np.int64)), pa.array(ends - sizes), pa.array(ends), batch.column("row")],
                ["bucket", "at", "end", "row"],
            )
            before = int(ends[-1]) if len(ends) else before

    encoded = cut(
        texts.mapInArrow(encoded_batches, f"doc_id {kind}, curve long, size long, ids binary").withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "packing-ids",
    )
    order = ["curve", "doc_id", "row"]
    sorted_ = encoded.select(*order, "size").repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = cut(
        sorted_.select("row", "size").mapInArrow(number, "bucket long, at long, end long, row long"), "packing-order"
    )
    sizes = numbered.groupBy("bucket").agg(F.max("end").alias("n"))
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # A row per range: as many as the shuffle has partitions.
    bases = sizes.select("bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    starts = numbered.join(F.broadcast(bases), "bucket").select("row", (F.col("base") + F.col("at")).alias("at"))
    placed = encoded.select("row", "doc_id", "ids").join(starts.hint("shuffle_hash"), "row").drop("row")

    def chop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids"):
            out: list[list] = [[] for _ in range(8)]
            for doc, at, ids in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "at", "ids")), strict=True):
                total = len(ids) // IDS.itemsize
                start = 0
                while start < total:
                    sequence, offset = divmod(at + start, length)
                    size = min(total - start, length - offset)
                    piece = ids[start * IDS.itemsize : (start + size) * IDS.itemsize]
                    crc = zlib.crc32(np.frombuffer(piece, IDS).astype("<u4").tobytes())
                    for column, value in zip(out, (doc, start, size, crc, total, sequence, offset, piece), strict=True):
                        column.append(value)
                    start += size
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out[0], batch.schema.field("doc_id").type),
                    *(pa.array(c, pa.int64()) for c in out[1:7]),
                    pa.array(out[7], pa.binary()),
                ],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    return placed.mapInArrow(
        chop,
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long, ids binary",
    )

"""Token counts of texts by a two-tier lookup of pre-token lengths in the map tasks."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storesales.llm.common import slices, texts_of, type_of
from storesales.llm.pretokens import PretokenCache, merge_words, parts_of, tokenizer, unusual

# Rows of the broadcast table; with words of ordinary length it stays below 1 MB.
FREQUENT = 65_536

# Candidates a map task keeps while it counts, and those that it hands on.
COUNTED, HANDED_ON = 400_000, 20_000

SPECIAL = ("<|startoftext|>", "<|endoftext|>")

_caches: dict[tuple[str, int], PretokenCache] = {}


def _parts(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
    """Which texts the library has to count whole, the distinct parts of the others, all parts' numbers, and how many each text has."""
    whole = unusual(texts, SPECIAL, mixed_space=False)
    found, counts = parts_of(pc.if_else(pa.array(whole), "", texts) if whole.any() else texts, keep_space=False)
    coded = found.dictionary_encode()
    return whole, coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), counts


def frequent_pretokens(texts: DataFrame, most: int = FREQUENT) -> list[str]:
    """About the ``most`` most frequent pre-tokens of all texts, in any script.

    Each map task counts its own, forgets the rarer half whenever it holds more
    than ``COUNTED``, and hands on its ``HANDED_ON`` most frequent ones; only
    these summaries are merged. What is missed is merely looked up later.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in slices(batches):
            _, words, codes, _ = _parts(batch.column("text"))
            seen.update(dict(zip(words, np.bincount(codes, minlength=len(words)).tolist(), strict=True)))
            if len(seen) > COUNTED:
                seen = Counter(dict(seen.most_common(COUNTED // 2)))
        top = seen.most_common(HANDED_ON)
        yield pa.RecordBatch.from_pydict(
            {"word": pa.array([w for w, _ in top], pa.string()), "n": pa.array([n for _, n in top], pa.int64())}
        )

    summaries = texts.select("text").mapInArrow(count, "word string, n long")
    top = summaries.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(most)
    return [row["word"] for row in top.select("word").collect()]


def pack_table(words: list[str], path: str) -> bytes:
    """Words and their numbers of tokens, compressed; longer words are left to the caches."""
    found = tokenizer(path).encode_batch_fast(words, add_special_tokens=False)
    kept = [(w, len(e.ids)) for w, e in zip(words, found, strict=True) if len(w) <= 64 and len(e.ids) < 256]
    lengths = bytes(n for _, n in kept)
    return zlib.compress(len(kept).to_bytes(4, "little") + lengths + "\n".join(w for w, _ in kept).encode())


def unpack_table(table: bytes) -> dict[str, int]:
    raw = zlib.decompress(table)
    n = int.from_bytes(raw[:4], "little")
    return dict(zip(raw[4 + n :].decode().split("\n"), raw[4 : 4 + n], strict=True)) if n else {}


def count_tokens(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 2048,
    frequent: int = FREQUENT,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit``: whole texts counted as the library for the vocabulary at ``path`` does.

    First tier: a broadcast table of the lengths of at most ``frequent``
    pre-tokens. Second tier: a bounded cache in each Python worker, filled
    through the library. No pre-token is shuffled; beside the summaries that
    fill the first tier there is no exchange at all.

    NULL and empty texts have no bytes and no tokens. Every row gives a row, in
    any order, so repeated rows and NULL ids stay; an empty table gives an empty
    result. Other columns are not read.
    """
    texts = texts_of(docs, id_col, text_col)
    kind = type_of(texts, "doc_id")
    shared = docs.sparkSession.sparkContext.broadcast(pack_table(frequent_pretokens(texts, frequent), path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (path, zlib.crc32(shared.value))
        if key not in _caches:
            _caches.clear()
            _caches[key] = PretokenCache(merge_words(path), len, unpack_table(shared.value))
        lengths = _caches[key]
        for batch in slices(batches):
            whole, words, codes, parts = _parts(batch.column("text"))
            totals = np.concatenate([[0], np.cumsum(np.array(lengths.values_of(words), np.int64)[codes])])
            ends = np.cumsum(parts)
            counts = totals[ends] - totals[ends - parts]
            for i in np.flatnonzero(whole):
                counts[i] = len(tokenizer(path).encode(batch.column("text")[i].as_py(), add_special_tokens=False).ids)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pc.binary_length(batch.column("text")).cast(pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(counts > limit, pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return texts.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")

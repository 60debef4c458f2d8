"""Ranked lexical search by MaxScore whose bounds also know pairs of terms."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storesales.llm.common import cut, slices, texts_of, type_of
from storesales.llm.spans import byte_class, runs_of

#: Bytes of terms: digits, letters, and all parts of characters from U+0080 on.
TERM_BYTES = byte_class(range(0x30, 0x3A), range(0x41, 0x5B), range(0x61, 0x7B), range(0x80, 0x100))

#: Fixed values of the score: thousandths of a weight, scale of an impact, and the share of a document's length in its norm.
WEIGHT_SCALE, IMPACT_SCALE, TF_SCALE, NORM_SCALE, LENGTH_PERCENT = 1000, 1_000_000_000, 1000, 8, 90

# Text of the items that are searched at once: their terms are broadcast. More items are searched in blocks.
ITEM_BYTES = 8 << 20

# A block of the index is closed at so many documents or postings.
BLOCK_DOCUMENTS, BLOCK_POSTINGS = 8192, 1 << 20

# Terms of an item are paired with so many of the next ones in the order of their weights.
PARTNERS = 3

# Sub-groups in which an item's best documents are found before they meet.
SALTS = 16


@dataclass
class Items:
    """Queries: the terms of all, in order, and which of them each item has."""

    ids: pa.Array
    vocabulary: pa.Array
    terms: list[np.ndarray]
    # Known after the first pass.
    weights: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    pairs: np.ndarray = field(default_factory=lambda: np.empty((0, 2), np.int64))  # two terms each, in order
    item_pairs: list[np.ndarray] = field(default_factory=list)  # of each term of an item with the next ones; -1 without one

    def weigh(self, frequencies: np.ndarray, documents: int) -> None:
        """Weights of the terms from their document frequencies, and the pairs whose joint maxima are kept.

        A term that no document holds, or that all hold, weighs nothing and leaves the items.
        """
        self.weights = np.array(
            [math.floor(WEIGHT_SCALE * math.log((2 * documents + 2) / (2 * n + 1))) if n else 0 for n in frequencies.tolist()],
            np.int64,
        )
        self.terms = [t[self.weights[t] > 0] for t in self.terms]
        self.terms = [t[np.argsort(-self.weights[t], kind="stable")] for t in self.terms]
        gaps = range(1, PARTNERS + 1)
        keys = [np.concatenate([np.minimum(t[:-g], t[g:]) << 32 | np.maximum(t[:-g], t[g:]) for g in gaps]) for t in self.terms]
        found = np.unique(np.concatenate(keys)) if keys else np.empty(0, np.int64)
        self.pairs = np.column_stack([found >> 32, found & 0xFFFFFFFF])
        self.item_pairs = []
        for t, own in zip(self.terms, keys, strict=True):
            table, done = np.full((len(t), PARTNERS), -1), 0
            for g in gaps:
                n = max(0, len(t) - g)
                table[:n, g - 1] = np.searchsorted(found, own[done : done + n])
                done += n
            self.item_pairs.append(table)


def items_of(ids: pa.Array, texts: pa.Array) -> Items:
    """Items from their ids and texts (NULL: empty)."""
    found = runs_of(pc.fill_null(texts, ""), TERM_BYTES)
    coded = found.strings.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(found.counts)
    terms = [np.unique(codes[e - n : e]) for e, n in zip(ends, found.counts, strict=True)]
    return Items(ids, coded.dictionary.cast(pa.large_string()), terms)


def _postings(texts: DataFrame, items, kind: str) -> DataFrame:
    """``doc_id, n, terms, tfs`` of the documents with a term: their length, and which of the items' terms they hold how often."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = items.value.vocabulary
        for batch in slices(batches):
            found = runs_of(batch.column("text"), TERM_BYTES)
            codes = pc.index_in(found.strings, vocabulary).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            doc = np.repeat(np.arange(len(found.counts)), found.counts)[codes >= 0]
            keys, tfs = np.unique(doc << 32 | codes[codes >= 0], return_counts=True)
            bounds = np.searchsorted(keys >> 32, np.arange(len(found.counts) + 1))
            terms, tfs = (keys & 0xFFFFFFFF).astype("<u4"), tfs.astype("<u4")
            cuts = list(zip(bounds, bounds[1:], strict=False))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(found.counts, pa.int64()),
                    pa.array([terms[a:b].tobytes() for a, b in cuts], pa.binary()),
                    pa.array([tfs[a:b].tobytes() for a, b in cuts], pa.binary()),
                ],
                ["doc_id", "n", "terms", "tfs"],
            ).filter(pa.array(found.counts > 0))

    return cut(texts.mapInArrow(scan, f"doc_id {kind}, n long, terms binary, tfs binary"), "search-postings")


def _totals(postings: DataFrame, vocabulary: int) -> tuple[int, int, np.ndarray]:
    """The documents with a term, their length together, and in how many of them each of the terms is."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents, length, frequencies = 0, 0, np.zeros(vocabulary, np.int64)
        for batch in batches:
            documents += batch.num_rows
            length += sum(batch.column("n").to_pylist())
            codes = np.frombuffer(b"".join(batch.column("terms").to_pylist()), "<u4")
            frequencies += np.bincount(codes, minlength=vocabulary)
        terms = np.flatnonzero(frequencies)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(terms, [-1, -2])), pa.array(np.append(frequencies[terms], [documents, length]))], ["term", "n"]
        )

    # At most a row per term of the items, whatever the documents.
    rows = postings.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    found = dict(zip(rows.column("term").to_pylist(), rows.column("n").to_pylist(), strict=True))
    frequencies = np.array([found.get(t, 0) for t in range(vocabulary)], np.int64)
    return found.get(-1, 0), found.get(-2, 0), frequencies


@dataclass
class Block:
    """The index of some documents: lists of postings by term, and joint maxima of pairs of terms."""

    doc_ids: pa.Array
    terms: np.ndarray  # with a list, ascending
    starts: np.ndarray  # of their lists, and one past the last
    docs: np.ndarray  # numbers of the documents within a list, ascending
    impacts: np.ndarray
    pairs: np.ndarray  # those with a document that holds both
    joint: np.ndarray  # the largest weighted impact of both together
    seeds: np.ndarray  # a score that some document of the block has, by item


SCHEMA = "terms binary, starts binary, docs binary, impacts binary, pairs binary, joint binary, seeds binary"
TYPES = {"terms": "<u4", "starts": "<i8", "docs": "<u4", "impacts": "<u4", "pairs": "<u4", "joint": "<i8", "seeds": "<i8"}


def make_block(doc_ids: pa.Array, lengths: list[int], terms: list[bytes], tfs: list[bytes], items: Items, documents: int, length: int) -> Block:
    """A block of the index from rows of postings."""
    sizes = np.array([len(t) // 4 for t in terms])
    codes = np.frombuffer(b"".join(terms), "<u4").astype(np.int64)
    tf = np.frombuffer(b"".join(tfs), "<u4").astype(np.int64)
    # Whole numbers of any size, as long as this is done per document.
    norms = [100 - LENGTH_PERCENT + LENGTH_PERCENT * n * documents // length for n in lengths]
    m = np.repeat(np.array(norms, np.int64), sizes)
    impacts = IMPACT_SCALE * tf // (TF_SCALE * tf + NORM_SCALE * m)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(codes, kind="stable")
    sorted_codes = codes[order]
    present = np.unique(sorted_codes)
    starts = np.append(np.searchsorted(sorted_codes, present), len(codes))
    docs, listed = doc[order], impacts[order]
    place = np.full(len(items.weights), -1)
    place[present] = np.arange(len(present))

    joint = np.zeros(len(items.pairs), np.int64)
    weighted = listed * items.weights[sorted_codes]
    both = np.flatnonzero((place[items.pairs] >= 0).all(axis=1)) if len(items.pairs) else np.empty(0, np.int64)
    scattered, last = np.zeros(len(sizes), np.int64), -1
    for p in both:
        a, b = items.pairs[p]
        of_a, of_b = (slice(starts[place[t]], starts[place[t] + 1]) for t in (a, b))
        if a != last:
            scattered.fill(0)
            scattered[docs[of_a]] = weighted[of_a]
            last = a
        meeting = scattered[docs[of_b]]
        joint[p] = np.where(meeting > 0, meeting + weighted[of_b], 0).max()
    pairs = np.flatnonzero(joint)

    # A seed is the whole score of the document where an item's strongest term is strongest.
    firsts = np.cumsum(sizes) - sizes
    maxima = np.zeros(len(items.weights), np.int64)
    if len(present):
        maxima[present] = np.maximum.reduceat(weighted, starts[:-1])
    seeds, asked = np.zeros(len(items.terms), np.int64), np.zeros(len(items.weights), np.int64)
    for i, t in enumerate(items.terms):
        if not len(t) or not maxima[t].any():
            continue
        strongest = place[t[maxima[t].argmax()]]
        own = slice(starts[strongest], starts[strongest + 1])
        d = docs[own][weighted[own].argmax()]
        asked[t] = items.weights[t]
        row = slice(firsts[d], firsts[d] + sizes[d])
        seeds[i] = (asked[codes[row]] * impacts[row]).sum()
        asked[t] = 0
    return Block(doc_ids, present, starts, docs, listed, pairs, joint[pairs], seeds)


def _index(postings: DataFrame, items, documents: int, length: int, kind: str) -> DataFrame:
    """A row per block of documents that one map task read."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = postings = 0

        def close() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            ids = pa.concat_arrays(table.column("doc_id").chunks)
            block = make_block(ids, *(table.column(c).to_pylist() for c in ("n", "terms", "tfs")), items.value, documents, length)
            packed = [pa.array([getattr(block, name).astype(type_).tobytes()], pa.binary()) for name, type_ in TYPES.items()]
            return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), *packed], ["doc_ids", *TYPES])

        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column("terms")).to_numpy(zero_copy_only=False) // 4)
            start = 0
            while start < batch.num_rows:
                before = int(sizes[start - 1]) if start else 0
                fitting = int(np.searchsorted(sizes, before + BLOCK_POSTINGS - postings, side="right"))
                end = min(max(fitting, start + (not held)), start + BLOCK_DOCUMENTS - rows, batch.num_rows)
                if end > start:
                    held.append(batch.slice(start, end - start))
                    rows, postings = rows + end - start, postings + int(sizes[end - 1]) - before
                if end < batch.num_rows or rows >= BLOCK_DOCUMENTS:
                    yield close()
                    held, rows, postings = [], 0, 0
                start = max(start, end)
        if held:
            yield close()

    return cut(postings.mapInArrow(build, f"doc_ids array<{kind}>, {SCHEMA}"), "search-index")


class Searcher:
    """The best documents of each item in the blocks seen so far, at least as good as ``least`` by item."""

    def __init__(self, items: Items, least: np.ndarray, k: int):
        self.items, self.k, self.least = items, k, np.maximum(least, 1)
        self.best: list[list[tuple[int, object]]] = [[] for _ in items.terms]
        self.blocks_skipped = self.postings_read = 0

    def search(self, block: Block) -> None:
        items = self.items
        place = np.full(len(items.weights), -1)
        place[block.terms] = np.arange(len(block.terms))
        maxima = np.zeros(len(items.weights), np.int64)
        if len(block.terms):
            maxima[block.terms] = np.maximum.reduceat(block.impacts, block.starts[:-1]) * items.weights[block.terms]
        joint = np.zeros(len(items.pairs), np.int64)
        joint[block.pairs] = block.joint
        totals = np.zeros(len(block.doc_ids), np.int64)
        for i, terms in enumerate(items.terms):
            own = np.flatnonzero(place[terms] >= 0)[::-1]
            if len(own):
                self._item(i, own, self._bounds(i, own, maxima, joint), place, block, totals)

    def _bounds(self, i: int, own: np.ndarray, maxima: np.ndarray, joint: np.ndarray) -> np.ndarray:
        """What the first terms of ``own``, places in the item by rising weight, add to a score together at most.

        A document holds both terms of a pair, or one, or none, so a pair adds at most the larger of its joint maximum
        and the single ones. Each bound takes the pairs that make it smallest, among neighbours and across one term.
        """
        terms, pairs = self.items.terms[i], self.items.item_pairs[i]
        single = maxima[terms[own]].tolist()

        def both(x: int, y: int) -> int | None:
            gap = int(own[x] - own[y])
            if gap > PARTNERS or (pair := int(pairs[own[y], gap - 1])) < 0:
                return None
            return max(int(joint[pair]), single[x], single[y])

        bounds = [0]
        for j, alone in enumerate(single):
            least = bounds[j] + alone
            if j >= 1 and (pair := both(j - 1, j)) is not None:
                least = min(least, bounds[j - 1] + pair)
            if j >= 2 and (pair := both(j - 2, j)) is not None:
                least = min(least, bounds[j - 2] + pair + single[j - 1])
            bounds.append(least)
        return np.array(bounds)

    def _item(self, i: int, own: np.ndarray, bounds: np.ndarray, place: np.ndarray, block: Block, totals: np.ndarray) -> None:
        least = int(self.least[i])
        if bounds[-1] < least:
            self.blocks_skipped += 1
            return

        def postings(at: int):
            t = self.items.terms[i][own[at]]
            where = slice(block.starts[place[t]], block.starts[place[t] + 1])
            return block.docs[where], block.impacts[where], int(self.items.weights[t])

        # Documents that are only in the lists before this one cannot be good enough.
        essential = int(np.flatnonzero(bounds < least)[-1])
        totals.fill(0)
        for at in range(essential, len(own)):
            docs, impacts, weight = postings(at)
            totals[docs] += impacts * weight
            self.postings_read += len(docs)
        found = np.flatnonzero(totals)
        for at in range(essential - 1, -1, -1):
            if len(found) >= self.k:
                least = max(least, int(np.partition(totals[found], -self.k)[-self.k]))
            found = found[totals[found] + bounds[at + 1] >= least]
            if not len(found):
                return
            docs, impacts, weight = postings(at)
            where = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
            there = docs[where] == found
            totals[found[there]] += impacts[where[there]] * weight
            self.postings_read += int(there.sum())
        if len(found) > self.k:
            least = max(least, int(np.partition(totals[found], -self.k)[-self.k]))
        found = found[totals[found] >= least]
        ids = block.doc_ids.take(pa.array(found)).to_pylist()
        best = self.best[i] + list(zip(totals[found].tolist(), ids, strict=True))
        best.sort(key=lambda x: (-x[0], x[1] is None, x[1]))
        self.best[i] = best[: self.k]
        if len(best) >= self.k:
            self.least[i] = max(int(self.least[i]), self.best[i][-1][0])


def _first(rows: DataFrame, k: int, tie: str) -> DataFrame:
    """The ``k`` best rows of each item, with their rank; found in salted sub-groups first."""
    best_first = (F.desc("score"), F.asc_nulls_last(tie))
    salted = Window.partitionBy("item", F.pmod(F.xxhash64(tie), F.lit(SALTS))).orderBy(*best_first)
    kept = rows.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= k)
    return kept.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*best_first))).where(F.col("rank") <= k)


def _least(index: DataFrame, items: int, k: int) -> np.ndarray:
    """A score that ``k`` documents reach at least, by item: the ``k``-th best seed, since blocks share no document."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, items), np.int64)
        for batch in batches:
            more = np.frombuffer(b"".join(batch.column("seeds").to_pylist()), "<i8").reshape(-1, items)
            held = -np.sort(-np.concatenate([held, more]), axis=0)[:k]
        _, columns = np.nonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(columns), pa.array(held[np.nonzero(held)])], ["item", "score"])

    seeds = index.select("seeds").mapInArrow(best, "item long, score long")
    least = np.zeros(items, np.int64)
    for row in _first(seeds, k, "score").where(F.col("rank") == k).select("item", "score").collect():  # one per item
        least[row["item"]] = row["score"]
    return least


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of the highest scores above 0 for each item, exactly.

    1. One pass over the texts keeps what the items ask for: a document's
       length and the frequencies of the items' terms in it, found by their
       bytes, not by hashes. Its table gives the corpus' statistics.
    2. Documents of a map task are indexed in blocks: lists of impacts by term
       and, for terms that neighbour each other in an item's order of weights,
       the largest weighted impact that the two reach together. Each block also
       holds one whole score per item; the ``k``-th best of these over all
       blocks is where every search starts.
    3. Each block is searched by MaxScore: terms are put in pairs so that their
       bounds together are smallest, lists whose bounds together stay below the
       worst score wanted are only looked up for documents found in others, and
       whole blocks are passed over. What is passed over has a lower score.

    Items are collected and broadcast in blocks of about ``ITEM_BYTES`` of text
    (a longer item makes one of its own), each with a pass over the documents.
    Nothing about single documents reaches the driver.

    Equal scores rank by rising id, NULL ids last. NULL and empty texts have no
    terms and are never found, nor do items without terms find any. Repeated
    documents are found each; a repeated item counts once, and different texts
    of one item id are ranked each. Empty tables give an empty result. Other
    columns are not read.
    """
    asked = items.select(F.col(item_col).alias("item_id"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text")).distinct()
    size = asked.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = -(-size // ITEM_BYTES) or 1
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    texts = texts_of(docs, id_col, text_col)
    found = [_search(texts, asked.where(F.col("block") == b).drop("block"), k) for b in range(blocks)]
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def _search(texts: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    spark = texts.sparkSession
    kind, item_kind = type_of(texts, "doc_id"), type_of(asked, "item_id")
    rows = asked.toArrow().combine_chunks()
    ids, words = (pa.concat_arrays(c.chunks) if c.num_chunks else pa.array([], c.type) for c in rows.columns)
    items = items_of(ids, words)
    schema = f"item long, item_id {item_kind}, doc_id {kind}, score long"
    postings = _postings(texts, spark.sparkContext.broadcast(items), kind)
    documents, length, frequencies = _totals(postings, len(items.vocabulary))
    items.weigh(frequencies, documents)
    known = spark.sparkContext.broadcast(items)
    index = _index(postings.where(F.octet_length("terms") > 0), known, documents, length, kind)
    least = spark.sparkContext.broadcast(_least(index, len(items.terms), k))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(known.value, least.value, k)
        doc_type = None
        for batch in batches:
            doc_type = batch.column("doc_ids").type.value_type
            for row in range(batch.num_rows):
                parts = {name: np.frombuffer(batch.column(name)[row].as_py(), type_).astype(np.int64) for name, type_ in TYPES.items()}
                searcher.search(Block(batch.column("doc_ids")[row].values, **parts))
        if doc_type is not None:
            yield _found(searcher.best, known.value.ids, doc_type)

    found = index.mapInArrow(look, schema)
    return _first(found, k, "doc_id").select("item_id", "rank", "doc_id", "score")


def _found(best: Iterable[list], ids: pa.Array, doc_type: pa.DataType) -> pa.RecordBatch:
    flat = [(i, doc, score) for i, some in enumerate(best) for score, doc in some]
    at = pa.array([i for i, _, _ in flat], pa.int64())
    return pa.RecordBatch.from_arrays(
        [at, ids.take(at), pa.array([d for _, d, _ in flat], doc_type), pa.array([s for _, _, s in flat], pa.int64())],
        ["item", "item_id", "doc_id", "score"],
    )

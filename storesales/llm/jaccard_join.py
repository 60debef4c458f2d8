"""Self-join of texts by the Jaccard similarity of their word n-grams, whose global order is cut into fragments.

Every set is cut where the order is cut. The n-grams that two sets share are
counted in each fragment on its own, and the partial overlaps summed per pair.
Which pairs are worth counting is told by the first n-grams of the sets, which
meet in finer fragments of the same order.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storesales.llm.common import cut, plan_bytes, slices, small_enough, texts_of, type_of
from storesales.llm.components import components
from storesales.llm.words import mix, run_hashes, words_of

# Counters of the frequency table: one per this many bytes of input, within these bounds.
BYTES_PER_COUNTER = 64
FEWEST_COUNTERS, MOST_COUNTERS = 1 << 14, 1 << 24
PART = 1 << 14

# Sizes above this are the optimizer's guess for a table it knows nothing of.
UNKNOWN_BYTES = 1 << 55

# Entries that a map task holds before it hands them on, and sets it remembers to skip copies.
HELD_ENTRIES, HELD_SETS = 1 << 20, 1 << 18

# Rows of ids up to which a table is broadcast rather than shuffled with texts.
BROADCAST_ROWS = 2_000_000

# Fragments in which the overlap of a pair is counted.
FRAGMENTS = 8

# Rounds in which the most central set of each bucket is compared with the others, before hubs by hash.
CENTRES = 2

# Pairs of a bucket left for an entry, on average, up to which those that may link are counted; all are compared in one
# round if they are no more than the entries.
PAIRS_AT_ONCE = 512

# One in so many sets of a level is a hub of the next.
FAN = 8

# An n-gram in about so many sets has its list of sets dealt to sub-lists, of which there are so many.
LONG_LIST, SUB_LISTS = 1 << 20, 64


def shingle_sets(texts: list[str], n: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's word n-grams; with fewer words, of all of them as one."""
    words = words_of(texts, lower=True)
    runs = run_hashes(words.hashes, n)
    sets = []
    for a, b in zip(words.bounds, words.bounds[1:], strict=False):
        if b - a < n:
            sets.append(run_hashes(words.hashes[a:b], b - a) if b > a else np.empty(0, np.uint64))
            continue
        codes = np.sort(runs[a : b - n + 1])
        sets.append(codes[np.concatenate([[True], codes[1:] != codes[:-1]])])
    return sets


def mark_of(text: str) -> Column:
    """Tells the texts of rows with the same id, or none, apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _set_id(codes: np.ndarray, bits: int = 64) -> int:
    return (xxhash.xxh3_64_intdigest(codes.tobytes()) >> (64 - bits)) - (1 << 63)


def _other_id(codes: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(codes.tobytes(), 29) - (1 << 63)


@dataclass(frozen=True)
class Naming:
    """Ids of sets: a hash, or another one where two different sets were found to share it."""

    contested: frozenset[int]
    bits: int

    def of(self, codes: np.ndarray) -> int:
        sid = _set_id(codes, self.bits)
        return _other_id(codes) if sid in self.contested else sid


def _prefix(n: int, percent: int) -> int:
    """How many of a set's first n-grams hold one that it shares with every set it links to."""
    return n - -(-percent * n // 100) + 1


def _sets_and_counts(texts: DataFrame, kind: str, n: int, bits: int, id_bits: int) -> DataFrame:
    """A row per text with its mark and its set's two ids and size, and rows with the map tasks' counts of hashed n-grams."""
    names = ["doc_id", "mark", "sid", "other", "n", "part", "counts"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, kind = np.zeros(1 << bits, np.uint32), None
        for batch in slices(batches):
            kind = batch.column("doc_id").type
            sets = shingle_sets(batch.column("text").to_pylist(), n)
            for codes in sets:
                counts[codes >> np.uint64(64 - bits)] += np.uint32(1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("mark"),
                    pa.array([_set_id(s, id_bits) if len(s) else None for s in sets], pa.int64()),
                    pa.array([_other_id(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.nulls(len(sets), pa.int32()),
                    pa.nulls(len(sets), pa.binary()),
                ],
                names,
            )
        for part, some in enumerate(counts.reshape(-1, PART)):
            if some.any():
                packed = [pa.array([part], pa.int32()), pa.array([zlib.compress(some.tobytes(), 1)], pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.nulls(1, kind), *(pa.nulls(1, pa.int64()) for _ in range(4)), *packed], names)

    schema = f"doc_id {kind}, mark long, sid long, other long, n long, part int, counts binary"
    return cut(texts.withColumn("mark", mark_of("text")).mapInArrow(scan, schema), "jaccard-sets")


def _contested(sets: DataFrame) -> frozenset[int]:
    """Ids that different sets share: none is to be expected among 1e9 sets, a few among 1e10."""
    both = sets.where("sid IS NOT NULL").groupBy("sid").agg(F.min("other").alias("low"), F.max("other").alias("high"))
    return frozenset(row["sid"] for row in both.where("low <> high").select("sid").toLocalIterator())


def _levels(counts: DataFrame, bits: int) -> np.ndarray:
    """Four times the log of every counter's sum: a byte each, at most ``MOST_COUNTERS`` of them."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, packed in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                total = sums.setdefault(part, np.zeros(PART, np.int64))
                total += np.frombuffer(zlib.decompress(packed), np.uint32)
        levels = [(4 * np.log2(np.maximum(s, 1))).astype(np.uint8).tobytes() for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(levels, pa.binary())], ["part", "levels"])

    summed = counts.repartition("part").mapInArrow(add, "part int, levels binary")
    table = np.zeros((1 << bits) // PART * PART, np.uint8).reshape(-1, PART)
    for row in summed.toLocalIterator():
        table[row["part"]] = np.frombuffer(row["levels"], np.uint8)
    return table.ravel()


@dataclass(frozen=True)
class Order:
    """The global order of n-grams: by the level of their counter, rare ones first, then by hash."""

    levels: np.ndarray
    bits: int

    def level(self, codes: np.ndarray) -> np.ndarray:
        return self.levels[codes >> np.uint64(64 - self.bits)]

    def keys(self, codes: np.ndarray) -> np.ndarray:
        return self.level(codes).astype(np.uint64) << np.uint64(56) | codes >> np.uint64(8)

    def masses(self) -> np.ndarray:
        """About how many n-grams of sets there are of each level."""
        return np.bincount(self.levels, minlength=256) * 2.0 ** (np.arange(256) / 4)

    def slices(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each level, its first slice and its number of slices, where the order is cut into about ``n`` of even mass."""
        masses = self.masses()
        counts = np.maximum(1, np.round(n * masses / masses.sum())).astype(np.int64)
        return np.cumsum(counts) - counts, counts

    def pivots(self, n: int) -> np.ndarray:
        """Keys that cut the order into ``n`` fragments of about even mass."""
        masses = self.masses()
        ends = np.cumsum(masses) / masses.sum()
        wanted = np.arange(1, n) / n
        level = np.searchsorted(ends, wanted)
        inside = (wanted - (ends[level] - masses[level] / masses.sum())) / (masses[level] / masses.sum())
        return level.astype(np.uint64) << np.uint64(56) | (np.clip(inside, 0, 1) * (2.0**56 - 1024)).astype(np.uint64)


def _shared_prefixes(texts: DataFrame, order: Order, naming: Naming, n: int, percent: int, long_list: int) -> DataFrame:
    """``bucket, sid, n, at, weight``: the n-grams in the prefixes of two different sets or more.

    ``at`` is an n-gram's place in its set. All n-grams of the same sets have
    the same ``bucket``, a hash of these, and are counted together afterwards.

    The order is cut into fragments of even mass, and a fragment's entries meet
    in one task, packed into arrays on the way. An n-gram of very many sets is
    met in sub-lists by set instead, which only drop repeated sets; what they
    have in common is then an aggregate with a partial step.
    """
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(order)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    firsts, counts = order.slices(4 * partitions)
    fragments = int(counts.sum())
    long_level = math.ceil(4 * math.log2(long_list))
    names = ["fragment", "tokens", "sids", "sizes", "places"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, seen, held, size = shared.value, set(), [], 0

        def hand_on() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            tokens = np.concatenate([t for t, _, _ in held])
            lengths = [len(t) for t, _, _ in held]
            sids = np.repeat(np.array([s for _, s, _ in held], np.int64), lengths)
            sizes = np.repeat(np.array([k for _, _, k in held], np.int64), lengths)
            level = order.level(tokens)
            place = ((tokens >> np.uint64(32)) * counts[level].astype(np.uint64)) >> np.uint64(32)
            fragment = firsts[level] + place.astype(np.int64)
            long = level >= long_level
            fragment[long] = fragments + sids[long] % SUB_LISTS
            places = np.concatenate([np.arange(k) for k in lengths])
            by = np.argsort(fragment, kind="stable")
            found, cuts = np.unique(fragment[by], return_index=True)
            for f, at in zip(found, np.split(by, cuts[1:]), strict=True):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(f)], pa.int32()), *(pa.array([x[at].tobytes()], pa.binary()) for x in (tokens, sids, sizes, places))],
                    names,
                )

        for batch in slices(batches):
            for codes in shingle_sets(batch.column("text").to_pylist(), n):
                if not len(codes) or (sid := naming.of(codes)) in seen:
                    continue
                if len(seen) >= HELD_SETS:
                    seen.clear()
                seen.add(sid)
                first = np.argsort(order.keys(codes), kind="stable")[: _prefix(len(codes), percent)]
                held.append((codes[first], sid, len(codes)))
                size += len(first)
            if size > HELD_ENTRIES:
                yield from hand_on()
                held, size = [], 0
        yield from hand_on()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for f, *packed in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                held.setdefault(f, []).append(packed)
        while held:
            fragment, parts = held.popitem()
            tokens, sids, sizes, places = (np.frombuffer(b"".join(p[i] for p in parts), np.int64) for i in range(4))
            order = np.lexsort((sids, tokens))
            tokens, sids, sizes, places = tokens[order], sids[order], sizes[order], places[order]
            fresh = np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (sids[1:] != sids[:-1])])
            tokens, sids, sizes, places = tokens[fresh], sids[fresh], sizes[fresh], places[fresh]
            if fragment >= fragments:  # one of the sub-lists: the token stands for the bucket until all are known
                found, bucket = np.ones(len(tokens), bool), tokens
            else:
                firsts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
                runs = np.diff(firsts, append=len(tokens))
                found = np.repeat(runs > 1, runs)
                same_sets = np.bitwise_xor.reduceat(mix(sids.view(np.uint64)), firsts) ^ mix(runs.astype(np.uint64))
                bucket = np.repeat(same_sets.view(np.int64), runs)
            part = pa.array(np.full(int(found.sum()), fragment >= fragments))
            yield pa.RecordBatch.from_arrays([part, *(pa.array(x[found]) for x in (bucket, sids, sizes, places))], ["long", "bucket", "sid", "n", "at"])

    packed = texts.mapInArrow(scan, "fragment int, tokens binary, sids binary, sizes binary, places binary")
    met = packed.repartition(partitions, "fragment").mapInArrow(meet, "long boolean, bucket long, sid long, n long, at long")
    if (order.levels >= long_level).any():
        met = cut(met, "jaccard-lists")
        lists = met.where("long").withColumnRenamed("bucket", "token")
        of_token = lists.groupBy("token").agg(F.bit_xor(F.xxhash64("sid")).alias("sets"), F.count("*").alias("size"))
        of_token = of_token.where("size > 1").select("token", F.xxhash64("sets", "size").alias("bucket"))
        met = met.where("NOT long").unionByName(lists.join(of_token, "token").drop("token"))
    return cut(met.groupBy("bucket", "sid", "n").agg(F.min("at").alias("at"), F.count("*").alias("weight")), "jaccard-prefixes")


def _rest(size: str, percent: int) -> Column:
    """N-grams of a set after its prefix."""
    return F.ceil(F.lit(percent) * F.col(size) / 100) - 1


def _needed(percent: int) -> Column:
    """N-grams that sets of ``na`` and ``nb`` must share to link."""
    return F.ceil(F.lit(percent) * (F.col("na") + F.col("nb")) / (100 + percent))


def _side(mark: str) -> list[Column]:
    names = {"sid": mark, "n": f"n{mark}", "comp": f"c{mark}", "at": f"at_{mark}", "shared": f"s{mark}"}
    return [F.col("bucket"), *(F.col(c).alias(name) for c, name in names.items())]


def _near(percent: int) -> Column:
    """Whether two sets of a bucket, ``a`` and ``b``, in different components, may link.

    The first n-gram that linked sets share has in both at least as many
    n-grams from it on as they must share, so only such places meet. What they
    can share outside the prefixes is bounded by the longer rest.
    """
    longer = F.greatest(_rest("na", percent), _rest("nb", percent))
    return (
        (F.col("ca") != F.col("cb"))
        & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
        & (F.col("at_a") + _needed(percent) <= F.col("na"))
        & (F.col("at_b") + _needed(percent) <= F.col("nb"))
        & (F.least("sa", "sb") + longer >= _needed(percent))
    )


def _central(entries: DataFrame, percent: int, after: int) -> DataFrame:
    """Pairs of the most central set of each bucket with the others; with ``after`` 1, of the most central one outside of its component.

    A set is central if most of its first n-grams are in other sets, and many
    rows have it: a text that others were made from. One row per bucket is found
    by an aggregate with a partial step, so pairs are no more than entries.
    """
    columns = ["central", "copies", "sid", "n", "at", "shared", "comp"]

    def centres(rows: DataFrame) -> DataFrame:
        return rows.groupBy("bucket").agg(F.max(F.struct(*columns)).alias("hub"))

    hubs = centres(entries)
    if after:
        found = hubs.select("bucket", F.col("hub.comp").alias("taken"))
        hubs = centres(entries.join(found, "bucket").where("comp <> taken"))
    return hubs.select("bucket", "hub.*").select(_side("a")).join(entries.select(_side("b")), "bucket").where(_near(percent))


def _by_level(entries: DataFrame, level: int, percent: int) -> DataFrame:
    """Pairs of a hub of this level and a set of no higher one."""
    hubs = entries.where(F.col("level") == level).select(*_side("a"))
    members = entries.where(F.col("level") <= level).select(*_side("b"), F.col("level").alias("lb"))
    return hubs.join(members, "bucket").where(_near(percent) & ((F.col("lb") < level) | (F.col("a") < F.col("b"))))


def _worth_counting(pairs: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """``a, b, needed``: each pair once, whose n-grams in common within the prefixes leave a chance to link."""
    swapped = F.col("a") > F.col("b")
    ordered = pairs.select(
        F.least("a", "b").alias("a"),
        F.greatest("a", "b").alias("b"),
        F.when(swapped, F.col("nb")).otherwise(F.col("na")).alias("na"),
        F.when(swapped, F.col("na")).otherwise(F.col("nb")).alias("nb"),
    )
    met = cut(ordered.distinct(), "jaccard-met")
    left = prefixes.select(F.col("sid").alias("a"), F.col("parts").alias("pa"))
    right = prefixes.select(F.col("sid").alias("b"), F.col("parts").alias("pb"))
    common = F.array_intersect("pa", "pb")
    partial = F.aggregate(common, F.lit(0).cast("long"), lambda total, part: total + part["weight"])
    longer = F.greatest(_rest("na", percent), _rest("nb", percent))
    found = right.join(small_enough(met, BROADCAST_ROWS), "b").join(left, "a").where(partial + longer >= _needed(percent))
    return found.select("a", "b", _needed(percent).cast("long").alias("needed"))


def shared_counts(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """How many n-grams the sets of each row share: arrays of distinct 64-bit hashes."""

    def flat(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(packed), np.uint64), np.repeat(np.arange(len(packed)), [len(p) // 8 for p in packed])

    (a, of_a), (b, of_b) = flat(left), flat(right)
    found, codes = np.unique(np.concatenate([a, b]), return_inverse=True)
    keys = np.sort(np.concatenate([of_a, of_b]) * max(1, len(found)) + codes)
    twice = keys[1:][keys[1:] == keys[:-1]]
    return np.bincount(twice // max(1, len(found)), minlength=len(left))


def _links(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """Those of the pairs that link: partial overlaps are counted per fragment and summed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ta"):
            partial = shared_counts(batch.column("ta").to_pylist(), batch.column("tb").to_pylist())
            columns = [*(batch.column(c) for c in ("a", "b", "needed")), pa.array(partial, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "needed", "overlap"])

    left = segments.select(F.col("sid").alias("a"), "fragment", F.col("tokens").alias("ta"))
    right = segments.select(F.col("sid").alias("b"), "fragment", F.col("tokens").alias("tb"))
    met = right.join(small_enough(pairs, BROADCAST_ROWS), "b").join(left, ["a", "fragment"])
    partial = met.select("a", "b", "needed", "ta", "tb").mapInArrow(count, "a long, b long, needed long, overlap long")
    return partial.groupBy("a", "b", "needed").agg(F.sum("overlap").alias("overlap")).where("overlap >= needed").select("a", "b")


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80
) -> DataFrame:
    """``doc_id, n_shingles, component_id``: the smallest id reachable over links of Jaccard >= ``percent`` / 100.

    Texts in A-Z lower case are cut into words at blanks and the control
    characters 9 to 13; a text's set holds its distinct n-grams of ``n`` words,
    or all its words as one if they are fewer.

    1. One pass finds every set's id and size, and counts n-grams over all
       texts in hashed counters. Their number follows the input up to 2**24, a
       byte each when broadcast; they only order the n-grams, rare ones first.
    2. Two sets that link share an n-gram among the first of both. These are
       handed on by the map tasks, once a set however many texts have it, and
       meet in fragments of the order, where those of a single set fall away.
    3. The sets that are left are cut into ``FRAGMENTS`` fragments of the order.
       For pairs that may link, the n-grams in common are counted in each
       fragment and summed; the sum decides.

    Large groups are not spelled out into pairs. First the most central set of
    each bucket of sets that share n-grams is compared with the others. Buckets
    that are not joined by that go on: if no more pairs may link than there are
    entries, all that are still apart are compared at once. Else the most central set outside
    of the first one's component follows, and then hubs of falling levels, one
    in ``FAN`` of the level below: a pair is only looked at when the higher of
    its two hubs' rounds comes and earlier links have not joined them yet. The
    last round covers all that are still apart, so no link between components is
    missed.

    NULL, empty and blank texts have an empty set and are components of their
    own, as are rows with a NULL id and such a text. Repeated rows share a
    component unless empty. An empty table gives an empty result. Sets are told
    apart by two 64-bit hashes, n-grams by one. Other columns are not read.
    """
    labelled = jaccard_sets(docs, id_col, text_col, n, percent)
    smallest = labelled.where("comp IS NOT NULL").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    return labelled.join(smallest, "comp", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def jaccard_sets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = 5,
    percent: int = 80,
    id_bits: int = 64,
    long_list: int = LONG_LIST,
) -> DataFrame:
    """``doc_id, mark, n, comp``, a row per input row: as ``jaccard_components``, with the text's ``mark_of``.

    Rows of the same ``comp``, whatever their ids, are linked; it is NULL for empty sets, which are not.
    """
    texts = texts_of(docs, id_col, text_col)
    kind = type_of(texts, "doc_id")
    size = plan_bytes(docs)
    if size > UNKNOWN_BYTES:
        size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    wanted = max(1, size // BYTES_PER_COUNTER)
    bits = int(math.log2(min(MOST_COUNTERS, max(FEWEST_COUNTERS, wanted))))
    scanned = _sets_and_counts(texts, kind, n, bits, id_bits)
    sets = scanned.where("part IS NULL").select("doc_id", "mark", "sid", "other", "n")
    naming = Naming(_contested(sets), id_bits)
    if naming.contested:
        sets = sets.withColumn("sid", F.when(F.col("sid").isin(*naming.contested), F.col("other")).otherwise(F.col("sid")))
    sets = sets.drop("other")
    order = Order(_levels(scanned.where("part IS NOT NULL").select("part", "counts"), bits), bits)
    entries = _shared_prefixes(texts, order, naming, n, percent, long_list)
    labels = cut(_labels(entries, sets, texts, order, naming, n, percent), "jaccard-labels")
    return sets.join(labels, "sid", "left").select("doc_id", "mark", "n", F.coalesce("comp", "sid").alias("comp"))


def _segments(first: DataFrame, texts: DataFrame, order: Order, naming: Naming, n: int) -> DataFrame:
    """``sid, fragment, tokens``: the whole sets of ``first`` (``sid``, and ``id`` and ``mark`` of a row), cut where the order is cut.

    The row of a set is found by id and mark, as ids may be NULL or repeat with
    other texts; where marks meet by chance, texts of other sets fall away.
    """
    shared = texts.sparkSession.sparkContext.broadcast((order, order.pivots(FRAGMENTS)))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, pivots = shared.value
        for batch in slices(batches):
            out: tuple[list, list, list] = ([], [], [])
            for codes, sid in zip(shingle_sets(batch.column("text").to_pylist(), n), batch.column("sid").to_pylist(), strict=True):
                if not len(codes) or naming.of(codes) != sid:
                    continue
                fragment = np.searchsorted(pivots, order.keys(codes), side="right")
                by = np.argsort(fragment, kind="stable")
                found, cuts = np.unique(fragment[by], return_index=True)
                for f, at in zip(found.tolist(), np.split(by, cuts[1:]), strict=True):
                    for column, value in zip(out, (sid, f, codes[at].tobytes()), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.binary()), strict=True)], ["sid", "fragment", "tokens"]
            )

    same = F.col("doc_id").eqNullSafe(F.col("id")) & (mark_of("text") == F.col("mark"))
    found = texts.join(small_enough(first.select("sid", "id", "mark"), BROADCAST_ROWS), same).select("sid", "text")
    segments = cut(found.mapInArrow(spell, "sid long, fragment int, tokens binary"), "jaccard-segments")
    # Only repeated rows spell a set twice: seldom, so the tokens are not shuffled to find out.
    if segments.groupBy("sid", "fragment").count().where("count > 1").isEmpty():
        return segments
    return cut(segments.dropDuplicates(["sid", "fragment"]), "jaccard-segments")


def _labels(entries: DataFrame, sets: DataFrame, texts: DataFrame, order: Order, naming: Naming, n: int, percent: int) -> DataFrame:
    """``sid, comp`` of the sets that share a prefix n-gram with another."""
    # The list is one set's own prefix, so it grows with that text only.
    parts = F.collect_list(F.struct("bucket", "weight"))
    prefixes = cut(
        entries.groupBy("sid", "n").agg(F.sum("weight").alias("shared"), parts.alias("parts")), "jaccard-shared"
    )
    labels = cut(prefixes.select("sid", F.col("sid").alias("comp")), "jaccard-labels")
    found = small_enough(prefixes.select("sid"), BROADCAST_ROWS)
    first = sets.join(found, "sid", "left_semi").groupBy("sid").agg(F.min(F.struct("doc_id", "mark")).alias("row"), F.count("*").alias("copies"))
    first = cut(first.select("sid", F.col("row.doc_id").alias("id"), "row.mark", "copies"), "jaccard-first")
    if first.isEmpty():
        return labels
    segments = _segments(first, texts, order, naming, n)
    own = F.col("shared") / (F.col("n") - _rest("n", percent))
    known = prefixes.select("sid", "shared", F.floor(1000 * own).alias("central")).join(first.select("sid", "copies"), "sid")
    entries = cut(entries.select("bucket", "sid", "n", "at").join(small_enough(cut(known, "jaccard-known"), BROADCAST_ROWS), "sid"), "jaccard-entries")

    def merged(labels: DataFrame, pairs: DataFrame) -> DataFrame:
        pairs = cut(_worth_counting(pairs, prefixes, percent), "jaccard-pairs")
        if pairs.isEmpty():
            return labels
        links = cut(_links(pairs, segments), "jaccard-links")
        if links.isEmpty():
            return labels
        label = small_enough(labels, BROADCAST_ROWS)
        of_a = label.select(F.col("sid").alias("a"), F.col("comp").alias("ca"))
        of_b = label.select(F.col("sid").alias("b"), F.col("comp").alias("cb"))
        joined = links.join(of_a, "a").join(of_b, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
        roots = small_enough(components(joined), BROADCAST_ROWS).select(F.col("vertex").alias("comp"), "root")
        return cut(labels.join(roots, "comp", "left").select("sid", F.coalesce("root", "comp").alias("comp")), "jaccard-labels")

    def labelled(labels: DataFrame) -> DataFrame:
        return entries.join(small_enough(labels, BROADCAST_ROWS), "sid")

    for after in range(CENTRES):
        labels = merged(labels, _central(labelled(labels), percent, after))
        # Buckets of one component are done.
        rows = labelled(labels).groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("size"))
        open_ = cut(rows.where("low <> high").select("bucket", "size"), "jaccard-open")
        left = open_.agg(F.max("size").alias("largest"), F.sum("size").alias("n"), F.sum(F.col("size") * (F.col("size") - 1) / 2).alias("pairs")).first()
        if not left["largest"]:
            return labels
        entries = cut(entries.join(open_.select("bucket"), "bucket", "left_semi"), "jaccard-entries")
        if left["pairs"] <= PAIRS_AT_ONCE * left["n"]:
            apart = _by_level(labelled(labels).withColumn("level", F.lit(0)), 0, percent)
            # A few sets apart from a large component make a pair with each of its members: hubs spare most of these.
            if apart.count() <= left["n"]:
                return merged(labels, apart)
    level, top = F.lit(0), 0
    while FAN**top < left["largest"]:
        top += 1
        level = F.when(F.pmod(F.xxhash64("sid"), F.lit(FAN**top)) == 0, top).otherwise(level)
    entries = entries.withColumn("level", level)
    for j in range(top, -1, -1):
        labels = merged(labels, _by_level(labelled(labels), j, percent))
    return labels

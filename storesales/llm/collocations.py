"""Phrases of words that stand together more often than chance has it, found by dynamic itemset counting."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storesales.llm.common import cut, plan_bytes, slices
from storesales.llm.spans import byte_class, bytes_of, runs_of
from storesales.llm.words import mix, run_codes
from storesales.sources.shared import new_path, remove

#: What ends a piece, and what stands between words.
CUTS = byte_class(*b".,;:!?", range(0x0A, 0x0E))
WORD_BYTES = ~(CUTS | byte_class(0x20, 0x09))

#: Documents of no language.
NO_LANGUAGE = "und"

# Words of the longest phrases.
LONGEST = 3

# Shards that the documents are dealt to; a scan reads one.
SHARDS = 4

# Text that is counted at a time in a map task.
CHUNK_BYTES = 8 << 20

# Slots of the counters: one per this many bytes of input, within these bounds.
BYTES_PER_SLOT = 16
FEWEST_SLOT_BITS, MOST_SLOT_BITS = 16, 26
PART = 1 << 14

# In a table: the counter has not reached the threshold. Also the most that a counter holds.
NEVER = MOST_COUNTED = 255

# Rows of a batch that goes back to Spark.
BATCH_ROWS = 1 << 16

# Sub-groups in which a language's best phrases are found before they meet.
SALTS = 32

# What a scan gives: counts of phrases (of no words: all words of a language), or counters of slots.
SCANNED = "lang string, phrase string, words int, n long, part int, slots binary"


@dataclass
class Active:
    """By number of words, the scan at whose end the counter of a slot first reached the threshold.

    Phrases that share a slot share its counter, so some are counted that need not be; none is missed.
    """

    bits: int
    reached: list[np.ndarray]

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int32)


def word_hashes(words: pa.Array, langs: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word in its language; only for slots."""
    names = langs.dictionary_encode()
    own = np.array([xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) for x in names.dictionary.to_pylist()], np.uint64)
    return mix(run_codes(*bytes_of(words)) + own[names.indices.to_numpy(zero_copy_only=False)])


def joint_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Of a phrase, from those of its first words and of its last one."""
    return mix(first * np.uint64(0x9E3779B97F4A7C15) + second)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Slices put together to about ``CHUNK_BYTES``."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in slices(batches):
        held.append(batch)
        size += batch.nbytes
        if size >= CHUNK_BYTES:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _distinct(langs: np.ndarray, codes: np.ndarray, n_langs: int, n_codes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of language and word, and which of them each token is."""
    keys = langs * n_codes + codes
    if n_langs * n_codes > 1 << 26:
        found, places = np.unique(keys, return_inverse=True)
    else:
        seen = np.zeros(n_langs * n_codes, bool)
        seen[keys] = True
        found, places = np.flatnonzero(seen), (np.cumsum(seen) - 1)[keys]
    return found // n_codes, found % n_codes, places


def count_phrases(table: pa.Table, active: Active, scan: int, shards: int, counters: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Rows of ``SCANNED`` with the phrases that scan ``scan`` counts in the texts, ``lang, text``, of ``table``.

    A phrase is counted in the ``shards`` scans after the one in which its own slot and those of all its parts had
    reached the threshold. In the first scans, ``counters`` by number of words and slot are raised by all phrases, and
    all words are counted by language.
    """
    lang_column, text = (pa.concat_arrays(table.column(c).chunks) for c in ("lang", "text"))
    found = runs_of(text, WORD_BYTES, CUTS)
    if not len(found.strings):
        return
    coded, langs = found.strings.dictionary_encode(), lang_column.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    of_texts = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    own_langs, own_words, word = _distinct(np.repeat(of_texts, found.counts), codes, len(langs.dictionary), len(coded.dictionary))
    lang_names = langs.dictionary.cast(pa.string()).take(pa.array(own_langs))
    spelled = coded.dictionary.cast(pa.string()).take(pa.array(own_words))
    # Places of pairs within a piece, and of triples among these.
    at = np.flatnonzero(found.pieces[1:] == found.pieces[:-1])
    triple = np.flatnonzero(at[1:] == at[:-1] + 1)
    del codes, found

    def rows(n: np.ndarray, *parts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(n), BATCH_ROWS):
            some = [spelled.take(pa.array(w[i : i + BATCH_ROWS])) for w in parts]
            phrase = pc.binary_join_element_wise(*some, " ") if len(some) > 1 else some[0]
            yield _rows(lang_names.take(pa.array(parts[0][i : i + BATCH_ROWS])), phrase, len(parts), n[i : i + BATCH_ROWS])

    hashes = word_hashes(spelled, lang_names)
    word_slot = active.slots(hashes)
    joint = joint_hashes(hashes[word[at]], hashes[word[at + 1]])
    pair_slot = active.slots(joint)
    triple_slot = active.slots(joint_hashes(joint[triple], hashes[word[at[triple] + 2]]))
    del joint
    if counters is not None:
        _raise(counters[0], word_slot[word])
        _raise(counters[1], pair_slot)
        _raise(counters[2], triple_slot)
        names = langs.dictionary.cast(pa.string())
        totals = np.bincount(own_langs, np.bincount(word), len(names)).astype(np.int64)
        yield _rows(names, pa.array([""] * len(names), pa.string()), 0, totals)

    of_word = active.reached[0][word_slot]
    chosen = _now(of_word, scan, shards)
    yield from rows(np.bincount(word)[chosen], chosen)
    of_word = of_word[word]
    of_pair = np.maximum(np.maximum(of_word[at], of_word[at + 1]), active.reached[1][pair_slot])
    chosen = at[_now(of_pair, scan, shards)]
    keys, n = np.unique(word[chosen] << 32 | word[chosen + 1], return_counts=True)
    yield from rows(n, keys >> 32, keys & 0xFFFFFFFF)
    of_triple = np.maximum(np.maximum(of_pair[triple], of_pair[triple + 1]), active.reached[2][triple_slot])
    chosen = at[triple[_now(of_triple, scan, shards)]]
    heads, head = np.unique(word[chosen] << 32 | word[chosen + 1], return_inverse=True)
    keys, n = np.unique(head << 32 | word[chosen + 2], return_counts=True)
    head = heads[keys >> 32]
    yield from rows(n, head >> 32, head & 0xFFFFFFFF, keys & 0xFFFFFFFF)


def _rows(langs: pa.Array, phrases: pa.Array, words: int, n: np.ndarray) -> pa.RecordBatch:
    size = len(n)
    counted = [langs, phrases, pa.array(np.full(size, words, np.int32)), pa.array(n.astype(np.int64))]
    return pa.RecordBatch.from_arrays(
        [*counted, pa.nulls(size, pa.int32()), pa.nulls(size, pa.binary())], ["lang", "phrase", "words", "n", "part", "slots"]
    )


def _now(reached: np.ndarray, scan: int, shards: int) -> np.ndarray:
    """Which phrases, active from the end of scan ``reached`` on, are counted in this one."""
    return np.flatnonzero((reached != NEVER) & (reached < scan) & (scan <= reached.astype(np.int16) + shards))


def _raise(counters: np.ndarray, slots: np.ndarray) -> None:
    slots = np.sort(slots)
    firsts = np.flatnonzero(np.diff(slots, prepend=-1))
    found, n = slots[firsts], np.diff(firsts, append=len(slots))
    counters[found] = np.minimum(counters[found] + n, MOST_COUNTED)


def _parts(numbers: list[int], slots: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(slots, pa.binary())], ["part", "slots"])


def _part(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), np.uint8)


def _summed(parts: DataFrame) -> DataFrame:
    """``part, slots``: a row per part, with the sums of its bytes, ``MOST_COUNTED`` at most."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, packed in zip(batch.column("part").to_pylist(), batch.column("slots").to_pylist(), strict=True):
                sums = held.get(part, 0) + _part(packed).astype(np.int64)
                held[part] = np.minimum(sums, MOST_COUNTED).astype(np.uint8)
        yield _parts(list(held), [zlib.compress(x.tobytes(), 1) for x in held.values()])

    return parts.repartition("part").mapInArrow(add, "part int, slots binary")


def _enter(active: Active, counters: DataFrame, threshold: int, scan: int) -> None:
    """Enter the scan where counters have reached the threshold and nothing is entered yet.

    What reaches the driver is at most a bit per slot.
    """
    least = min(threshold, MOST_COUNTED)

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reached = [np.packbits(_part(p) >= least) for p in batch.column("slots").to_pylist()]
            kept = [i for i, r in enumerate(reached) if r.any()]
            numbers = batch.column("part").to_pylist()
            yield _parts([numbers[i] for i in kept], [zlib.compress(reached[i].tobytes(), 1) for i in kept])

    parted = [table.reshape(-1, PART) for table in active.reached]
    for row in counters.mapInArrow(bits, "part int, slots binary").toLocalIterator():
        table, part = divmod(row["part"], len(parted[0]))
        new = np.unpackbits(_part(row["slots"])).astype(bool) & (parted[table][part] == NEVER)
        parted[table][part][new] = scan


def frequent_phrases(
    docs: DataFrame, threshold: int = 10, shards: int = SHARDS, text_col: str = "text", lang_col: str = "lang"
) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, words, n`` of all phrases of up to ``LONGEST`` words with ``n >= threshold``, and ``lang, n`` of all words.

    Documents are dealt to ``shards`` shards, once. Scans read one shard after
    the other, twice round. Counters of a byte for hashed slots, summed over all
    documents, tell early what may be frequent: in the first round each scan
    raises them by all phrases of its shard. A phrase becomes active at the end
    of the scan in which the counters of its subphrases (all its words but the
    last, all but the first) and its own have reached the threshold. From the
    next scan on it is counted by its words, in as many scans as there are
    shards, so in every shard once; phrases of all lengths are counted in the
    same scans. By the end of the first round all that are frequent are active,
    so the second one completes every count.

    A scan's counts are summed up within each chunk of text, then all scans'
    in one shuffle. Counters are broadcast, in tables whose size follows the
    input up to 2**``MOST_SLOT_BITS`` bytes per length. Crowded slots make
    phrases active that are not frequent, which costs time only.
    """
    if not 1 <= shards < NEVER // 2:
        raise ValueError(f"shards must be from 1 to {NEVER // 2 - 1}")
    spark = docs.sparkSession
    wanted = max(1, min(plan_bytes(docs), 1 << 55) // BYTES_PER_SLOT)
    bits = int(math.log2(min(1 << MOST_SLOT_BITS, max(1 << FEWEST_SLOT_BITS, wanted))))
    texts = docs.select(F.coalesce(lang_col, F.lit(NO_LANGUAGE)).alias("lang"), F.coalesce(text_col, F.lit("")).alias("text"))
    texts = texts.withColumn("shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int"))
    place = new_path(spark, "phrases-shards")
    texts.write.option("compression", "zstd").partitionBy("shard").parquet(place)
    dealt = spark.read.schema(texts.schema).parquet(place)

    active = Active(bits, [np.full(1 << bits, NEVER, np.uint8) for _ in range(LONGEST)])
    scans, counters = [], None
    for scan in range(shards):
        scanned, parts, parts_place = _kept(_scan(dealt, active, scan, shards))
        rows = parts.select("part", "slots")
        counters = cut(_summed(rows if counters is None else rows.unionByName(counters)), "phrases-counters")
        _enter(active, counters, threshold, scan)
        remove(spark, parts_place)  # their sums are written
        scans.append(scanned)
    totals = cut(_all(scans).where("words = 0").groupBy("lang").agg(F.sum("n").alias("n")), "phrases-totals")
    scans += [_scan(dealt, active, scan, shards) for scan in range(shards, 2 * shards)]
    counted = _all(scans).where("words > 0").groupBy("lang", "phrase").agg(F.max("words").alias("words"), F.sum("n").alias("n"))
    phrases = cut(counted.where(F.col("n") >= threshold), "phrases-counted")
    remove(spark, place)
    return phrases, totals


def _kept(scanned: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    """What a scan gives, written once: counts of phrases, and counters of slots with the folder that only they are in."""
    spark = scanned.sparkSession
    path = new_path(spark, "phrases-scanned")
    marked = scanned.withColumn("counters", F.col("part").isNotNull())
    marked.write.option("compression", "zstd").partitionBy("counters").parquet(path)
    found = spark.read.schema(marked.schema).parquet(path)
    return found.where("NOT counters").drop("counters"), found.where("counters").drop("counters"), f"{path}/counters=true"


def _all(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for more in frames[1:]:
        result = result.unionByName(more)
    return result


def _scan(dealt: DataFrame, active: Active, scan: int, shards: int) -> DataFrame:
    shared = dealt.sparkSession.sparkContext.broadcast(active)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = None
        for table in _chunks(batches):
            if counters is None and scan < shards:
                counters = np.zeros((LONGEST, 1 << shared.value.bits), np.uint8)
            yield from count_phrases(table, shared.value, scan, shards, counters)
        if counters is None:
            return
        parted = counters.reshape(-1, PART)
        numbers = np.flatnonzero(parted.any(axis=1)).tolist()
        for at in range(0, len(numbers), 256):
            own = numbers[at : at + 256]
            nothing = [pa.nulls(len(own), t) for t in (pa.string(), pa.string(), pa.int32(), pa.int64())]
            some = _parts(own, [zlib.compress(parted[i].tobytes(), 1) for i in own])
            yield pa.RecordBatch.from_arrays([*nothing, *some.columns], ["lang", "phrase", "words", "n", "part", "slots"])

    return dealt.where(F.col("shard") == scan % shards).select("lang", "text").mapInArrow(count, SCANNED)


def _joined(*words: Column) -> Column:
    return F.concat_ws(" ", *words)


def collocations(
    docs: DataFrame,
    threshold: int = 10,
    most: int = 2000,
    inside_percent: int = 50,
    shards: int = SHARDS,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``most`` best phrases of two or three words.

    Texts in A-Z lower case are cut into pieces at ``.,;:!?`` and the control
    characters 10 to 13, pieces into words at blanks and tabs. Phrases with
    ``a >= threshold`` occurrences, overlapping ones too, are candidates. Cut in
    two, a phrase scores a million times a squared by the product of its parts'
    occurrences ``l`` and ``r``, rounded down; the lowest cut counts, the first
    of equal ones. A candidate inside a longer one with ``inside_percent``
    hundredths of its occurrences falls away. ``n`` are the words of the
    language. Ranks follow score, ``a`` and phrase.

    Counting is by ``frequent_phrases``; the rest are joins of frequent phrases
    by language and phrase. Nothing about single phrases reaches the driver.

    NULL texts are empty, documents without a language are of ``und``; both NULL
    and empty ids are allowed as ids are not read. Texts without words and
    languages without candidates give no rows, nor does an empty table. Repeated
    documents count each. Other columns are not read.
    """
    phrases, totals = frequent_phrases(docs, threshold, shards, text_col, lang_col)
    w = F.split("phrase", " ")
    candidates = phrases.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), w.alias("w"))
    one, two, three = (F.col("w").getItem(i) for i in range(3))

    def cut_after(k: int, left: Column, right: Column) -> Column:
        return F.struct(F.lit(k).alias("k"), left.alias("left"), right.alias("right"))

    cuts = F.when(F.col("words") == 2, F.array(cut_after(1, one, two))).otherwise(
        F.array(cut_after(1, one, _joined(two, three)), cut_after(2, _joined(one, two), three))
    )
    parts = candidates.select("lang", "phrase", "words", "a", F.explode(cuts).alias("cut")).select("*", "cut.*").drop("cut")
    of_left = phrases.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    of_right = phrases.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    exact = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")}
    scored = (
        parts.join(of_left, ["lang", "left"])
        .join(of_right, ["lang", "right"])
        .withColumns({f"{c}_exact": column for c, column in exact.items()})
        .withColumn("score", F.expr("(a_exact * a_exact * 1000000) div (l_exact * r_exact)"))
        .groupBy("lang", "phrase", "words", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    )
    inner = F.array_distinct(F.array(_joined(one, two), _joined(two, three)))
    longer = (
        candidates.where("words = 3")
        .select("lang", "a", F.explode(inner).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    kept = scored.join(longer, ["lang", "phrase"], "left").where(
        (F.col("words") == LONGEST) | F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("a"))
    )
    best_first = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*best_first)
    ranked = kept.select("lang", "phrase", "a", "best.l", "best.r", "best.score").withColumn("rank", F.row_number().over(salted))
    own = Window.partitionBy("lang").orderBy(*best_first)
    first = ranked.where(F.col("rank") <= most).withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= most)
    return first.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

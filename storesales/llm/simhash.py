"""Document fingerprints by SimHash, and search for fingerprints within a Hamming radius (native)."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storesales.llm.common import cut, plan_bytes, texts_of

# Words: letters of scripts that write no blanks one by one, other letters and digits in runs of at most 16.
_SINGLE = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
WORD = rf"[{_SINGLE}]|[\p{{L}}\p{{M}}\p{{N}}&&[^{_SINGLE}]]{{1,16}}"

# Bits of a fingerprint, kept as two longs.
BITS = 128

# Bits at this distance share a long while votes are counted: four counters of 16 bits, so that 32 sums hold 128 of them.
LANE = 16
LANES = 0x0001000100010001
# Votes that a counter takes before it is unpacked; the highest one must not reach the sign.
VOTES = (1 << 15) - 1

# Ranges of the documents' order: so many per shuffle partition, and one for so many bytes, up to a limit.
RANGES_PER_PARTITION, BYTES_PER_RANGE, MOST_RANGES = 8, 64 << 20, 100_000

# Sub-groups of the fingerprints of one table key, and fingerprints compared at a time.
SALTS, COMPARED = 64, 1024

RADIUS, BLOCKS = 3, 4

KEYS = ("bucket", "doc_id", "mark", "row")


def _words(text: str) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _votes(rows: DataFrame, keys: tuple[str, ...], text: str) -> DataFrame:
    """``keys, votes, s0 .. s31``: packed counts of the set bits of all terms of a text, per ``VOTES`` terms of it."""
    words = rows.select(*keys, _words(text).alias("w")).withColumn("n", F.size("w"))
    runs = F.arrays_zip("w", F.slice("w", 2, F.greatest("n", F.lit(1))), F.slice("w", 3, F.greatest("n", F.lit(1))))
    terms = words.select(*keys, F.posexplode_outer(runs).alias("at", "term"))
    first = F.when(F.col("term").isNotNull(), F.xxhash64(*(F.col("term").getField(str(i)) for i in ("w", "1", "2"))))
    hashed = terms.select(*keys, F.floor(F.col("at") / VOTES).alias("part"), first.alias("h0"))
    both = hashed.withColumn("h1", F.when(F.col("h0").isNotNull(), F.xxhash64("h0", F.lit(1))))
    sums = [
        F.sum(F.shiftrightunsigned(f"h{i // LANE}", i % LANE).bitwiseAND(F.lit(LANES))).alias(f"s{i}") for i in range(BITS // 64 * LANE)
    ]
    return both.groupBy(*keys, "part").agg(F.count("h0").alias("votes"), *sums)


def _prints(rows: DataFrame, keys: tuple[str, ...], text: str, names: tuple[str, str]) -> DataFrame:
    """``keys`` and the two halves of the fingerprint of ``text``: a bit is set if more than half of the votes set it."""
    low = F.lit(0x0000FFFF0000FFFF)
    packed = [f"s{i}" for i in range(BITS // 64 * LANE)]
    wider = [F.sum(F.shiftrightunsigned(s, shift).bitwiseAND(low)).alias(f"{s}_{shift}") for s in packed for shift in (0, LANE)]
    summed = _votes(rows, keys, text).groupBy(*keys).agg(F.sum("votes").alias("votes"), *wider)

    def half(h: int) -> Column:
        bits = []
        for i in range(LANE):
            for shift in (0, LANE):
                for high in (0, 32):
                    count = F.shiftrightunsigned(f"s{h * LANE + i}_{shift}", high).bitwiseAND(F.lit(0xFFFFFFFF))
                    bit = 1 << (i + shift + high)
                    bits.append(F.when(count * 2 > F.col("votes"), F.lit(bit - (1 << 64) if bit >> 63 else bit)).otherwise(F.lit(0)))
        return reduce(Column.bitwiseOR, bits)

    return summed.select(*keys, half(0).alias(names[0]), half(1).alias(names[1]))


def _spelled(high: str, low: str) -> Column:
    return F.lower(F.concat(*(F.lpad(F.hex(x), 16, "0") for x in (high, low))))


def _distance(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    return F.bit_count(a[0].bitwiseXOR(b[0])) + F.bit_count(a[1].bitwiseXOR(b[1]))


def likeness(distance: Column) -> Column:
    """The cosine of term vectors that so many differing bits stand for: 1 for none, 0 from half of the bits on."""
    return F.greatest(F.lit(0.0), F.round(F.cos(F.pi() * distance / BITS), 12))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint``: 32 hexadecimal digits per row of ``docs``.

    Terms are runs of three neighbouring words (shorter at the end of a text),
    in lower case; each votes with its hash, as often as it occurs, for or
    against every bit. Votes are summed up in the map tasks, four to a long.
    NULL and empty texts, and those without a word, have no bit set.
    """
    rows = texts_of(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    return _prints(rows, ("row", "doc_id"), "text", ("high", "low")).select("doc_id", _spelled("high", "low").alias("fingerprint"))


def _ranges(rows: DataFrame, wanted: int) -> tuple[Column, DataFrame]:
    """Which range of the order by ``doc_id, mark, row`` a row lies in, and by range the key of the last row before it.

    Only keys are sorted, and a pair of them per range reaches the driver. The
    last row goes before the first one.
    """
    spark = rows.sparkSession
    order = F.struct("doc_id", "mark", "row")
    ends = (
        rows.select("doc_id", "mark", "row")
        .repartitionByRange(wanted, "doc_id", "mark", "row")
        .groupBy(F.spark_partition_id().alias("part"))
        .agg(F.min(order).alias("first"), F.max(order).alias("last"))
    )
    listed = ends.agg(F.sort_array(F.collect_list(F.struct("part", "first", "last"))).alias("e"))
    found = listed.select(F.to_json("e.first").alias("first"), F.to_json("e.last").alias("last")).first()
    kind = f"array<struct<doc_id: {rows.schema['doc_id'].dataType.simpleString()}, mark: bigint, row: bigint>>"
    firsts = F.from_json(F.lit(found["first"]), kind)
    steps = F.array(*(F.lit(1 << b) for b in range(MOST_RANGES.bit_length(), -1, -1)))
    # The last range whose first key is not above the row's, by halving.
    bucket = F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(firsts, at + step) <= order, at + step).otherwise(at)
    )
    lasts = spark.range(1).select(F.posexplode(F.from_json(F.lit(found["last"]), kind)).alias("at", "key"))
    size = spark.range(1).select(F.size(F.from_json(F.lit(found["last"]), kind)).alias("n")).first()["n"]
    before = lasts.select(F.pmod(F.col("at") + 1, F.lit(max(size, 1))).cast("int").alias("of_bucket"), "key.doc_id", "key.mark")
    return bucket, before


def _with_next(rows: DataFrame, before: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``rows`` with ``next_`` columns: those of the next lower row, for the lowest one of the highest.

    Within a range that is a window; across ranges a row per range is looked up by its key.
    """
    own = Window.partitionBy("bucket").orderBy("doc_id", "mark", "row")
    value = F.struct(*columns)
    found = rows.select("doc_id", "mark", value.alias("edge")).join(
        F.broadcast(before.withColumnsRenamed({"doc_id": "of_id", "mark": "of_mark"})),
        F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("mark") == F.col("of_mark")),
    )
    edges = found.groupBy(F.col("of_bucket").alias("bucket")).agg(F.max("edge").alias("edge"))
    lagged = rows.withColumn("lagged", F.lag(value).over(own)).join(edges, "bucket", "left")
    return lagged.withColumn("next", F.coalesce("lagged", "edge")).select(*rows.columns, *(F.col(f"next.{c}").alias(f"next_{c}") for c in columns))


def fingerprint_report(
    docs: DataFrame, queries: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, blocks: int = BLOCKS
) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_near``, a row per document.

    The edited text has the last third of the code points (rounded down)
    replaced by the first ones, as many or all, of the next document by falling
    id, after the last one of the first. ``near_edited`` and ``near_next`` are
    the ``likeness`` of a document's fingerprint to the edited text's and to the
    next document's. ``n_near`` counts the other documents with a fingerprint
    within ``radius`` bits, for the rows of ``queries`` (those whose ``doc_id``
    is there), else it is NULL.

    Documents are put into ranges of their order: keys are range-partitioned
    alone, then texts move once, to their range, where the next one is the row
    below. Equal ids are ordered by a hash of their texts, NULL ids are lowest.
    NULL texts are empty. Repeated rows are next to each other and judged each.
    An empty table gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = texts_of(docs, id_col, text_col).withColumn("mark", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(MOST_RANGES, max(RANGES_PER_PARTITION * partitions, min(plan_bytes(docs), 1 << 55) // BYTES_PER_RANGE))
    bucket, before = _ranges(rows, wanted)
    placed = rows.withColumn("bucket", bucket)
    n = F.length("text")
    taken = F.floor(n / 3).cast("int")
    pairs = _with_next(placed, before, ("text",)).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), n - taken), F.substring("next_text", F.lit(1), taken))
    )
    edited = pairs.select(*KEYS, n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), F.array("text", "edited").alias("both"))
    versions = edited.select(*KEYS, "n_chars", "edited_sha256", F.posexplode("both").alias("version", "text"))
    printed = _prints(versions, (*KEYS, "n_chars", "edited_sha256", "version"), "text", ("high", "low"))
    version = lambda v, c: F.max(F.when(F.col("version") == v, F.col(c)))
    prints = cut(
        printed.groupBy(*KEYS, "n_chars", "edited_sha256").agg(
            version(0, "high").alias("high"), version(0, "low").alias("low"),
            version(1, "high").alias("edited_high"), version(1, "low").alias("edited_low"),
        ),
        "simhash-prints",
    )
    own, changed, following = ((F.col(f"{x}high"), F.col(f"{x}low")) for x in ("", "edited_", "next_"))
    report = _with_next(prints, before, ("high", "low")).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        _spelled("high", "low").alias("fingerprint"),
        _spelled("edited_high", "edited_low").alias("edited_fingerprint"),
        likeness(_distance(own, changed)).alias("near_edited"),
        likeness(_distance(own, following)).alias("near_next"),
        "high",
        "low",
    )
    if queries is None:
        return report.drop("high", "low")
    wanted_ids = queries.select(F.col(id_col).alias("doc_id")).distinct()
    asked = prints.join(wanted_ids, "doc_id", "left_semi").select("doc_id", "high", "low").distinct()
    near = near_counts(prints.select("high", "low"), asked.select("high", "low"), radius, blocks)
    counted = asked.join(near, ["high", "low"]).select("doc_id", "high", "low", (F.col("n_near") - 1).alias("n_near"))
    return report.join(counted, ["doc_id", "high", "low"], "left").drop("high", "low")


def _masks(blocks: int) -> list[tuple[int, int]]:
    """Of each block, its bits in the high and the low half."""
    size = BITS // blocks
    out = []
    for b in range(blocks):
        mask = ((1 << size) - 1) << (size * b)
        halves = mask >> 64, mask & ((1 << 64) - 1)
        out.append(tuple(h - (1 << 64) if h >> 63 else h for h in halves))
    return out


def near_counts(prints: DataFrame, queries: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``high, low, n_near`` of each distinct query: the rows of ``prints`` with at most ``radius`` different bits, its own ones too.

    A fingerprint is cut into ``blocks`` blocks. Of two within the radius at
    least ``blocks - radius`` agree, so there is a table per choice of as many
    blocks, keyed by these, and two near fingerprints meet in one. A pair counts
    in the first table that has it. Equal fingerprints count as one with a
    number. Those of one key are compared in bounded arrays, dealt to salted
    sub-groups, so a key that many share is spread over tasks, and no row per
    pair is made.
    """
    kept = blocks - radius
    if not 0 < kept <= blocks or BITS % blocks:
        raise ValueError("there must be more blocks than the radius, and they must divide the bits")
    masks = _masks(blocks)
    tables = list(combinations(range(blocks), kept))

    def keyed(rows: DataFrame) -> DataFrame:
        keys = []
        for t, chosen in enumerate(tables):
            high, low = (reduce(lambda x, y: x | y, (masks[b][h] for b in chosen)) for h in (0, 1))
            key = F.xxhash64(F.lit(t), F.col("high").bitwiseAND(F.lit(high)), F.col("low").bitwiseAND(F.lit(low)))
            keys.append(F.struct(F.lit(t).alias("table"), key.alias("key")))
        return rows.select("*", F.explode(F.array(*keys)).alias("k")).select("k.table", "k.key", *rows.columns)

    def arrays(rows: DataFrame, name: str, *columns: str) -> DataFrame:
        salt = F.pmod(F.xxhash64("high", "low"), F.lit(SALTS))
        place = F.row_number().over(Window.partitionBy("table", "key", "salt").orderBy("high", "low"))
        numbered = keyed(rows).withColumn("salt", salt).withColumn("part", F.floor((place - 1) / COMPARED))
        return numbered.groupBy("table", "key", "salt", "part").agg(F.collect_list(F.struct(*columns)).alias(name)).drop("salt", "part")

    distinct = prints.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n"))
    asked = queries.select("high", "low").distinct()
    met = arrays(asked, "asked", "high", "low").join(arrays(distinct, "held", "high", "low", "n"), ["table", "key"])

    def near(q: Column, p: Column) -> Column:
        high, low = q["high"].bitwiseXOR(p["high"]), q["low"].bitwiseXOR(p["low"])
        first = F.lit(True)
        for t, chosen in enumerate(tables):
            earlier = [b for b in range(chosen[-1]) if b not in chosen]
            differ = [
                (high.bitwiseAND(F.lit(masks[b][0])).bitwiseOR(low.bitwiseAND(F.lit(masks[b][1]))) != 0) for b in earlier
            ]
            if differ:
                first = first & ((F.col("table") != t) | reduce(Column.__and__, differ))
        return (F.bit_count(high) + F.bit_count(low) <= radius) & first

    def total(q: Column) -> Column:
        return F.aggregate(F.filter("held", lambda p: near(q, p)), F.lit(0).cast("long"), lambda s, p: s + p["n"])

    sums = met.select(F.explode(F.transform("asked", lambda q: F.struct(q["high"].alias("high"), q["low"].alias("low"), total(q).alias("n")))).alias("s"))
    return sums.groupBy("s.high", "s.low").agg(F.sum("s.n").alias("n_near"))

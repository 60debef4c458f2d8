"""Language identification of texts that may mix languages."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storesales.llm.common import carried, id_crc32, slices, texts_of, type_of

# Hashed byte trigrams; the model has this many numbers per language.
SLOT_BITS = 16
SLOTS = 1 << SLOT_BITS

# Added to every count, so that unseen trigrams are unlikely but possible.
SMOOTHING = 0.5

# Log-likelihood that a further language must gain, per log of the number of trigrams.
# Neighbouring trigrams overlap, so it is higher than for independent draws.
PENALTY = 3.0

STEPS = 12

# Neighbouring trigrams share letters: so many are one draw.
OVERLAP = 3

# Numbers in one array of an EM step.
BLOCK = 4 << 20

# Languages that a map task counts at a time, at half a megabyte each.
HELD_LANGUAGES = 64

UNKNOWN = "und"

# Bytes that count: letters in lower case, parts of longer characters; everything else is a blank.
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def _codes(first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
    """Three bytes each in one number; those with one letter or none are left out."""
    letters = sum((x != 0x20).astype(np.int8) for x in (first, second, third))
    return (first << 16 | second << 8 | third)[letters >= 2]


def _slots(codes: np.ndarray) -> np.ndarray:
    return (codes * np.uint32(0x9E3779B1) >> np.uint32(32 - SLOT_BITS)).astype(np.uint16)


def _codes_of(text: str) -> np.ndarray:
    data = _FOLD[np.frombuffer(f" {text} ".lower().encode("utf-8", "surrogatepass"), np.uint8)].astype(np.uint32)
    return _codes(data[:-2], data[1:-1], data[2:]) if len(data) >= 3 else np.empty(0, np.uint32)


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct trigram slots of a whole text and their counts; those of one letter or none are left out."""
    return _counted(_codes_of(text))


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(codes):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    slots = np.sort(_slots(codes))
    firsts = np.flatnonzero(np.diff(slots, prepend=-1))
    return slots[firsts].astype(np.int64), np.diff(firsts, append=len(slots))


def learn(texts: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Languages, the probability of each trigram slot (row) in each of them, their trigrams, and ``letters_at_random``.

    Map tasks count ``lang, text`` per language, trigrams by slot and their
    middle bytes behind them, of a bounded number of languages at a time; the
    sums that reach the driver are at most ``SLOTS + 256`` per language, however
    many texts there are. The model takes half a megabyte per language, on the
    driver and in every worker, so it is for hundreds of languages.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}

        def hand_on() -> Iterator[pa.RecordBatch]:
            while totals:
                lang, total = totals.popitem()
                seen = np.flatnonzero(total)
                yield pa.RecordBatch.from_pydict(
                    {"lang": pa.array([lang] * len(seen), pa.string()), "slot": pa.array(seen), "n": pa.array(total[seen])}
                )

        for batch in slices(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if lang not in totals and len(totals) >= HELD_LANGUAGES:
                    yield from hand_on()
                codes = _codes_of(text)
                slots, counts = _counted(codes)
                total = totals.setdefault(lang, np.zeros(SLOTS + 256, np.int64))
                total[slots] += counts
                total[SLOTS:] += np.bincount(codes >> 8 & 0xFF, minlength=256)
        yield from hand_on()

    counted = texts.mapInArrow(count, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    found = counted.toArrow()
    names = sorted(found.column("lang").unique().to_pylist())
    table = np.zeros((SLOTS + 256, len(names)))
    place = {name: i for i, name in enumerate(names)}
    columns = np.array([place[x] for x in found.column("lang").to_pylist()], np.int64)
    table[found.column("slot").to_numpy(), columns] += found.column("n").to_numpy()
    seen, table = table, table[:SLOTS] + SMOOTHING
    return names, table / table.sum(axis=0), seen[:SLOTS].sum(axis=0), letters_at_random(seen[SLOTS:].sum(axis=1))


def letters_at_random(counts: np.ndarray) -> np.ndarray:
    """The probability of each trigram slot where bytes are drawn each on its own, as often as they were counted."""
    found = np.flatnonzero(counts).astype(np.uint32)
    table = np.zeros(SLOTS)
    second, third = (x.ravel() for x in np.meshgrid(found, found))
    for byte in found:
        codes = _codes(np.full_like(second, byte), second, third)
        likely = counts[codes >> 16] * counts[codes >> 8 & 0xFF] * counts[codes & 0xFF]
        table += np.bincount(_slots(codes), likely, SLOTS)
    return table / (table.sum() or 1.0)


def _em(
    likely: np.ndarray, counts: np.ndarray, starts: np.ndarray, shares: np.ndarray, steps: int
) -> tuple[np.ndarray, np.ndarray]:
    """Mixture shares of each text (rows of ``shares``) after some EM steps, and their log-likelihood."""
    sizes = np.diff(starts, append=len(counts))
    totals = np.add.reduceat(counts, starts)[:, None]
    for step in range(steps + 1):
        joint = likely * np.repeat(shares, sizes, axis=0)
        whole = joint.sum(axis=1)
        if step == steps:
            break
        shares = np.add.reduceat(joint * (counts / whole)[:, None], starts, axis=0) / totals
    return shares, np.add.reduceat(counts * np.log(whole), starts)


def mixture(model: np.ndarray, grams: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Shares of the languages in each text, zero for those outside its set; every text needs a trigram.

    EM over all languages estimates the shares. While leaving out the language
    of the smallest share costs less log-likelihood than ``PENALTY`` times the
    log of the number of trigrams, it is left out and the shares are estimated
    again among the rest.
    """
    slots = np.concatenate([s for s, _ in grams])
    counts = np.concatenate([c for _, c in grams]).astype(np.float64)
    sizes = np.array([len(s) for s, _ in grams])
    starts = np.cumsum(sizes) - sizes
    likely = model[slots]
    languages = model.shape[1]
    shares, fit = _em(likely, counts, starts, np.full((len(grams), languages), 1.0 / languages), STEPS)
    price = PENALTY * np.log(np.add.reduceat(counts, starts) + 1)
    # Most texts are in one language: where it does as well as all together, no set between can do better.
    single = np.add.reduceat(counts[:, None] * np.log(likely), starts, axis=0)
    best = single.argmax(axis=1)
    alone = single.max(axis=1) >= fit - price
    result = np.where(alone[:, None], np.eye(languages)[best], shares)
    open_ = np.flatnonzero(~alone)
    while len(open_):
        inside = result[open_] > 0
        smallest = np.where(inside, result[open_], np.inf).argmin(axis=1)
        trial = result[open_].copy()
        trial[np.arange(len(open_)), smallest] = 0
        going = inside.sum(axis=1) > 1
        open_, trial = open_[going], trial[going]
        if not len(open_):
            break
        trial /= trial.sum(axis=1, keepdims=True)
        rows = np.concatenate([np.arange(starts[i], starts[i] + sizes[i]) for i in open_])
        trial, trial_fit = _em(likely[rows], counts[rows], np.cumsum(sizes[open_]) - sizes[open_], trial, STEPS)
        better = trial_fit >= fit[open_] - price[open_]
        result[open_[better]], fit[open_[better]] = trial[better], trial_fit[better]
        open_ = open_[better]
    return result


def against_chance(
    model: np.ndarray, learned: np.ndarray, at_random: np.ndarray, grams: list[tuple[np.ndarray, np.ndarray]], shares: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text, the share that none of its languages explains, and the mean and standard error of their gain over chance.

    The share is by EM over three sources: the text's ``mixture``, letters at
    random, and trigrams at random. The gain is the log of a trigram's
    likelihood in the mixture over that in the two others with even shares; its
    error is from how it varies within the text, with ``OVERLAP`` trigrams
    counted as one draw. Letters at random are smoothed like the languages, as
    if learned from as many trigrams (``learned``), so a language of few texts
    is not beaten for being sparse. How many languages there are does not matter.
    """
    slots = np.concatenate([s for s, _ in grams])
    counts = np.concatenate([c for _, c in grams]).astype(np.float64)
    sizes = np.array([len(s) for s, _ in grams])
    starts = np.cumsum(sizes) - sizes
    spoken = (model[slots] * np.repeat(shares, sizes, axis=0)).sum(axis=1)
    whole = learned + SMOOTHING * SLOTS
    drawn = np.repeat(shares @ (learned / whole), sizes) * at_random[slots] + np.repeat(shares @ (SMOOTHING / whole), sizes)
    likely = np.column_stack([spoken, drawn, np.full(len(slots), 1.0 / SLOTS)])
    found, _ = _em(likely, counts, starts, np.full((len(grams), 3), 1.0 / 3), STEPS)
    gains = np.log(spoken) - np.log((likely[:, 1] + likely[:, 2]) / 2)
    totals = np.add.reduceat(counts, starts)
    mean = np.add.reduceat(counts * gains, starts) / totals
    spread = np.add.reduceat(counts * (gains - np.repeat(mean, sizes)) ** 2, starts) / totals
    # Of a draw or two the spread says nothing; then it is taken to be as large as the gain.
    spread = np.where(totals <= OVERLAP, np.maximum(spread, mean**2), spread)
    return 1.0 - found[:, 0], mean, np.sqrt(spread * OVERLAP / totals)


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = 4,
    held_out: int = 2,
    carry: bool = False,
    background: bool = False,
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, langs, shares`` of every whole text.

    Learns from the documents with a language whose CRC-32 of the id modulo
    ``folds`` is not ``held_out``. A text is a draw of trigrams from a mixture
    of the learned languages; ``langs`` is the selected set by falling share,
    ``lang_pred`` its first and ``score`` that one's share (of equal shares the
    first by name).

    NULL texts and those without a letter are ``und`` with score 0 and no set,
    and so is everything if there is nothing to learn from. NULL ids belong to
    no held-out fold. Repeated rows are judged, and learned from, each; an empty
    table gives an empty result. Other columns are only read with ``carry``,
    which returns every document whole in a struct ``row``.

    ``background`` adds the number of a text's ``trigrams``, the share
    ``outside`` of it that is rather letters at random than its languages, and
    the mean ``gain`` of these over chance with its standard ``error``; 0 where
    there is no trigram or nothing to learn from.
    """
    fold = F.coalesce(id_crc32(F.col(id_col)) % folds, F.lit(-1))
    labelled = docs.where(F.col(lang_col).isNotNull() & (fold != held_out))
    names, *tables = learn(
        texts_of(labelled, lang_col, text_col).select(F.col("doc_id").cast("string").alias("lang"), "text")
    )
    shared = docs.sparkSession.sparkContext.broadcast((names, *tables))
    texts = texts_of(docs, id_col, text_col, carry)
    schema = f"doc_id {type_of(texts, 'doc_id')}, lang_pred string, score double, langs array<string>, shares array<double>"
    if background:
        schema += ", trigrams long, outside double, gain double, error double"
    if carry:
        schema += f", row {type_of(texts, 'row')}"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, model, learned, at_random = shared.value
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            found: list[np.ndarray | None] = [None] * len(texts)
            sizes, beyond = [0] * len(texts), np.zeros((3, len(texts)))
            block: list[tuple[int, tuple]] = []

            def flush(block=block, found=found, beyond=beyond):
                if not block:
                    return
                grams = [g for _, g in block]
                shares = mixture(model, grams)
                places = [i for i, _ in block]
                for i, row in zip(places, shares, strict=True):
                    found[i] = row
                if background:
                    beyond[:, places] = against_chance(model, learned, at_random, grams, shares)
                block.clear()

            held = 0
            for i, text in enumerate(texts):
                if not names or not any(map(str.isalpha, text)):
                    continue
                grams = trigrams(text)
                if not len(grams[0]):  # a single letter: nothing to tell languages apart
                    found[i] = np.full(len(names), 1.0 / len(names))
                    continue
                sizes[i] = int(grams[1].sum())
                held += len(grams[0]) * len(names)
                block.append((i, grams))
                if held > BLOCK:
                    flush()
                    held = 0
            flush()
            sets = [[] if s is None else [j for j in np.argsort(-s, kind="stable") if s[j] > 0] for s in found]
            more, more_names = carried(batch)
            if background:
                more = [pa.array(sizes, pa.int64()), *map(pa.array, beyond), *more]
                more_names = ["trigrams", "outside", "gain", "error", *more_names]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([names[s[0]] if s else UNKNOWN for s in sets], pa.string()),
                    pa.array([min(1.0, float(f[s[0]])) if s else 0.0 for f, s in zip(found, sets, strict=True)], pa.float64()),
                    pa.array([[names[j] for j in s] for s in sets], pa.list_(pa.string())),
                    pa.array([[float(f[j]) for j in s] for f, s in zip(found, sets, strict=True)], pa.list_(pa.float64())),
                    *more,
                ],
                ["doc_id", "lang_pred", "score", "langs", "shares", *more_names],
            )

    judged = texts.mapInArrow(judge, schema)
    fold = F.coalesce(id_crc32(F.col("doc_id")) % folds, F.lit(-1))
    return judged.withColumn("held_out", fold == held_out).select("doc_id", "held_out", *judged.columns[1:])

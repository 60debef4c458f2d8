"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storesales.llm.common import carried, id_crc32, slices, texts_of, type_of
from storesales.llm.words import mix, run_hashes, words_of

# The bounded sample of labelled documents to train on, and the longest of them in lines.
TRAINING_DOCUMENTS = 4_000
TRAINING_LINES = 2_000

TRAINING_STEPS = 150
RATE, DECAY = 0.1, 1e-3

_CLASSES = np.zeros((6, 256), np.uint8)
_CLASSES[0, ord("A") : ord("Z") + 1] = 1
_CLASSES[1, ord("0") : ord("9") + 1] = 1
_CLASSES[2, [ord(c) for c in "#$%&*<>{}[]=+@^~\\/_"]] = 1
_CLASSES[3, ord("|")] = 1
_CLASSES[4, ord("!")] = 1
_CLASSES[5, [ord(c) for c in ".,;:?'\"()-"]] = 1


@dataclass
class Lines:
    """The lines with words of some texts."""

    features: np.ndarray  # a row per line: its own features
    lengths: np.ndarray  # bytes
    bounds: np.ndarray  # number of each text's first line, and the number of lines


def _repeated(codes: np.ndarray) -> np.ndarray:
    """1 where the code occurred before."""
    firsts = np.unique(codes, return_index=True)[1]
    again = np.ones(len(codes), np.int64)
    again[firsts] = 0
    return again


def lines_of(texts: list[str]) -> Lines:
    words = words_of(texts)
    ends = np.flatnonzero(words.data == 0x0A)
    line_of_word = np.searchsorted(ends, words.starts)
    with_words = np.unique(line_of_word)
    n = len(with_words)
    text_of_line = np.searchsorted(words.text_starts, ends[with_words], side="right") - 1
    bounds = np.searchsorted(text_of_line, np.arange(len(texts) + 1))
    if not n:
        return Lines(np.empty((0, 17)), np.empty(0), bounds)
    every = np.concatenate([[0], ends[:-1] + 1])
    lengths = (ends - every)[with_words].astype(float)
    shares = np.stack([np.add.reduceat(c[words.data], every, dtype=np.int64)[with_words] / lengths for c in _CLASSES])
    first_words = np.searchsorted(line_of_word, with_words)
    counts = np.diff(first_words, append=len(words.starts)).astype(float)

    def per_line(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, first_words) / counts

    text_of_word = np.searchsorted(words.bounds, np.arange(len(words.starts)), side="right") - 1
    same = np.zeros(len(words.starts))
    same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (line_of_word[1:] == line_of_word[:-1])
    runs = np.zeros(len(words.starts))
    if len(words.starts) >= 3:
        codes = mix(run_hashes(words.hashes, 3) ^ text_of_word[:-2].astype(np.uint64))
        runs[:-2] = _repeated(codes) * (text_of_word[2:] == text_of_word[:-2])
    line_codes = np.add.reduceat(mix(words.hashes ^ line_place(first_words, len(words.starts))), first_words)
    again = _repeated(mix(line_codes ^ text_of_line.astype(np.uint64)))
    first = np.zeros(n)
    first[bounds[:-1][np.diff(bounds) > 0]] = 1
    last = np.zeros(n)
    last[bounds[1:][np.diff(bounds) > 0] - 1] = 1
    letters = 1 - per_line((words.lengths == 1).astype(float))
    stutter, repeats = per_line(same), per_line(runs)
    features = np.stack(
        [
            np.log1p(counts),
            np.log1p(lengths / counts),
            *shares,
            *np.sqrt(shares[[0, 2, 3, 4]]),
            letters,
            stutter,
            np.sqrt(stutter),
            repeats,
            again + first * 0.5 + last * 0.25,
        ],
        axis=1,
    )
    return Lines(features, lengths, bounds)


def line_place(first_words: np.ndarray, n: int) -> np.ndarray:
    """Place of each word in its line."""
    sizes = np.diff(first_words, append=n)
    return (np.arange(n) - np.repeat(first_words, sizes)).astype(np.uint64)


def with_neighbours(lines: Lines) -> np.ndarray:
    """Each line's features beside those of the line before and after it in its text, and a constant."""
    f = lines.features
    before, after = np.zeros_like(f), np.zeros_like(f)
    before[1:], after[:-1] = f[:-1], f[1:]
    sizes = np.diff(lines.bounds)
    filled = sizes > 0
    before[lines.bounds[:-1][filled]] = 0
    after[lines.bounds[1:][filled] - 1] = 0
    return np.concatenate([f, before, after, np.ones((len(f), 1))], axis=1)


@dataclass
class Crf:
    """Labels 0 (bad) and 1 (good): weights of a line's features for 1, and scores of neighbouring labels."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    steps: np.ndarray  # 2 x 2

    def logits(self, lines: Lines) -> np.ndarray:
        x = with_neighbours(lines)
        x[:, :-1] = (x[:, :-1] - self.mean) / self.spread
        return x @ self.weights


def forward_backward(logits: np.ndarray, bounds: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of both labels per line, and of label pairs per line and its successor in the text (else zeros).

    All texts advance together, one line at a time, so the Python loop is as
    long as the longest text has lines.
    """
    good = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
    local = np.stack([1 - good, good], axis=1)
    moves = np.exp(steps)
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = bounds[:-1][order], sizes[order]
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest + 1), side="left")  # texts with more than t lines
    ahead, back = np.empty_like(local), np.ones_like(local)
    for t in range(longest):
        at = starts[: active[t]] + t
        value = local[at] if t == 0 else (ahead[at - 1] @ moves) * local[at]
        ahead[at] = value / value.sum(axis=1, keepdims=True)
    for t in range(longest - 2, -1, -1):
        at = starts[: active[t + 1]] + t
        value = (back[at + 1] * local[at + 1]) @ moves.T
        back[at] = value / value.sum(axis=1, keepdims=True)
    single = ahead * back
    single /= single.sum(axis=1, keepdims=True)
    pairs = np.zeros((len(local), 2, 2))
    pairs[:-1] = ahead[:-1, :, None] * moves * (local * back)[1:, None, :]
    filled = bounds[1:][np.diff(bounds) > 0] - 1
    pairs[filled] = 0
    total = pairs.sum(axis=(1, 2), keepdims=True)
    return single, np.divide(pairs, total, out=pairs, where=total > 0)


def train(lines: Lines, labels: np.ndarray) -> Crf:
    """Fit by gradient steps on the likelihood of line labels; every line has its document's label."""
    x = with_neighbours(lines)
    mean, spread = x[:, :-1].mean(axis=0), x[:, :-1].std(axis=0) + 1e-6
    x[:, :-1] = (x[:, :-1] - mean) / spread
    sizes = np.diff(lines.bounds)
    y = np.repeat(labels, sizes).astype(float)
    follows = np.ones(len(y), bool)
    follows[lines.bounds[1:][sizes > 0] - 1] = False
    seen = np.array([[(follows & (y == 0)).sum(), 0], [0, (follows & (y == 1)).sum()]], float)
    theta = np.zeros(x.shape[1] + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, TRAINING_STEPS + 1):
        single, pairs = forward_backward(x @ theta[:-4], lines.bounds, theta[-4:].reshape(2, 2))
        gradient = np.concatenate([x.T @ (y - single[:, 1]), (seen - pairs.sum(axis=0)).ravel()]) / len(y) - DECAY * theta
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta += RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Crf(mean, spread, theta[:-4], theta[-4:].reshape(2, 2))


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, folds: int) -> tuple[Lines, np.ndarray]:
    """Lines and labels of at most ``TRAINING_DOCUMENTS`` labelled documents outside the held-out fold."""
    chosen = (
        labels.select(F.col("doc_id").alias("__id"), F.col("quality").cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & (id_crc32(F.col("__id")) % folds != 0))
        .orderBy(F.xxhash64("__id"), "__id", "label")
        .limit(TRAINING_DOCUMENTS)
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lines = lines_of(batch.column("text").to_pylist())
            rows = [
                (at, label, lines.features[a:b].tobytes(), lines.lengths[a:b].tobytes())
                for at, label, a, b in zip(batch.column("at").to_pylist(), batch.column("label").to_pylist(), lines.bounds, lines.bounds[1:], strict=False)
                if 0 < b - a <= TRAINING_LINES
            ]
            yield pa.RecordBatch.from_pydict(
                {
                    "at": pa.array([r[0] for r in rows], pa.int64()),
                    "label": pa.array([r[1] for r in rows], pa.int32()),
                    "features": pa.array([r[2] for r in rows], pa.binary()),
                    "lengths": pa.array([r[3] for r in rows], pa.binary()),
                }
            )

    # One text per label row at most, however often its id repeats; so bounded by the limit above.
    joined = texts_of(docs, id_col, text_col).join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))
    single = joined.groupBy("__id", "label").agg(F.min("text").alias("text"))
    schema = "at long, label int, features binary, lengths binary"
    rows = single.select(F.xxhash64("__id").alias("at"), "label", "text").mapInArrow(extract, schema).toArrow()
    rows = rows.take(np.lexsort((rows.column("label").to_numpy(), rows.column("at").to_numpy())))
    lengths = [np.frombuffer(x) for x in rows.column("lengths").to_pylist()]
    features = np.frombuffer(b"".join(rows.column("features").to_pylist()))
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in lengths], dtype=np.int64)])
    width = len(lines_of(["x"]).features[0])
    lines = Lines(features.reshape(-1, width), np.concatenate([*lengths, np.empty(0)]), bounds)
    return lines, np.array(rows.column("label").to_pylist(), int)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 5,
    threshold: float = 0.3,
    carry: bool = False,
) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_lines, n_good_lines`` of every whole text.

    ``labels`` has ``doc_id, quality`` (0 or 1; others are ignored). Training
    takes at most ``TRAINING_DOCUMENTS`` labelled documents whose CRC-32 of the
    id modulo ``folds`` is not 0, those of the smallest hashes, and of the texts
    of an id the first; only features of their lines reach the driver, of 4,000
    texts of 2,000 lines about 1 GB. Every text is then scored: a line's features
    and its neighbours' feed the random field, forward-backward gives each
    line's chance to be good, and their mean weighted by length is the score.

    NULL, empty and blank texts have score 0. Without labels of both kinds the
    score of other texts is the share of good labels, or 0.5 without any. NULL
    ids are never held out. Repeated rows are scored each; an empty table gives
    an empty result. Other columns are only read with ``carry``, which returns
    every document whole in a struct ``row``, so that none is joined again.
    """
    lines, known = _sample(docs, labels, id_col, text_col, folds)
    constant = float(known.mean()) if len(known) else 0.5
    model = train(lines, known) if len(set(known.tolist())) == 2 else None
    shared = docs.sparkSession.sparkContext.broadcast(model)
    texts = texts_of(docs, id_col, text_col, carry)
    schema = f"doc_id {type_of(texts, 'doc_id')}, score double, predicted int, n_lines long, n_good_lines long"
    if carry:
        schema += f", row {type_of(texts, 'row')}"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches):
            lines = lines_of(batch.column("text").to_pylist())
            if model is None:
                good = np.full(len(lines.lengths), constant)
            else:
                good = forward_backward(model.logits(lines), lines.bounds, model.steps)[0][:, 1]
            totals = np.concatenate([[[0.0, 0.0, 0.0]], np.cumsum(np.stack([good * lines.lengths, lines.lengths, good >= 0.5], 1), 0)])
            sums = np.diff(totals[lines.bounds], axis=0)
            scores = np.divide(sums[:, 0], sums[:, 1], out=np.zeros(len(sums)), where=sums[:, 1] > 0).clip(0, 1)
            more, names = carried(batch)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(scores),
                    pa.array((scores >= threshold).astype(np.int32)),
                    pa.array(np.diff(lines.bounds).astype(np.int64)),
                    pa.array(sums[:, 2].round().astype(np.int64)),
                    *more,
                ],
                ["doc_id", "score", "predicted", "n_lines", "n_good_lines", *names],
            )

    scored = texts.mapInArrow(judge, schema)
    held_out = F.coalesce(id_crc32(F.col("doc_id")) % folds == 0, F.lit(False))
    return scored.withColumn("held_out", held_out).select("doc_id", "held_out", *scored.columns[1:])

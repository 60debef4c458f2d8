import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from storesales.llm import collocations as module
from storesales.llm.collocations import NEVER, Active, collocations, count_phrases, frequent_phrases


def pieces_of(text):
    lower = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lower)]


def counts_of(rows):
    """Occurrences of all phrases by language, and words."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for w in pieces_of(text):
            totals[lang] += len(w)
            for k in (1, 2, 3):
                counts.update((lang, " ".join(w[i : i + k])) for i in range(len(w) - k + 1))
    return counts, totals


def brute_force(rows, threshold=10, most=2000):
    counts, totals = counts_of(rows)
    found = {}
    for (lang, phrase), a in counts.items():
        w = phrase.split(" ")
        if len(w) == 1 or a < threshold:
            continue
        longer = [n for (l2, p), n in counts.items() if l2 == lang and n >= threshold and len(p.split(" ")) == len(w) + 1
                  and f" {phrase} " in f" {p} "] if len(w) == 2 else []
        if any(100 * n >= 50 * a for n in longer):
            continue
        cuts = []
        for k in range(1, len(w)):
            l, r = counts[lang, " ".join(w[:k])], counts[lang, " ".join(w[k:])]
            cuts.append((10**6 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        found.setdefault(lang, []).append((-score, -a, phrase.encode(), l, r))
    return sorted(
        (lang, i + 1, p.decode(), -a, l, r, totals[lang], -s)
        for lang, some in found.items()
        for i, (s, a, p, l, r) in enumerate(sorted(some)[:most])
    )


@pytest.fixture
def rows(words):
    rng = random.Random(12)
    some = words[:30]
    out = [(rng.choice(["en", "en", "fr", None]), " ".join(rng.choice(some) + rng.choice(["", "", "", ",", "."]) for _ in range(60)))
           for _ in range(60)]
    out += [("en", "New York City is New York City!\nnew york\tcity")] * 9
    out += [("de", "a a a a a")] * 4 + [("fr", None), (None, ""), ("fr", " .,; "), ("x", "alone"), ("", "東京 タワー " * 12)]
    out += [("es", " ".join(rng.choice(some) for _ in range(30_000)))]
    return out


def frame(spark, rows):
    kept = [(i, t, lang, "phrase", 1, 2.0) for i, (lang, t) in enumerate(rows)]
    return spark.createDataFrame(kept, "doc_id long, text string, lang string, phrase string, n int, score double").repartition(5)


@pytest.mark.parametrize(("threshold", "shards"), [(10, 3), (4, 1), (3, 4)])
def test_equals_brute_force(spark, rows, threshold, shards):
    found = collocations(frame(spark, rows), threshold=threshold, shards=shards)
    assert sorted(map(tuple, found.collect())) == brute_force(rows, threshold)


def test_best_of_each_language(spark, rows):
    assert sorted(map(tuple, collocations(frame(spark, rows), threshold=3, most=7).collect())) == brute_force(rows, 3, 7)


def test_crowded_slots_change_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(module, "CHUNK_BYTES", 1)
    monkeypatch.setattr(module, "FEWEST_SLOT_BITS", 14)
    monkeypatch.setattr(module, "MOST_SLOT_BITS", 14)
    monkeypatch.setattr(module, "BATCH_ROWS", 50)
    phrases, totals = frequent_phrases(frame(spark, rows), 5)
    counts, words = counts_of(rows)
    wanted = sorted((lang, p, len(p.split(" ")), n) for (lang, p), n in counts.items() if n >= 5)
    assert sorted(map(tuple, phrases.collect())) == wanted
    assert dict(map(tuple, totals.collect())) == {lang: n for lang, n in words.items() if n}


def test_a_phrase_waits_for_its_subphrases_and_is_counted_once_around():
    table = pa.table({"lang": ["en"], "text": ["a b c"]})
    active = Active(20, [np.full(1 << 20, NEVER, np.uint8) for _ in range(3)])

    def counted(scan, counters=None):
        rows = [r for b in count_phrases(table, active, scan, 3, counters) for r in b.to_pylist()]
        return {r["phrase"]: r["n"] for r in rows}

    hashes = module.word_hashes(pa.array(list("abc")), pa.array(["en"] * 3))
    pairs = module.joint_hashes(hashes[:2], hashes[1:])
    triple = module.joint_hashes(pairs[:1], hashes[2:])
    counters = np.zeros((3, 1 << 20), np.uint8)
    assert counted(0, counters) == {"": 3}
    for table_, expected in zip(counters, (hashes, pairs, triple), strict=True):
        assert set(np.flatnonzero(table_)) == set(active.slots(expected))
    active.reached[0][active.slots(hashes[:2])] = 0
    active.reached[1][active.slots(pairs)] = [1, 0]
    assert counted(0) == {} and counted(1) == {"a": 1, "b": 1} and counted(2) == {"a": 1, "b": 1, "a b": 1}
    active.reached[0][active.slots(hashes[2:])] = 2
    assert counted(3) == {"a": 1, "b": 1, "a b": 1, "c": 1, "b c": 1}
    assert counted(4) == {"a b": 1, "c": 1, "b c": 1}
    active.reached[2][active.slots(triple)] = 0
    assert counted(5) == {"c": 1, "b c": 1, "a b c": 1} and counted(6) == {}


def test_counters_do_not_wrap():
    counters = np.zeros(8, np.uint8)
    module._raise(counters, np.array([3] * 70_000 + [5]))
    module._raise(counters, np.array([5, 5]))
    assert counters.tolist() == [0, 0, 0, 255, 0, 3, 0, 0]


def test_empty_table(spark, no_docs):
    assert collocations(no_docs).collect() == []

import hashlib
import math
import random
import re

import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from storesales.llm import simhash
from storesales.llm.simhash import fingerprint_report, fingerprints, near_counts

SINGLE = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}"
WORD = regex.compile(rf"[{SINGLE}]|[[\p{{L}}\p{{M}}\p{{N}}]--[{SINGLE}]]{{1,16}}", regex.V1)


def print_of(text):
    words = [w.encode() for w in WORD.findall((text or "").lower())]
    votes = [0] * 128
    for i in range(len(words)):
        h = 42
        for w in words[i : i + 3]:
            h = xxhash.xxh64_intdigest(w, h)
        other = xxhash.xxh64_intdigest((1).to_bytes(4, "little"), xxhash.xxh64_intdigest(h.to_bytes(8, "little"), 42))
        both = h | other << 64
        for b in range(128):
            votes[b] += 1 if both >> b & 1 else -1
    high, low = (sum((v > 0) << b for b, v in enumerate(votes[a : a + 64])) for a in (0, 64))
    return f"{high:016x}{low:016x}"


def differing(a, b):
    return bin(int(a, 16) ^ int(b, 16)).count("1")


def likeness(a, b):
    return max(0.0, math.cos(math.pi * differing(a, b) / 128))


def report(rows):
    """The documents in falling order of ids, NULL ids last; equal ids must have equal texts."""
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda x: (x[0] is None, -(x[0] or 0)))
    prints = [print_of(t) for _, t in ordered]
    out = []
    for at, (i, t) in enumerate(ordered):
        after = (at + 1) % len(ordered)
        k = len(t) // 3
        edited = t[: len(t) - k] + ordered[after][1][:k]
        changed = print_of(edited)
        near = sum(differing(prints[at], p) <= 3 for p in prints) - 1 if i is not None and i % 20 == 0 else None
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), prints[at], changed, likeness(prints[at], changed),
                    likeness(prints[at], prints[after]), near))
    return out


@pytest.fixture
def single(tricky):
    """As ``tricky``, but rows of the same id have the same text."""
    seen = {}
    return [(i, t) for i, t in tricky if seen.setdefault(i, t) == t]


def same(found, wanted):
    order = lambda r: repr(tuple(r)[:5])
    for f, w in zip(sorted(map(tuple, found), key=order), sorted(wanted, key=order), strict=True):
        assert f[:5] == w[:5] and f[7:] == w[7:]
        assert f[5] == pytest.approx(w[5], abs=1e-9) and f[6] == pytest.approx(w[6], abs=1e-9)


@pytest.mark.parametrize("ranges", [1, 2])
def test_report_equals_brute_force(spark, single, settings, ranges):
    settings({"spark.sql.shuffle.partitions": "3"} if ranges == 2 else {})
    docs = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in single], "doc_id long, text string, row int, bucket int, high string")
    docs = docs.repartition(3)
    same(fingerprint_report(docs, docs.where("doc_id % 20 = 0")).collect(), report(single))


def test_counters_of_long_texts_are_unpacked(spark, single, monkeypatch):
    monkeypatch.setattr(simhash, "VOTES", 50)
    docs = spark.createDataFrame(single, "doc_id long, text string")
    assert sorted(map(tuple, fingerprints(docs).collect()), key=repr) == sorted([(i, print_of(t)) for i, t in single], key=repr)


def test_text_ids_one_document_and_empty_tables(spark, no_docs, words):
    named = spark.createDataFrame([("b", "one two three four five six"), ("a", " ".join(words))], "doc_id string, text string")
    found = {r["doc_id"]: r for r in fingerprint_report(named).collect()}
    text = "one two three four five six"
    k = len(text) // 3
    assert found["b"]["edited_sha256"] == hashlib.sha256((text[:-k] + " ".join(words)[:k]).encode()).hexdigest()
    k = len(" ".join(words)) // 3
    assert found["a"]["edited_sha256"] == hashlib.sha256((" ".join(words)[:-k] + text[:k]).encode()).hexdigest()
    alone = fingerprint_report(named.where("doc_id = 'a'")).first()
    assert alone["near_next"] == 1.0 and alone["fingerprint"] == found["a"]["fingerprint"]
    assert fingerprint_report(no_docs, no_docs).collect() == []
    assert fingerprints(no_docs).collect() == []


@pytest.mark.parametrize(("radius", "blocks"), [(3, 4), (2, 8), (5, 8), (0, 1)])
def test_tables_find_all_within_the_radius(spark, monkeypatch, radius, blocks):
    monkeypatch.setattr(simhash, "COMPARED", 3)
    monkeypatch.setattr(simhash, "SALTS", 2)
    rng = random.Random(radius)
    prints = []
    for _ in range(12):
        base = rng.getrandbits(128)
        prints += [base ^ sum(1 << b for b in rng.sample(range(128), rng.randint(0, radius + 2))) for _ in range(12)]
    prints += prints[:5]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    halves = [(signed(p >> 64), signed(p & (1 << 64) - 1)) for p in prints]
    rows = spark.createDataFrame(halves, "high long, low long")
    found = {(r["high"], r["low"]): r["n_near"] for r in near_counts(rows, rows.limit(90), radius, blocks).collect()}
    wanted = {h: sum(bin(p ^ q).count("1") <= radius for q in prints) for h, p in zip(halves[:90], prints, strict=False)}
    assert found == wanted


def test_edits_keep_texts_near_and_next_ones_are_far(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = fingerprint_report(docs).where("n_chars > 300").collect()
    assert sum(r["near_edited"] > r["near_next"] for r in rows) >= 0.97 * len(rows)


def test_no_python_in_the_plan(docs):
    for frame in (fingerprint_report(docs, docs), fingerprints(docs)):
        assert not re.search("Python|Arrow|Pandas|BroadcastNestedLoop|Cartesian", frame._jdf.queryExecution().toString())


def test_search_needs_more_blocks_than_the_radius(spark):
    rows = spark.createDataFrame([(1, 2)], "high long, low long")
    with pytest.raises(ValueError, match="blocks"):
        near_counts(rows, rows.select(F.col("high"), "low"), 4, 4)

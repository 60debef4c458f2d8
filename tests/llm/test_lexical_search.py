import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from storesales.llm import lexical_search
from storesales.llm.lexical_search import Searcher, items_of, make_block, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def brute_force(docs, items, k=10):
    docs = [(i, Counter(terms_of(t))) for i, t in docs]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    total, length = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for i, c, n in docs:
            m = 10 + 90 * n * total // length
            score = 0
            for t in set(terms_of(text)) & set(c):
                score += math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i))
        scored.sort()
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.fixture
def queries(tricky, words):
    rng = random.Random(8)
    some = [(i, " ".join(rng.choice(words) for _ in range(12))) for i in range(20)]
    quotes = [(100 + i, t) for i, t in tricky[:8]]
    return some + quotes + [
        (200, None), (201, ""), (202, " ,;"), (203, "one"), (203, "one"), (203, "东京 東京"), (204, "ONE nowhere-to-be-found x"),
        (None, "two three"),
    ]


def frame(spark, queries):
    return spark.createDataFrame([(i, t, 1, "r", 2.0) for i, t in queries], "item_id long, text string, rank int, doc_id string, score double")


def test_equals_brute_force(spark, docs, tricky, queries):
    assert rows_of(search(docs, frame(spark, queries))) == brute_force(tricky, [(i, t or "") for i, t in queries])


def test_many_blocks_and_blocks_of_items(spark, docs, tricky, queries, monkeypatch):
    monkeypatch.setattr(lexical_search, "ITEM_BYTES", 1000)
    found = search(docs, frame(spark, queries), k=3)
    assert rows_of(found) == brute_force(tricky, [(i, t or "") for i, t in queries], 3)


def test_text_ids_and_empty_tables(spark, tricky, queries, no_docs):
    named = spark.createDataFrame([(None if i is None else f"d{i}", t) for i, t in tricky], "doc_id string, text string")
    asked = frame(spark, queries)
    found = rows_of(search(named, asked))
    assert found == brute_force([(None if i is None else f"d{i}", t) for i, t in tricky], [(i, t or "") for i, t in queries])
    assert search(no_docs, asked).collect() == []
    assert search(named, asked.limit(0)).collect() == []


def zipf_corpus(seed, n_docs=600, n_items=12):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    weights = [1 / (i + 1) for i in range(500)]
    texts = [" ".join(rng.choices(vocabulary, weights, k=rng.randint(5, 120))) for _ in range(n_docs)]
    return texts, [" ".join(rng.choices(vocabulary, weights, k=15)) for _ in range(n_items)]


def blocks_of(texts, items, size):
    """Blocks built without Spark."""
    counted = [Counter(terms_of(t)) for t in texts]
    place = {t: i for i, t in enumerate(items.vocabulary.to_pylist())}
    df = np.array([sum(t in c for c in counted) for t in place], np.int64)
    lengths = [sum(c.values()) for c in counted]
    items.weigh(df, len(texts))
    held = [sorted((place[t], n) for t, n in c.items() if t in place) for c in counted]
    pack = lambda rows, at: [np.array([x[at] for x in r], "<u4").tobytes() for r in rows]
    for a in range(0, len(texts), size):
        some = slice(a, a + size)
        ids = pa.array(range(a, min(a + size, len(texts))))
        yield make_block(ids, lengths[some], pack(held[some], 0), pack(held[some], 1), items, len(texts), sum(lengths))


@pytest.mark.parametrize("seed", range(4))
def test_bounds_hold_and_pairs_skip_more(seed):
    texts, asked = zipf_corpus(seed)
    wanted = defaultdict(list)
    for item, _, doc, score in brute_force(list(enumerate(texts)), list(enumerate(asked)), 3):
        wanted[item].append((score, doc))

    def run(pairs: bool, seeded: bool):
        items = items_of(pa.array(range(len(asked))), pa.array(asked))
        blocks = list(blocks_of(texts, items, 50))
        if not pairs:
            items.item_pairs = [np.full_like(p, -1) for p in items.item_pairs]
        seeds = -np.sort(-np.array([b.seeds for b in blocks]), axis=0)
        searcher = Searcher(items, seeds[2] if seeded else np.zeros(len(asked), np.int64), 3)
        for block in blocks:
            for p, joint in zip(block.pairs, block.joint, strict=True):
                a, b = (dict(zip(*posting, strict=True)) for posting in (postings(block, items, t) for t in items.pairs[p]))
                assert joint == max(a[d] + b[d] for d in a.keys() & b.keys())
            searcher.search(block)
        for item, best in enumerate(searcher.best):
            assert sorted(best) == sorted(wanted[item])
        return searcher

    plain, paired, seeded = run(False, False), run(True, False), run(True, True)
    assert paired.postings_read < plain.postings_read
    assert seeded.postings_read < paired.postings_read and seeded.blocks_skipped >= paired.blocks_skipped
    assert seeded.postings_read < 0.8 * sum(len(set(terms_of(q)) & set(terms_of(t))) for q in asked for t in texts)


def postings(block, items, term):
    at = np.searchsorted(block.terms, term)
    own = slice(block.starts[at], block.starts[at + 1])
    return block.docs[own].tolist(), (block.impacts[own] * items.weights[term]).tolist()

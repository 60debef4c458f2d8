import random

import numpy as np
import pytest
from pyspark.sql import Row

from storesales.llm import embedding_links as links_module
from storesales.llm import jaccard_join
from storesales.llm.components import components
from storesales.llm.embedding_links import CoverTree, Traversal, embedding_links
from storesales.llm.jaccard_join import jaccard_components
from storesales.llm.words import words_of


def smallest(ids, pairs):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, n=5):
    words = (text or "").encode().lower().split()
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute_force(rows, percent=80):
    """Component ids of ``(id, text)`` rows; ids must be unique."""
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    pairs = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[:k]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    root = smallest(ids, pairs)
    return {i: (len(sets[i]), root[i]) for i in ids}


def test_components_of_texts(docs, tricky):
    got = [tuple(r) for r in jaccard_components(docs).collect()]
    rows = [(i, t) for i, t in tricky if i is not None]
    want = brute_force(dict(rows).items())
    assert sorted(x for x in got if x[0] is not None) == sorted((i, *want[i]) for i, _ in rows)
    # A NULL id shares its text's component, or is alone with an empty text.
    assert sorted((x[1:] for x in got if x[0] is None), key=repr) == sorted([want[1], (0, None)], key=repr)


def near_copies(words, seed):
    """Chains of copies with growing changes, and passages that many different texts share."""
    rng = random.Random(seed)
    passage = [rng.choice(words) for _ in range(60)]
    rows = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(5, 120))]
        rows.append(base)
        for _ in range(rng.randint(0, 14)):
            copy = rng.choice(rows[-3:]).copy()
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(copy)
        rows.append(passage[rng.randint(0, 5) :] + [rng.choice(words) for _ in range(rng.randint(0, 30))])
    rng.shuffle(rows)
    return [(i, " ".join(r)) for i, r in enumerate(rows)]


@pytest.mark.parametrize(("seed", "at_once"), [(1, 512), (2, 512), (3, 0), (4, 0)])
def test_no_link_between_different_texts_is_lost(spark, words, monkeypatch, seed, at_once):
    monkeypatch.setattr(jaccard_join, "PAIRS_AT_ONCE", at_once)
    rows = near_copies(words, seed)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(table).collect()}
    assert got == brute_force(rows)


def test_a_large_group_is_joined_over_hubs(spark, words):
    rng = random.Random(9)
    base = [rng.choice(words) for _ in range(100)]
    rows = []
    for i in range(400):
        copy = base.copy()
        for _ in range(2):
            copy[rng.randrange(100)] = f"w{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(table).collect()}
    assert got == brute_force(rows)


@pytest.fixture
def pairs_counted(monkeypatch):
    """How many pairs of sets each round has counted."""
    seen = []
    links = jaccard_join._links

    def counted(pairs, segments):
        seen.append(pairs.count())
        return links(pairs, segments)

    monkeypatch.setattr(jaccard_join, "_links", counted)
    return seen


def test_variants_of_one_text_are_joined_by_it(spark, words, pairs_counted):
    """Two variants share too little to link, each links to the text that they were made from."""
    rng = random.Random(10)
    base = [rng.choice(words) for _ in range(60)]
    rows = [(i, " ".join(base)) for i in range(5000, 5020)]
    for i in range(10_000):
        copy = base.copy()
        copy[rng.randrange(60)] = f"w{i}"
        rows.append((i if i < 5000 else i + 20, " ".join(copy)))
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = jaccard_components(table).groupBy("component_id").count().collect()
    assert [tuple(r) for r in got] == [(0, 10_020)]
    assert sum(pairs_counted) <= 1.2 * 10_001


def test_more_pairs_than_entries_are_not_compared_at_once(spark, words, monkeypatch):
    """Variants of a text that is not there: most of them do not link to the first one that all are compared with."""
    levels, by_level = [], jaccard_join._by_level

    def recorded(entries, level, percent):
        levels.append(level)
        return by_level(entries, level, percent)

    monkeypatch.setattr(jaccard_join, "_by_level", recorded)
    rng = random.Random(12)
    base = [rng.choice(words) for _ in range(100)]
    rows = []
    for i in range(150):
        at = rng.randrange(10, 85)
        rows.append((i, " ".join([*base[:at], f"w{i}", *base[at + 1 :], f"u{i}", f"v{i}"])))
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(table).collect()}
    assert got == brute_force(rows)
    assert max(levels) > 0


def test_a_template_that_links_nobody(spark, words):
    rng = random.Random(11)
    template = [rng.choice(words) for _ in range(75)]
    rows = [(i, " ".join(template + [f"w{i}x{k}" for k in range(15)])) for i in range(150)]
    rows += [(i + 1000, text + " y") for i, text in rows[:20]]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(table).collect()}
    assert got == brute_force(rows)


@pytest.mark.parametrize("changed", [{"id_bits": 4}, {"long_list": 2}])
def test_shared_ids_and_long_lists_change_nothing(spark, words, changed):
    rows = near_copies(words, 4)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = jaccard_join.jaccard_sets(table, **changed).collect()
    groups = {}
    for r in found:
        groups.setdefault(r.comp if r.comp is not None else ("alone", r.doc_id), []).append(r.doc_id)
    got = {i: (r.n, min(groups[r.comp if r.comp is not None else ("alone", i)])) for r in found for i in [r.doc_id]}
    assert got == brute_force(rows)


def test_fragments_hold_every_n_gram_once_and_overlaps_add_up():
    rng = np.random.default_rng(3)
    order = jaccard_join.Order(rng.integers(0, 40, 1 << 14).astype(np.uint8), 14)
    pivots = order.pivots(8)
    a, b = (np.unique(rng.integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2)) for _ in range(2))
    b = np.unique(np.concatenate([b, a[:200]]))
    cut_ = [np.searchsorted(pivots, order.keys(x), side="right") for x in (a, b)]
    assert len(set(cut_[0])) == 8
    assert all((np.sort(order.keys(a[cut_[0] == f])) >= order.keys(a[cut_[0] == f - 1]).max()).all() for f in range(1, 8))
    parts = [([a[cut_[0] == f].tobytes()], [b[cut_[1] == f].tobytes()]) for f in range(8)]
    partial = [int(jaccard_join.shared_counts(x, y)[0]) for x, y in parts]
    assert sum(partial) == len(np.intersect1d(a, b)) and max(partial) < sum(partial)
    both = jaccard_join.shared_counts([a.tobytes(), b"", b.tobytes()], [b.tobytes(), b.tobytes(), b.tobytes()])
    assert both.tolist() == [sum(partial), 0, len(b)]


def test_ids_that_repeat_with_other_texts(spark, words):
    a, b = (" ".join(words[i : i + 60]) for i in (0, 100))
    rows = [(1, a), (1, b), (1, a), (2, a + " x"), (3, b + " y"), (4, b + " y z")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id) for r in jaccard_components(table).collect())
    assert got == [(1, 1), (1, 1), (1, 1), (2, 1), (3, 1), (4, 1)]


def test_other_sizes_and_empty_tables(spark, no_docs):
    assert jaccard_components(no_docs).collect() == []
    rows = [(1, "a b c"), (2, "a b c d"), (3, "x"), (4, None)]
    table = spark.createDataFrame(rows, "id int, t string")
    got = {r.doc_id: r.component_id for r in jaccard_components(table, "id", "t", n=2, percent=60).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


def test_words_are_cut_at_the_six_white_space_characters_only():
    texts = ["a\tb\x0bc\x1cd e", "", " Ab\n", "\x00 é"]
    words = words_of(texts, lower=True)
    want = [w for t in texts for w in t.encode().lower().split()]
    raw = words.data.tobytes()
    assert [raw[s : s + n] for s, n in zip(words.starts, words.lengths, strict=True)] == want
    assert list(words.bounds) == [0, 4, 4, 5, 7]


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    table = spark.createDataFrame([*edges, (None, 3)], "a long, b long").repartition(13)
    found = {r.vertex: r.root for r in components(table).collect()}
    vertices = {v for e in edges for v in e}
    want = smallest(vertices, edges)
    assert found == {v: r for v, r in want.items() if v != r}
    assert components(table.where("false")).collect() == []


def vectors(seed):
    rng = np.random.default_rng(seed)
    rows = []
    for centre in rng.normal(size=(60, 12)):
        for _ in range(rng.integers(1, 7)):
            rows.append((centre + rng.normal(size=12) * rng.choice([0, 0.05, 0.2, 0.3])).astype("f4"))
    return [*rows, *[rows[0]] * 30]


def test_trees_cover_and_traversal_is_exact():
    points = np.array(vectors(4), float)
    points = np.unique(points / np.linalg.norm(points, axis=1, keepdims=True), axis=0)
    keys = np.random.default_rng(1).permutation(len(points))
    half = len(points) // 2
    trees = [CoverTree.build(points[k], np.ones(len(k)), k) for k in (keys[:half], keys[half:])]
    for tree in trees:
        for first, last, centre, radius in zip(tree.first, tree.last, tree.centre, tree.radius, strict=True):
            reach = np.linalg.norm(tree.points[first:last] - tree.points[centre], axis=1)
            assert reach.max() <= radius + 1e-7
    links = points @ points.T >= 0.95
    np.fill_diagonal(links, False)
    counts = np.zeros(len(points))
    edges = []
    for a, b in ((trees[0], None), (trees[1], None), tuple(trees)):
        done = Traversal(a, b, 0.95)
        np.add.at(counts, a.keys, done.counts_a)
        if b is not None:
            np.add.at(counts, b.keys, done.counts_b)
        edges += zip(*done.forest(), strict=True)
    assert (counts == links.sum(axis=1)).all()
    assert smallest(range(len(points)), edges) == smallest(range(len(points)), zip(*np.nonzero(links), strict=True))


@pytest.mark.parametrize("at_once", [16, 1 << 21])
def test_links_of_vectors(spark, monkeypatch, at_once):
    monkeypatch.setattr(links_module, "CHUNK", 64)
    monkeypatch.setattr(links_module, "AT_ONCE", at_once)
    good = [[float(x) for x in v] for v in vectors(7)]
    bad = [None, [], [0.0] * 12, [float("nan")] + [1.0] * 11, [float("inf")] + [1.0] * 11, [1.0, None]]
    rows = [Row(vec_id=i, embedding=v, label=i, n_links=1, v=2.0, key=1) for i, v in enumerate([*good, *bad, [1.0, 2.0], [2.0, 4.0]])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, n_links int, v double, key long")
    nameless = spark.createDataFrame([(None, good[0], 1, 1, 1.0, 1)], table.schema)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_links(table.union(nameless)).collect()}
    usable = {r.vec_id: np.array(r.embedding) for r in rows if r.embedding not in bad and not np.isnan(r.embedding).any()}
    pairs = []
    for a, x in usable.items():
        for b, y in usable.items():
            if a < b and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95:
                pairs.append((a, b))
    root = smallest([r.vec_id for r in rows], pairs)
    counts = {i: sum(i in p for p in pairs) for i in root}
    assert got == {**{i: (counts[i], root[i], root[i] == i) for i in root}, None: (0, None, True)}


def test_full_cells_are_divided_so_that_far_parts_never_meet(spark, monkeypatch):
    """Clustered vectors: pairs of parts grow with the vectors, not with their square; links are exact."""
    monkeypatch.setattr(links_module, "CHUNK", 32)
    monkeypatch.setattr(links_module, "MOST_CELLS", 8)
    seen, find = [], links_module._part_pairs

    def counted(trees, cell_pairs, reach):
        pairs = find(trees, cell_pairs, reach)
        seen.append((trees.count(), pairs.count()))
        return pairs

    monkeypatch.setattr(links_module, "_part_pairs", counted)
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(40, 12))
    middles /= np.linalg.norm(middles, axis=1, keepdims=True)
    for each in (8, 40):
        points = np.repeat(middles, each, axis=0) + rng.normal(size=(40 * each, 12)) * 0.01
        table = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
        got = {r.vec_id: r.n_links for r in embedding_links(table).collect()}
        unit = points / np.linalg.norm(points, axis=1, keepdims=True)
        assert got == dict(enumerate(((unit @ unit.T >= 0.95).sum(axis=1) - 1).tolist()))
    (few, few_pairs), (many, many_pairs) = seen
    assert many > 20 and many_pairs < 0.5 * many * (many + 1) / 2, seen


def unit_vectors(seed, n, dimensions, spread=0.0):
    """Independent directions, or such that lie about a few."""
    rng = np.random.default_rng(seed)
    points = rng.normal(size=(n, dimensions))
    if spread:
        points = points * spread + rng.normal(size=(9, dimensions))[rng.integers(0, 9, n)]
    return points / np.linalg.norm(points, axis=1, keepdims=True)


def test_trees_of_independent_vectors_grow_in_proportion(monkeypatch):
    n, compared, find = 8192, [], links_module._distances
    points = unit_vectors(3, n, 64)

    def counted(a, b):
        compared.append(len(a) * len(b))
        return find(a, b)

    monkeypatch.setattr(links_module, "_distances", counted)
    tree = CoverTree.build(points, np.ones(n), np.arange(n))
    assert sorted(tree.keys) == list(range(n)) and np.array_equal(tree.points, points[tree.keys])
    assert sum(compared) < n * n / 8


def test_a_dense_group_is_compared_at_once_and_not_by_pairs_of_children(monkeypatch):
    """Members further from each other than half of the group's radius are children of their own."""
    monkeypatch.setattr(links_module, "AT_ONCE", 1 << 12)
    rng = np.random.default_rng(6)
    points = rng.normal(size=64) / 8 + rng.normal(size=(400, 64)) * 0.0125
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    tree = CoverTree.build(points, np.ones(400), np.arange(400))
    compared, find = [], links_module._distances

    def counted(a, b):
        compared.append(1)
        return find(a, b)

    monkeypatch.setattr(links_module, "_distances", counted)
    done = Traversal(tree, None, 0.95)
    links = tree.points @ tree.points.T >= 0.95
    assert done.counts_a.tolist() == (links.sum(axis=1) - 1).tolist()
    assert len(compared) < 400


def test_trees_meet_without_a_shuffle(spark, settings):
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    rows = [(cell, part, [float(cell), 0.0], 0.1, b"tree") for cell in range(6) for part in range(3)]
    trees = links_module.cut(spark.createDataFrame(rows, "cell long, part long, middle array<double>, radius double, tree binary"), "trees")
    near = [(a, b) for a in range(6) for b in (a, a + 1) if b < 6 and (a, b) != (2, 3)]
    met = links_module._part_pairs(trees, spark.createDataFrame(near, "ca long, cb long"), 0.85)
    assert "hashpartitioning" not in met._jdf.queryExecution().executedPlan().toString()
    assert [r.ta + r.tb for r in met.select("ta", "tb").collect()] == [b"treetree"] * met.count()
    within = {(a, p, a, q) for a in range(6) for p in range(3) for q in range(p, 3)}
    between = {(a, p, b, q) for a, b in near if a < b for p in range(3) for q in range(3)}
    assert {tuple(r) for r in met.select("ca", "pa", "cb", "pb").collect()} == within | between and met.count() == len(within | between)


@pytest.mark.parametrize("threshold", [0.95, 0.7, 0.3, -0.2, 0.9999])
@pytest.mark.parametrize(("dimensions", "spread"), [(64, 0.0), (40, 0.05), (40, 0.3), (64, 1.0), (3, 0.1)])
def test_leading_coordinates_lose_no_link(monkeypatch, threshold, dimensions, spread):
    for name, value in (("ROWS", 16), ("COLUMNS", 32), ("STRIP", 24)):
        monkeypatch.setattr(links_module, name, value)
    points = unit_vectors(8, 500, dimensions, spread)
    points[:40] = points[40:80] + 1e-9
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    weights, keys = np.arange(1, 501) % 7 + 1.0, np.random.default_rng(1).permutation(500)
    reach = (2 - 2 * threshold) ** 0.5
    for axes in (None, links_module._axes(points[::8])):
        counts, edges = np.zeros(500), []
        trees = [CoverTree.build(points[k], weights[k], k, min(1.0, reach / 2)) for k in (keys[:200], keys[200:])]
        for a, b in ((trees[0], None), (trees[1], None), tuple(trees)):
            done = Traversal(a, b, threshold, axes)
            counts[a.keys] += done.counts_a
            if b is not None:
                counts[b.keys] += done.counts_b
            edges += zip(*done.forest(), strict=True)
        links = points @ points.T >= threshold
        np.fill_diagonal(links, False)
        assert counts.tolist() == (links @ weights).tolist()
        assert smallest(range(500), edges) == smallest(range(500), zip(*np.nonzero(links), strict=True))


def test_repeated_vectors_and_empty_tables(spark):
    table = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, embedding_links(table).collect())) == [(1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True)]
    assert embedding_links(table.where("false")).collect() == []


def test_a_set_that_only_rows_without_ids_have_is_a_bridge(spark):
    words = [f"w{i}" for i in range(100)]
    # 0 and 2 fall short of the similarity with each other, each reaches it with 1.
    texts = [" ".join(["a", *words[:90]]), " ".join(words), " ".join([*words[12:], "b"])]
    want = brute_force([(1, texts[0]), (2, texts[2])])
    assert want[1][1] != want[2][1]
    table = spark.createDataFrame([(1, texts[0]), (2, texts[2]), (None, texts[1])], "doc_id long, text string")
    assert {r.component_id for r in jaccard_components(table).collect()} == {1}


def test_slack_covers_rounding_of_small_distances():
    rng = np.random.default_rng(4)
    a = rng.normal(size=(400, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    for gap in (1e-9, 2e-8, 1e-7, 1e-6):
        b = a + gap / 8 * rng.choice([-1, 1], a.shape)
        b /= np.linalg.norm(b, axis=1)[:, None]
        near = np.array([links_module._distances(x[None], y[None])[0, 0] for x, y in zip(a, b, strict=True)])
        assert np.abs(near - np.linalg.norm(a - b, axis=1)).max() < links_module.SLACK


def test_very_large_and_very_small_components_link(spark):
    rows = [(0, [1e200, 2e200]), (1, [3e-200, 6e-200]), (2, [1.0, 2.0]), (3, [-1e200, 2e200]), (4, [5e-324, 0.0]), (5, [1e308, 1e-300])]
    found = embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == [(0, 2, 0), (1, 2, 0), (2, 2, 0), (3, 0, 3), (4, 1, 4), (5, 1, 4)]

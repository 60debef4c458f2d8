import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from by_hand import by_hand, quality
from storesales.llm import language
from storesales.llm.language import identify, mixture, trigrams
from storesales.llm.quality import _sample, forward_backward, lines_of, score_quality, train, with_neighbours

DATA = "/root/testdata/sf0.01"


def crc(i):
    return zlib.crc32(str(i).encode())


def test_forward_backward_is_enumeration():
    rng = np.random.default_rng(3)
    bounds = np.array([0, 3, 3, 4, 8])
    logits, steps = rng.normal(size=8), rng.normal(size=(2, 2))
    single, pairs = forward_backward(logits, bounds, steps)
    for a, b in zip(bounds, bounds[1:], strict=False):
        n = b - a
        total, ones, both = 0.0, np.zeros(n), np.zeros((max(n - 1, 0), 2, 2))
        for code in range(2**n if n else 0):
            y = [(code >> i) & 1 for i in range(n)]
            weight = np.exp(sum(logits[a + i] * y[i] for i in range(n)) + sum(steps[y[i], y[i + 1]] for i in range(n - 1)))
            total += weight
            ones += weight * np.array(y)
            for i in range(n - 1):
                both[i, y[i], y[i + 1]] += weight
        if n:
            assert np.allclose(single[a:b, 1], ones / total)
            assert np.allclose(pairs[a : b - 1], both / total)
            assert not pairs[b - 1].any()


def test_lines_and_neighbours():
    lines = lines_of(["a b\n\n c c c \n", "", "x"])
    assert list(lines.bounds) == [0, 2, 2, 3]
    x = with_neighbours(lines)
    own = lines.features.shape[1]
    assert (x[0, own : 2 * own] == 0).all() and (x[1, own : 2 * own] == lines.features[0]).all()
    assert (x[1, 2 * own : 3 * own] == 0).all() and (x[0, 2 * own : 3 * own] == lines.features[1]).all()


def test_quality_of_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    scored = score_quality(docs, labels).join(labels, "doc_id").toPandas()
    assert (scored.held_out == [crc(i) % 5 == 0 for i in scored.doc_id]).all()
    assert ((scored.score >= 0.3) == scored.predicted).all()
    held = scored[scored.held_out]
    assert (held.predicted == held.quality).mean() > 0.95


def test_scores_by_hand(spark, tricky):
    """Features, marginals and their mean, line by line; one text has very many lines."""
    folder = DATA.replace("0.01", "0.001")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    many = "\n".join(f"line {i % 37} of | many!" + " again" * (i % 3) for i in range(5000))
    rows += [(20_000 + i, t) for i, (_, t) in enumerate(tricky)] + [(30_000, many), (30_001, "a a a\n\nb\n a a a\nA1 B2 || x")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in score_quality(table, labels).collect()}
    model = train(*_sample(table, labels, "doc_id", "text", 5))
    assert len(found) == len(rows)
    for i, text in rows:
        score, lines, good = quality(model, text)
        assert (found[i].n_lines, found[i].n_good_lines) == (lines, good), i
        assert found[i].score == pytest.approx(score, abs=1e-9), i
        assert (found[i].held_out, found[i].predicted) == (crc(i) % 5 == 0, int(found[i].score >= 0.3)), i


def test_labels_and_other_columns_are_no_input_of_a_score(spark, docs):
    labels = spark.createDataFrame([(i, i % 2, 0, "x") for i in range(120)], "doc_id long, quality int, toxic int, text string")
    one = {(r.doc_id, r.score) for r in score_quality(docs, labels).collect()}
    moved = docs.withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit("other"))
    assert {(r.doc_id, r.score) for r in score_quality(moved, labels).collect()} == one


def test_quality_without_labels_or_texts(spark, docs, no_docs, tricky):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = score_quality(docs, labels).collect()
    assert len(got) == len(tricky)
    assert {r.score for r in got} == {0.0, 0.5}
    assert all(r.score == 0 for r in got if r.doc_id in (200, 201, 202))
    assert score_quality(no_docs, labels).collect() == []
    one_kind = spark.createDataFrame([(i, 1) for i in range(20)] + [(3, None), (4, 7), (None, 1)], "doc_id long, quality int")
    assert {r.score for r in score_quality(docs, one_kind).collect()} == {0.0, 1.0}


def test_whole_documents_are_carried(docs, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for found in (score_quality(docs, labels, carry=True), identify(docs, carry=True)):
        assert sorted(map(repr, found.select("row.*").collect())) == sorted(map(repr, docs.collect()))


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    found = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (found.held_out == [crc(i) % 4 == 2 for i in found.doc_id]).all()
    held = found[found.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.97
    assert found.score.between(0, 1).all()


def test_languages_by_hand(spark, docs, tricky):
    """The whole operator, trigram by trigram, on texts of one language, mixed ones and odd ones."""
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(DATA.replace("0.01", "0.001") + "/documents.parquet").collect()]
    first = {lang: [t for _, t, x in rows if x == lang][:4] for lang in ("en", "fr", "de")}
    mixed = [" ".join(w for lang in langs for w in first[lang][k].split()[:25]) for k in range(4) for langs in (("en", "fr"), ("fr", "de"), ("de", "en", "fr"))]
    odd = [t for i, t in tricky if i is None or i < 209 or i > 209]
    more = [(10_000 + k, t, None) for k, t in enumerate(mixed + odd)]
    table = spark.createDataFrame(rows + more, "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in identify(table, background=True).collect() if r.doc_id >= 10_000 or r.doc_id % 5 == 0}
    wanted = by_hand(rows, [(i, t, None) for i, t, _ in rows + more if i in found])
    assert sum(len(w.langs) > 1 for w in wanted.values()) >= 6
    for i, w in wanted.items():
        r = found[i]
        assert (r.held_out, r.lang_pred, r.langs) == (w.held_out, w.lang, w.langs), i
        assert [r.score, *r.shares, r.gain, r.error] == pytest.approx([w.score, *w.shares, w.gain, w.error], abs=1e-6), i


def test_many_languages_are_counted_a_few_at_a_time(spark, words, monkeypatch):
    rows = [(i, " ".join(words[i % 40 * 10 : i % 40 * 10 + 10]) * 3, f"l{i % 40:02}") for i in range(160)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    found = sorted(map(tuple, identify(table).collect()), key=repr)
    monkeypatch.setattr(language, "HELD_LANGUAGES", 3)
    names, model, learned, _ = language.learn(table.select("lang", "text"))
    assert len(names) == 40 and learned.sum() > 0
    assert sorted(map(tuple, identify(table).collect()), key=repr) == found


def test_mixed_texts_have_their_languages(spark):
    english = "the house and the garden are where they were when the summer went over the hill with them"
    german = "der garten und das haus sind noch immer dort wo sie im sommer waren als wir zu ihnen gingen"
    rows = [(i, t, lang) for i in range(60) for t, lang in ((english, "en"), (german, "de"))]
    both = [(1000, english + " " + german, None), (1001, english, None), (1002, german, None)]
    table = spark.createDataFrame(rows + both, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in identify(table).where("doc_id >= 1000").collect()}
    assert sorted(got[1000].langs) == ["de", "en"] and all(0.4 < s < 0.6 for s in got[1000].shares)
    assert (got[1001].langs, got[1001].score, got[1002].lang_pred) == (["en"], 1.0, "de")


def test_a_set_of_languages_is_worth_its_price():
    model = np.array([[0.5, 0.1, 0.45], [0.4, 0.2, 0.45], [0.1, 0.7, 0.1]])
    model /= model.sum(axis=0)
    one, two = (np.array([0, 1]), np.array([50, 40])), (np.array([0, 1, 2]), np.array([500, 400, 700]))
    alone, mixed = mixture(model, [one, two])
    assert (alone > 0).sum() == 1 and (mixed > 0).sum() >= 2
    assert np.allclose([alone.sum(), mixed.sum()], 1)


@pytest.mark.parametrize("text", ["", "a", "12 34", "é"])
def test_short_texts_have_few_trigrams(text):
    assert len(trigrams(text)[0]) <= 2


def test_languages_without_text_or_labels(docs, no_docs, tricky):
    got = identify(docs).collect()
    assert len(got) == len(tricky)
    for r in got:
        if r.doc_id in (200, 201, 202) or r.doc_id is None and r.lang_pred == "und":
            assert (r.lang_pred, r.score, r.langs) == ("und", 0.0, [])
        else:
            assert (r.lang_pred, r.score) == ("en", 1.0)
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in identify(unlabelled).collect()} == {("und", 0.0)}
    assert identify(no_docs).collect() == []


def test_an_id_is_learned_from_once_however_often_it_repeats(spark):
    rows = [(i, f"text of {i}\nwith two lines") for i in range(40)] + [(7, f"again {k}") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(7, 1)], "doc_id long, quality int")
    lines, known = _sample(docs, labels, "doc_id", "text", 5)
    assert len(known) == len(lines.bounds) - 1 == sum(crc(i) % 5 != 0 for i in range(40))

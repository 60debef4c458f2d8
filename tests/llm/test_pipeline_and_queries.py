import importlib
import random
import re
import sys
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from by_hand import by_hand
from storesales.llm import queries as llm
from test_similarity import brute_force

DATA = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_against_sql(spark, duck, name):
    got = llm.queries()[name](spark, DATA).toPandas()
    want = duck.execute(llm.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    assert sorted(got[columns].itertuples(index=False, name=None)) == sorted(want[columns].itertuples(index=False, name=None))


def test_every_operator_has_its_query():
    numbers = [int(re.match(r"op(\d+)_", n)[1]) for n in llm.queries()]
    assert sorted(numbers) == list(range(1, 14))
    entry = importlib.import_module("__spark_entry__")
    assert {*llm.queries(), "pipeline"} <= set(entry.queries())


def test_nothing_else_imports_this_subpackage():
    top = Path(corpus_pipeline.__file__).parent
    for path in [*top.glob("storesales/**/*.py"), *top.glob("tests/*.py"), top / "bench.py"]:
        if "llm" not in path.parts:
            assert "storesales.llm" not in path.read_text(), path
    assert "storesales" in sys.modules


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    good = corpus_pipeline.quality(spark, docs, DATA)
    scores = {r.doc_id: r.predicted for r in llm.queries()["op1_quality"](spark, DATA).collect()}
    assert {r.doc_id for r in good.collect()} == {i for i, p in scores.items() if p == 1}
    assert good.columns == docs.columns

    spoken = corpus_pipeline.language(spark, docs, DATA)
    table = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    judged = by_hand(table, table)
    assert {r.doc_id for r in spoken.collect()} == {
        i for i, j in judged.items() if j.lang != "und" and j.gain + corpus_pipeline.CERTAIN * j.error >= 0
    }

    rows = [(r.doc_id, r.text) for r in docs.collect()]
    last = {}
    for i, t in sorted(rows):
        last[t] = i
    single = corpus_pipeline.exact_copies(spark, docs, DATA)
    assert sorted(r.doc_id for r in single.collect()) == sorted(last.values())
    apart = corpus_pipeline.near_copies(spark, docs, DATA)
    assert sorted(r.doc_id for r in apart.collect()) == sorted(i for i, (_, c) in brute_force(rows).items() if i == c)
    assert apart.columns == docs.columns


def test_the_whole_pipeline_packs_what_its_stages_keep(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, DATA).toPandas(), docs.schema)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in docs.collect()}
    rows = corpus_pipeline.run(spark, DATA).toPandas()
    assert rows.groupby("doc_id").length.sum().to_dict() == want
    assert rows.groupby("sequence_id").length.sum().sort_index().iloc[:-1].eq(2048).all()
    assert 0 < len(want) < np.inf


def test_stages_handle_odd_documents(spark, docs, no_docs):
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, DATA).collect()
        assert stage(spark, no_docs, DATA).collect() == []


def test_texts_of_no_language_go_however_many_languages_there_are(spark):
    rng = random.Random(8)
    table = spark.read.parquet(f"{DATA}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    known = table.where("lang = 'en'").orderBy("doc_id").first().text.split()
    letters = list("".join(known[:200]))
    rng.shuffle(letters)
    def junk(trigrams):
        text = ""
        while len(text) < trigrams:
            text += " " + "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9)))
        return text

    go = {
        -1: junk(600),
        -2: "".join(c + " " * (i % 5 == 4) for i, c in enumerate(letters)),
        -3: "zzzz " * 50,
        -4: "12 - 34",
    }
    short = {-1000 - i: junk(40 + i) for i in range(50)}  # most of these, too, although little is known of them
    stay = {-10: " ".join(known[:4]), -11: "a", -12: " ".join(known[:60]) + " vkq xzj", -13: "qzx"}
    stay |= {-200 - i: " ".join(known[i : i + 10]) for i in range(0, 200, 10)}
    planted = spark.createDataFrame([(i, t, None, "s", len(t)) for i, t in (go | stay | short).items()], table.schema)
    more = spark.createDataFrame([(1_000_000 + i, t * 99, n, "s", 9) for i, (n, t) in enumerate(
        [("l1", "abra cadabra "), ("l2", "hokus pokus "), ("l3", "fidi bus ")])], table.schema)
    # A language of few texts is near to chance itself.
    for docs, most in ((table, 10), (table.unionByName(more), 20)):
        kept = {r.doc_id for r in corpus_pipeline.language(spark, docs.unionByName(planted), DATA).collect()}
        assert kept - set(short) == {r.doc_id for r in docs.collect()} | set(stay)
        assert len(kept & set(short)) <= most


def test_copies_go_row_by_row_whatever_their_ids(spark):
    def rows(stage, *texts):
        table = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
        found = stage(spark, table.repartition(3), DATA)
        assert found.columns == table.columns
        return sorted(((r.doc_id, r.text) for r in found.collect()), key=repr)

    def near(i, k=None):
        parts = [f"w{i}x{j}" for j in range(100)]
        return " ".join(parts if k is None else [*parts[:k], "changed", *parts[k + 1 :]])

    ends = sorted([(None, "b"), (1, "c"), (4, "a"), (4, "d"), (None, None)], key=repr)
    assert rows(corpus_pipeline.exact_copies, (3, "a"), (4, "a"), (4, "a"), (None, "a"), (None, "b"), (None, "b"), (1, "c"), (0, "d"), (4, "d"), (None, None), (None, None)) == ends
    assert rows(corpus_pipeline.exact_copies, (4, "a"), (5, "a"), (5, "c"), (4, "b")) == [(4, "b"), (5, "a"), (5, "c")]

    # Alone, linked to a row with an id, linked to each other, repeated, sharing an id with a linked winner, without words.
    assert rows(corpus_pipeline.near_copies, (None, near(0)), (2, near(1)), (None, near(1, 50)), (None, near(1))) == sorted([(None, near(0)), (2, near(1))], key=repr)
    found = rows(corpus_pipeline.near_copies, (None, near(2)), (None, near(2, 50)), (7, near(3)), (7, near(3)), (7, near(4)), (3, near(4, 9)), (5, near(5)), (5, near(5, 20)), (None, " "), (8, ""))
    assert [i for i, _ in found] == sorted([None, 7, 3, 5, None, 8], key=repr)
    assert (7, near(3)) in found and (3, near(4, 9)) in found

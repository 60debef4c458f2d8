import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from storesales.llm.exact_dedup import exact_dedup


def expected(tricky):
    groups = defaultdict(list)
    for i, t in tricky:
        groups[t or ""].append(i)
    out = []
    for i, t in tricky:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_groups_of_equal_texts(docs, tricky):
    assert sorted(map(tuple, exact_dedup(docs).collect()), key=repr) == expected(tricky)


def test_texts_that_share_a_digest_are_told_apart(docs, tricky):
    by_length = lambda text: F.length(text).cast("string")
    assert sorted(map(tuple, exact_dedup(docs, digest=by_length, salts=3).collect()), key=repr) == expected(tricky)


def test_no_python_in_the_plan(docs):
    plan = exact_dedup(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(no_docs):
    assert exact_dedup(no_docs).collect() == []

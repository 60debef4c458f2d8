import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that operators use themselves.
    "kept boolean, digest string, row long, sid long, token long, score double, label int, size long, ids binary"
)


@pytest.fixture(scope="session")
def words():
    rng = random.Random(5)
    return ["".join(rng.choice("abdeghilmnorstuy") for _ in range(rng.randint(2, 9))) for _ in range(400)]


@pytest.fixture(scope="session")
def tricky(words):
    """Ids and texts: empty ones, NULLs, repeated rows, a very long text, near copies, odd characters."""
    rng = random.Random(6)
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(30, 80))) for _ in range(12)]
    texts = [(i, t) for i, t in enumerate(base)]
    for i, t in enumerate(base[:6]):
        parts = t.split()
        for k in range(4):
            changed = parts.copy()
            changed[rng.randrange(len(parts))] = f"x{k}"
            texts.append((100 + 10 * i + k, " ".join(changed)))
    texts += [
        (200, None), (201, ""), (202, " \n\t "), (203, "one"), (204, "One"), (205, "one two three four"),
        (206, base[0]), (207, base[0].upper()), (208, base[0] + " "), (208, base[0] + " "), (None, base[1]), (None, None),
        (209, " ".join(rng.choice(words) for _ in range(60_000))),
        (210, "Zürich ß Ångström naïve 東京 🎉 <|endoftext|> it's ŉ İ Σ x\x1cy\x00z "),
        (211, "line one\nline two\n\n  \nline three | a | b"),
    ]
    return texts


@pytest.fixture
def docs(spark, tricky):
    rows = [(i, t, "en", "s", 0, True, "d", 1, 2, 3, 0.5, 1, 9, b"") for i, t in tricky]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)

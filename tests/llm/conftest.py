import random

import pytest

CLASHES = ["fp", "block", "term", "size", "n_tokens", "ids", "shard", "score", "lang_pred", "units", "bucket", "known"]


def make_docs(spark, rows):
    """doc_id, text, lang, source and a column for every name that operators use themselves."""
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in CLASHES)
    return spark.createDataFrame([(*r, *(["x"] * len(CLASHES))) for r in rows], schema)


def prose(rnd, n, words=("red fish swims under cold dark water while seven boats drift along quiet stone "
                         "harbour walls before morning light comes over hills and fields").split()):
    return " ".join(rnd.choice(words) + str(rnd.randrange(30)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    rnd = random.Random(5)
    base = prose(rnd, 60)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (2, base, "en", "a"), (3, base + " tail", "en", "b"),
        (4, None, "en", "a"), (5, "", None, None), (6, " \t\n", "de", "a"), (None, prose(rnd, 40), "en", None),
        (None, None, None, None), (7, prose(rnd, 30_000), "en", "a"), (8, "x" * 300_000, "en", "a"),
        (9, "12 34 !!", "en", "a"), (10, "ÄÖ ß 😀 ퟿ İΣΣ", "de", "c"), (-5, "One", "en", "a"),
    ]
    rows += [(20 + i, prose(rnd, rnd.randrange(5, 80)), rnd.choice(["en", "de"]), "h") for i in range(60)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return make_docs(spark, odd_rows).cache()


@pytest.fixture(scope="session")
def none(spark):
    return make_docs(spark, [])

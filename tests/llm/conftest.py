import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: columns that clash with names the operators add or use
EXTRA = ["key", "id", "score", "slot", "block", "n_words", "quality", "component_id", "_text", "template"]


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def make_rows():
    rng = random.Random(5)
    base = prose(rng, 120)
    texts = [base, base, base + " tail", prose(rng, 80), prose(rng, 3), "one", "", None, " \n\t ",
             prose(rng, 60) + "\n" + "Shared line of the house.\n" + prose(rng, 60), "x" * 5000,
             prose(rng, 30_000, 3000), "É à ü 漢字 " * 30, base.upper()]
    rows = [(i, t, "en", "a" if i % 3 else None, len(t) if t is not None else None) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, base, None, "b", 1), (None, None, None, None, None), (3, prose(rng, 50), "de", "b", 7)]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null, empty, long, tied and repeated rows, with extra columns of clashing names."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(make_rows(), SCHEMA)
    return df.select("*", *[F.lit(7).alias(c) for c in EXTRA]).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)

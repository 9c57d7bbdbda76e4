import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from medallion.llm.store import ship  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
LONG = " ".join(f"word{k % 977} Another{k % 13}" for k in range(20_000))
CLASHING = "id, class, value, n, key, words, lines, component, digest, at, host, label, score, kept, _text, _id"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").cache()


@pytest.fixture(scope="session")
def odd(spark):
    """Null ids, texts, languages and sources, empty and long texts, repeated rows, and columns
    with the names that operators use inside."""
    text = "the quick brown fox jumps over the lazy dog and runs away from it all day long " * 3
    rows = [
        (1, text, "en", "a"),
        (1, text, "en", "a"),
        (2, text, "en", None),
        (3, None, "en", "a"),
        (4, "", None, "a"),
        (5, " \n\t\n ", "en", "a"),
        (None, text + "more", "en", "a"),
        (None, None, None, None),
        (6, LONG, "en", "b"),
        (7, "one two", "en", "b"),
        (8, "1234 !! ??", "de", "b"),
        (9, "x" * 300_000, "de", "b"),
        (10, "äöü ß die der das und nicht aber doch ein eine " * 8, "de", "b"),
    ]
    names = [c.strip() for c in CLASHING.split(",")]
    extra = ", ".join(f"'x' as `{c}`" for c in names).split(", ")
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return frame.selectExpr("*", "length(text) as n_chars", *extra).cache()


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)


@pytest.fixture
def texts(spark):
    def make(*values):
        return spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")

    return make

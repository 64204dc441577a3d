import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from kilowatt.llm.shared import importable
    from kilowatt.session import local_session
    s = local_session(cpus="*", shuffle_partitions=8, app="kilowatt-tests")
    importable(s)
    return s


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated
    rows, and extra columns with names that the operators use themselves."""
    long = "Word another third " * 30_000
    rows = [(1, "Hello  World\tand more words", "en", "a", 5, "x"), (2, "hello world and more words", "en", "a", None, None),
            (3, None, None, None, None, None), (4, "", "en", "b", 0, "y"), (5, " \t\n", "en", "b", 3, "y"), (None, "no id here at all", "fr", None, 1, "z"),
            (6, long, "en", "b", len(long), "k"), (7, long, "en", "c", len(long), "k"), (8, "12345 678", None, "c", 9, "k"), (9, "one", "de", "c", 3, "k"),
            (9, "one", "de", "c", 3, "k"), (10, "Ünïcödé <|endoftext|> 中文 🙂", "de", "c", 3, "k"), (11, "hello World and more words", "en", "a", 5, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, size long, hash string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)

import os

import pytest

from skyledger.llm.common import Scratch

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

#: Columns of documents, and others with names that the operators use inside.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, key string, row int, "
    "shard string, nth int, text_key int, size double, copies int, score string"
)
WORDS = [f"w{i}" for i in range(400)]
PROSE = " ".join(WORDS[:60])
LONG = " ".join(WORDS[i * 7 % 400] + str(i % 997) for i in range(30_000))


def rows_of(*docs):
    return [(*d, *([None] * (13 - len(d)))) for d in docs]


EDGES = rows_of(
    (1, PROSE, "en", "a", 5),
    (1, PROSE, "en", "a", 5),
    (2, PROSE + " changed", "en", None, 5),
    (3, None, None, "b", None),
    (4, "", "de", "b", 0),
    (5, "", "de", "b", 0),
    (6, " \t\n ", "de", "b", 4),
    (None, PROSE, None, "a", None),
    (None, None, None, None, None),
    (7, LONG, "en", "c", 1),
    (8, "Zwölf Äpfel\n" * 40, "de", "c", 1),
    (9, "one", "en", "", 1),
    (10, " nbsp joined \U0001f600 42", "en", "a", 1),
)


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (2, 1, 1), (4, 0, 0), (7, 0, 1), (None, 1, 1), (8, None, None), (1, 0, 0)],
        "doc_id long, quality int, toxic int",
    )


@pytest.fixture
def scratch(spark):
    return Scratch(spark, "test")


def supplied(folder):
    return pytest.mark.skipif(not os.path.isdir(folder), reason="supplied tables not present")

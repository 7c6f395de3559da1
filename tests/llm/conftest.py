import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def texts(spark):
    """Documents of the smallest data set by id."""
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


LONG = " ".join(f"w{i % 977}" for i in range(30000))
#: Nulls, empty and long texts, ties, repeated rows and clashing column names.
HARD_ROWS = [
    (1, "a b c d e f g h i j k l m n o p", "x", "s", 5),
    (2, "a b c d e f g h i j k l m n o p", "x", "s", 5),
    (2, "a b c d e f g h i j k l m n o p", "x", "s", 5),
    (3, "A B c d e f g h i j k l m n o q", None, None, None),
    (4, None, None, None, None),
    (5, "", "x", "s", 0),
    (6, " \t\n\r\x0b\x0c ", "x", "s", 7),
    (7, "one two three", "x", "s", 13),
    (8, "One two  three", "x", "s", 14),
    (None, "a b c d e f g h i j k l m n o p", "x", "s", 5),
    (None, None, None, None, None),
    (9, LONG, "x", "s", len(LONG)),
    (10, LONG + " end", "x", "s", len(LONG) + 4),
    (11, " é 日本 🙂 x\x00y ▁ </turn> ### \\# *** | !!", "x", "s", 20),
]


@pytest.fixture(scope="session")
def hard(spark):
    """The hard rows with extra columns named like results and helpers."""
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    extra = ", n_words long, ids long, _id long, kept string, score string, block long, part long, rep long"
    rows = [(*row, 1, 2, 3, "k", "s", 4, 5, 6) for row in HARD_ROWS]
    return spark.createDataFrame(rows, columns + extra)


@pytest.fixture(scope="session")
def no_rows(hard):
    return hard.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(1, 1, 0), (3, 1, 0), (7, 0, 1), (9, 1, 0), (10, 1, 1), (11, 0, 1), (None, 1, 1), (2, None, None), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

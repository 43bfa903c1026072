import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from corpusweave.session import get_spark

    return get_spark("tests")


PROSE = [
    "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree tonight",
    "every morning the baker opens his small shop near the harbour and sells warm bread to passing sailors",
    "a long river winds between green hills before it reaches the wide grey sea far away in the west",
]


@pytest.fixture
def odd_documents(spark):
    """Nulls, empty and long texts, repeated rows and a column whose name an operator also makes."""
    rows = [
        (1, PROSE[0] * 3, "a", "x"),
        (2, None, "a", "x"),
        (3, "", None, None),
        (None, "no key here", "b", "x"),
        (4, " \t\n ", "b", "x"),
        (5, "ﬁne ½ é é \U0001f600 \x00 " * 4000, "b", "x"),
        (6, PROSE[1], "c", "x"),
        (6, PROSE[1], "c", "x"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, score string")

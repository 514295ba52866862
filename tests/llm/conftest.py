import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

LONG = " ".join(f"word{i % 977}" for i in range(60_000)) + "."

#: id, text, lang, source, n_chars and columns whose names the operators would like to use
UGLY = [
    (1, "One small text. It has two sentences.", "en", "a", 37, 0.5, 1, "x", None),
    (1, "One small text. It has two sentences.", "en", "a", 37, 0.5, 1, "x", None),
    (2, "", "en", "a", 0, None, None, None, [1]),
    (3, None, None, None, None, None, None, None, None),
    (None, "A text without an id. It stays.", "en", None, 3, 1.0, 2, "y", [2]),
    (4, " \n\t ", "de", "b", 4, 1.0, 2, "y", []),
    (5, LONG, "en", "a", len(LONG), 1.0, 2, "y", [3]),
    (6, LONG, "en", "b", len(LONG), 1.0, 2, "y", [3]),
    (7, "<|endoftext|>Ünïcode 日本 😀 it's 12\n\n\nthere  ", "fr", "b", 30, 1.0, 2, "y", [3]),
]
UGLY_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, copies int, decoded string, "
               "ids array<int>")


@pytest.fixture(scope="session")
def spark():
    from caseloom.session import clear_scratch, local_session

    session = local_session(8, app="tests")
    yield session
    clear_scratch(session)


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def ugly(spark):
    return spark.createDataFrame(UGLY, UGLY_SCHEMA)


@pytest.fixture(scope="session")
def texts(small):
    import pyarrow.parquet as pq

    return dict(zip(*pq.read_table(f"{small}/documents.parquet", columns=["doc_id", "text"]).to_pydict().values(), strict=True))

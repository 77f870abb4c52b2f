import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from certloom.session import get_session
    s = get_session("local[4]", shuffle_partitions=4, app_name="certloom-tests")
    yield s


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


PASSAGE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
ODD_TEXTS = [
    None, "", " \n\t ", "word", PASSAGE, PASSAGE, "x " + PASSAGE + " y", "ab " * 4000, "a" * 3000,
    "Ünï çødé 日本語 <|endoftext|> " * 30, "\n\nline\nline\n \nline", "same same same same same " * 20,
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns with clashing names."""
    rows = [(i, t, None, f"s{i}", -1, "a", "b", 7) for i, t in enumerate(ODD_TEXTS)]
    rows += [(3, "word", "en", None, None, None, None, None), (None, PASSAGE, None, None, None, None, None, None),
             (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, _k string, _row string, h int")


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)

import os

import pytest

from .helpers import LONG, SHARED

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def sf():
    path = f"{DATA}/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("driver test data not present")
    return path


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with nulls everywhere, empty and very long texts, copies, repeated rows and clashing names."""
    rows = [
        (1, "plain text with a few words in it", "en", "a", 33),
        (1, "plain text with a few words in it", "en", "a", 33),
        (2, "", "en", None, 0),
        (3, None, None, None, None),
        (None, "no id here but some words", "en", "b", 25),
        (None, None, None, None, None),
        (4, "   \n\t ", "en", "b", 6),
        (5, LONG, "en", "c", len(LONG)),
        (6, SHARED, "en", "c", len(SHARED)),
        (7, SHARED, "en", "c", len(SHARED)),
        (8, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" and more', "en", "d", 59),
        (9, "▁ mark, é, 漢字, \U0001f600 and <unk> <s> <0x0A>", "xx", "d", 1),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    # names that operators use inside
    for name in ("score", "fp", "words", "node", "component_id", "seed", "a", "b", "label", "toxic", "item", "pos"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, None), (None, 1, 1), (77, 0, 1), (6, 1, 1), (6, 1, 0)],
                                 "doc_id long, quality int, toxic int")

"""Fixtures shared by the tests of this folder."""

import pytest


@pytest.fixture
def odd_texts():
    """Null, empty, blank, short, repeated, accented, long and unbroken texts."""
    return [None, "", " ", "a", "ab", "Idiot, you!", "idiot, you!", "É é ﬁ", "É é ﬁ", "x" * 5000, "one two three four five six " * 400,
            "漢字😀 " * 30, "\x00\x1c\n\t", "word"]


@pytest.fixture
def odd_rows(spark, odd_texts):
    """The odd texts under rising ids, then a repeated row, a repeated id and null ids; extra columns clash."""
    rows = [(i, t, i, "z") for i, t in enumerate(odd_texts)]
    rows += [(3, "a", 0, None), (3, "other words", 0, None), (None, "no id", None, None), (None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, key long, block string")

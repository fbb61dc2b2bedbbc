"""Rows that every operator has to bear."""

import pytest


@pytest.fixture(scope="session")
def odd_rows():
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    return [
        (1, "one two three four five six seven\nline b is here\nline c is here too"),
        (2, None),
        (3, ""),
        (4, " \n\t "),
        (5, long),
        (6, long),
        (7, "一二三 naïve café 😀   end"),
        (7, "一二三 naïve café 😀   end"),
        (8, "12345 !!! ???"),
        (None, "a text without id that is long enough to have some words in it"),
        (None, None),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The rows with further columns whose names clash with results, in other case too."""
    rows = [(i, t, "en" if i != 3 else None, None, 5, "x", "y", "z", 9) for i, t in odd_rows]
    kind = "doc_id long, text string, lang string, source string, n_chars long, Text string, rk string, removed string, n_words long"
    return spark.createDataFrame(rows, kind)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("false")

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string, host string"


def words(seed, n, letters="abcdefghij"):
    g = random.Random(seed)
    return " ".join("".join(g.choices(letters, k=g.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, copies, and columns named like outputs."""
    base = words(1, 60)
    rows = [
        (1, base, "en", "a", 5, "x", "y", "z"),
        (2, base.replace(" ", "\n", 3), "en", "a", None, None, None, None),
        (2, base.replace(" ", "\n", 3), "en", "a", None, None, None, None),
        (None, base + "  ", None, None, None, None, None, None),
        (None, None, None, None, None, None, None, None),
        (4, "", "de", "b", 0, "", "", ""),
        (5, " \n\t ", "de", "", 0, "", "", ""),
        (6, words(2, 30_000), "en", "b", 1, "", "", ""),
        (7, "one two", "xx", "b", 1, "", "", ""),
        (8, " ".join([*base.split()[:-1], "changed"]), "en", "a", 1, "", "", ""),
        (9, "same same " * 3000, "en", "c", 1, "", "", ""),
        (10, "12345 !!! ???", "en", "c", 1, "", "", ""),
        (11, "𝔘𝔫𝔦 <|endoftext|> 🎉 \u00a0 é", "fr", "c", 1, "", "", ""),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)

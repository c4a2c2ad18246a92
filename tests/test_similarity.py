import math
import random
import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import edits as E
from tessera.functions import similarity as S
from tessera.functions.text import ascii_fold

from . import plain_edits as P

words = st.text(alphabet="abc 12", max_size=12)


def naive_lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(words, words)
def test_lcs_and_bounds(a, b):
    n = P.common_length(a, b)
    assert n == naive_lcs(a, b)
    indel = len(a) + len(b) - 2 * n
    assert levenshtein(a, b) <= indel <= 2 * levenshtein(a, b)


@settings(max_examples=200, deadline=None)
@given(words, words)
def test_properties(a, b):
    for f in (P.ratio, P.token_sort_ratio, P.token_set_ratio, P.partial_ratio):
        assert math.isclose(f(a, b), f(b, a))
        assert 0 <= f(a, b) <= 100
    assert P.ratio(a, a) == 100
    assert 0 <= S.jaro_winkler(a, b) <= 1
    assert P.partial_ratio(a, b) >= P.ratio(a, b) - 1e-9 or len(a) != len(b)


KINDS = [(E.ratios, P.ratio), (E.token_sort_ratios, P.token_sort_ratio), (E.token_set_ratios, P.token_set_ratio), (E.partial_ratios, P.partial_ratio)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(words, words), max_size=12))
def test_batches_against_single_pairs(pairs):
    for many, one in KINDS:
        got = many([a for a, _ in pairs], [b for _, b in pairs])
        assert np.allclose(got, [one(a, b) for a, b in pairs])


def test_batches_of_long_strings():
    """Strings of several words of 64 bits, of other alphabets, empty ones, and more pairs than a group."""
    g = random.Random(4)
    make = lambda: "".join(g.choice("ab é漢😀1") for _ in range(g.choice((0, 1, 5, 63, 64, 65, 128, 200))))
    pairs = [(make(), make()) for _ in range(300)]
    pairs += [(a, a[::-1]) for a, _ in pairs[:40]] + [(a, a) for a, _ in pairs[:20]]
    for many, one in KINDS:
        assert np.allclose(many([a for a, _ in pairs], [b for _, b in pairs]), [one(a, b) for a, b in pairs])
    assert all(len(many([], [])) == 0 for many, _ in KINDS)


def test_pairs_a_second():
    """All fifteen edit features of a pair of 8-word names and 16-word addresses take well under a millisecond."""
    g = random.Random(5)
    text = lambda n: [" ".join("".join(g.choices("abcdefghijklmnop", k=g.randint(2, 9))) for _ in range(n)) for _ in range(1000)]
    names, others, streets, more = text(8), text(8), text(16), text(16)
    began = time.perf_counter()
    for f in (E.ratios, E.token_set_ratios, E.token_sort_ratios, E.partial_ratios):
        for x, y in ((names, others), (names, others), (streets, more)):
            f(x, y)
    assert time.perf_counter() - began < 3


def test_examples(spark):
    assert P.token_set_ratio("new york mets", "new york mets vs braves") == 100
    assert P.partial_ratio("abc", "xxabcxx") == 100
    assert P.token_sort_ratio("b a", "a b") == 100
    assert abs(S.jaro_winkler("martha", "marhta") - 0.961111) < 1e-5
    assert S.jaro_winkler("", "") == 0
    rows = spark.createDataFrame([("ab", "ab"), ("ab", None), ("", "")], "a string, b string").select(S.indel_ratio("a", "b").alias("r")).collect()
    assert [r["r"] for r in rows] == [100.0, None, 100.0]


def test_sets(spark):
    df = spark.createDataFrame([("6885 35 st ste 3520", "688 35 st"), ("main st", "35")], "addr1 string, addr2 string")
    n = {k: F.col("addr1") if k.endswith("1") else F.col("addr2") for k in ("core1", "addr1", "skel1", "core2", "addr2", "skel2")}
    a, b = df.withColumns(S.set_features(n)).collect()
    assert (a["num_jacc"], a["num_first_eq"], a["num_n1"], a["num_n2"]) == (0.25, 0.0, 3, 2)
    assert (b["num_jacc"], b["num_first_eq"]) == (-1.0, -1.0)


def test_sql_names(spark):
    S.register(spark)
    got = spark.sql("SELECT indel_ratio('ab', 'ab') AS r, phonetic_skeleton('marketimg') AS k, phonetic_skeleton('12') AS n").first()
    assert (got["r"], got["k"], got["n"]) == (100, "nrktng", "")
    words_ = spark.createDataFrame([("Café ŒUVRE 12",), ("परफेक्ट",), ("Москва 한국 東京",), (None,), ("",)], "s string")
    assert [r[0] for r in words_.selectExpr("ascii_fold(s)").collect()] == [r[0] for r in words_.select(ascii_fold(F.col("s"))).collect()]

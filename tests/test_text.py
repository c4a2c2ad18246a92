import pytest
from pyspark.sql import functions as F

from tessera.functions import text as X


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "raw, want",
    [
        ("Acme Pvt. Ltd.", "acme private limited"),
        ("Moyna's Café LLC", "moynas cafe llc"),
        ("AT&T Inc", "at and t incorporated"),
        ("9876543210 Foo", "foo"),
        ("1st Bank 007", "1 bank 7"),
        ("St Mary Co", "saint mary company"),
        ("https://www.prudencegenesis.com", "prudencegenesis"),
        ("L.L.C.", "llc"),
        ("N°31", "ndeg31"),
        ("", ""),
        ("<NULL>", ""),
    ],
)
def test_name_tokens(spark, raw, want):
    assert " ".join(one(spark, raw, X.name_tokens)) == want


@pytest.mark.parametrize("raw, want", [("6885 35th Street, Suite 03520 <NULL>", "6885 35 st ste 3520"), ("N/A", ""), ("", ""), ("l'Hopital", "lhopital")])
def test_address_tokens(spark, raw, want):
    assert " ".join(one(spark, raw, X.address_tokens)) == want


@pytest.mark.parametrize("word, want", [("marketimg", "nrktng"), ("marketing", "nrktng"), ("private", "prwt"), ("praivet", "prwt"), ("123", ""), ("", "")])
def test_skeleton(spark, word, want):
    assert one(spark, word, X.skeleton) == want
    if word and not word.isdigit():
        assert X.skeleton_text(word) == want


@pytest.mark.parametrize("raw, want", [("परफेक्ट", "prphekt"), ("Straße Œuvre", "strasse oeuvre"), ("ÉCOLE", "ecole"), ("plain", "plain"), ("Ａ１", "a1"), ("Борис Щука", "boris shchuka"), ("Άλφα", "alpha"),
     ("תל אביב", "tl abyb"), ("شركة", "shrkt"), ("さいたま トヨタ", "saitama toyota"), ("서울", "seoul"), ("თბილისი", "tbilisi"), ("東京", "東京")])
def test_fold(spark, raw, want):
    assert one(spark, raw, X.ascii_fold) == want


def test_fold_of_every_korean_syllable(spark):
    """Computed from the code point, each is what its character's name spells."""
    every = [chr(c) for c in range(X.KOREAN_FROM, X.KOREAN_TO + 1)]
    got = spark.createDataFrame([(c,) for c in every], "c string").select("c", X.ascii_fold(F.col("c")).alias("f")).collect()
    assert {r["c"]: r["f"] for r in got} == {c: X.folded(c) for c in every}


def test_records_in_other_scripts_have_tokens(spark):
    assert one(spark, "ООО Ромашка", X.name_tokens) == ["ooo", "romashka"]


@pytest.mark.parametrize("t, want", [("03520", "3520"), ("35th", "35"), ("000", "0"), ("1st", "1"), ("abc", "abc"), ("x07", "x07")])
def test_number_token(spark, t, want):
    assert one(spark, t, X.number_token) == want
    assert one(spark, want, X.number_token) == want


def test_ngrams(spark):
    assert one(spark, "abab", lambda c: X.char_ngrams(c, 2)) == ["ab", "ba"]
    assert one(spark, "a", lambda c: X.char_ngrams(c, 2)) == []


def test_core_name(spark):
    core = lambda c: X.core_tokens(X.name_tokens(c), ~X.is_ascii(c))
    assert one(spark, "Acme Pvt. Ltd.", core) == ["acme"]
    assert one(spark, "AT&T Inc", core) == ["t"]

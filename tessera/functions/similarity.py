"""String similarities: set-based ones as Column expressions, edit-based ones as Arrow UDFs over whole batches.

The UDFs meet each distinct pair of strings once a batch; all edit features of a pair come from one of them. Scores run from 0
to 100, Jaro-Winkler's from 0 to 1.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from . import edits as E
from .text import DIGRAPHS, LETTERS_FROM, LETTERS_TO, tokens_of, whole_fold_table


def jaro_winkler(a: str, b: str, scale: float = 0.1) -> float:
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    used, mine = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                mine.append(c)
                break
    m = len(mine)
    if not m:
        return 0.0
    theirs = [c for c, u in zip(b, used, strict=True) if u]
    swaps = sum(x != y for x, y in zip(mine, theirs, strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * scale * (1 - jaro) if jaro > 0.7 else jaro


def _of_pairs(f: Callable[[list[str], list[str]], np.ndarray], a: pd.Series, b: pd.Series) -> np.ndarray:
    """``f`` of each distinct pair once, null where either string is null."""
    place: dict[tuple[str, str], int] = {}
    at = [-1 if x is None or y is None else place.setdefault((x, y), len(place)) for x, y in zip(a, b, strict=True)]
    found = np.append(f([x for x, _ in place], [y for _, y in place]), np.nan)
    return found[at]


def _udf(f: Callable[[list[str], list[str]], np.ndarray]):
    @F.pandas_udf(DoubleType())
    def scored(a: pd.Series, b: pd.Series) -> pd.Series:
        out = _of_pairs(f, a, b)
        return pd.Series(out).where(~np.isnan(out), None)

    return scored


def jaro_winklers(a: list[str], b: list[str]) -> np.ndarray:
    return np.array([jaro_winkler(x, y) for x, y in zip(a, b, strict=True)], float)


indel_ratio, token_set, token_sort, partial, jaro = (_udf(f) for f in (E.ratios, E.token_set_ratios, E.token_sort_ratios, E.partial_ratios, jaro_winklers))
SQL_FUNCTIONS = {"indel_ratio": indel_ratio, "token_set_ratio": token_set, "token_sort_ratio": token_sort, "partial_ratio": partial, "jaro_winkler": jaro}


def register(spark) -> None:
    """The similarities, the folding to ASCII and the phonetic skeleton by name for SQL text; the last is an SQL function."""
    for name, f in SQL_FUNCTIONS.items():
        spark.udf.register(name, f)
    folds = str.maketrans(whole_fold_table())

    @F.pandas_udf("string")
    def fold(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else t.translate(folds).lower())

    spark.udf.register("ascii_fold", fold)
    s = "t"
    for a, b in DIGRAPHS:
        s = f"replace({s}, '{a}', '{b}')"
    s = f"regexp_replace(translate(replace({s}, 'x', 'ks'), '{LETTERS_FROM}', '{LETTERS_TO}'), r'(.)\\1+', r'$1')"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION phonetic_skeleton(t STRING) RETURNS STRING RETURN CASE WHEN t RLIKE r'^\\d+$' THEN '' ELSE {s} END")


def jaccard(a: Column, b: Column) -> Column:
    """Of two token arrays; -1 if either is empty."""
    a, b = F.array_distinct(a), F.array_distinct(b)
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(-1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def numbers(s: Column) -> Column:
    return F.regexp_extract_all(s, F.lit(r"\b\d+\b"), F.lit(0))


def set_features(n: dict[str, Column]) -> dict[str, Column]:
    """The features of a pair that need no edit distance. ``n``: core1, addr1, skel1, core2, addr2, skel2."""
    x, y = numbers(n["addr1"]), numbers(n["addr2"])
    none = (F.size(x) == 0) | (F.size(y) == 0)
    return {
        "num_jacc": jaccard(x, y),
        "num_first_eq": F.when(none, F.lit(-1.0)).otherwise((F.get(x, F.lit(0)) == F.get(y, F.lit(0))).cast("double")),
        "num_n1": F.size(F.array_distinct(x)),
        "num_n2": F.size(F.array_distinct(y)),
        "addr_jacc": jaccard(tokens_of(n["addr1"]), tokens_of(n["addr2"])),
        "core_jacc": jaccard(tokens_of(n["core1"]), tokens_of(n["core2"])),
        "skel_jacc": jaccard(tokens_of(n["skel1"]), tokens_of(n["skel2"])),
        "core_len1": F.size(tokens_of(n["core1"])),
        "core_len2": F.size(tokens_of(n["core2"])),
        "addr_empty2": (n["addr2"] == "").cast("int"),
    }


#: The edit features, by name (fixed values).
EDIT = tuple(f"{f}_{k}" for f in ("name", "core", "addr") for k in ("ratio", "tset", "tsort", "partial")) + ("core_jw", "skel_tset", "core_nospace_ratio")
KINDS = {"ratio": E.ratios, "tset": E.token_set_ratios, "tsort": E.token_sort_ratios, "partial": E.partial_ratios, "jw": jaro_winklers}


@F.pandas_udf(StructType([StructField(c, DoubleType()) for c in EDIT]))
def _edit_struct(name1: pd.Series, core1: pd.Series, addr1: pd.Series, skel1: pd.Series, name2: pd.Series, core2: pd.Series, addr2: pd.Series, skel2: pd.Series) -> pd.DataFrame:
    sides = {"name": (name1, name2), "core": (core1, core2), "addr": (addr1, addr2), "skel": (skel1, skel2)}
    bare = tuple(x.str.replace(" ", "", regex=False) for x in sides["core"])
    out = {}
    for c in EDIT:
        field, _, kind = c.rpartition("_")
        out[c] = _of_pairs(KINDS[kind], *(bare if field == "core_nospace" else sides[field]))
    return pd.DataFrame(out)


def edit_struct(n: dict[str, Column]) -> Column:
    """All features of a pair that need an edit distance, as one struct with the fields ``EDIT``. ``n`` has name1, name2 besides."""
    return _edit_struct(*[n[f"{f}{i}"] for i in (1, 2) for f in ("name", "core", "addr", "skel")])

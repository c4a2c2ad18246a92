"""Candidate retrieval: IDF-weighted cosine over an inverted index that Catalyst sees as joins, sums and windows."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

QUERY = ("q_src", "q_id")
#: Countries are few; up to so many, their sizes travel by broadcast.
FEW_COUNTRIES = 10_000
#: Tokens in more entities of a country make no pairs (fixed value, the default).
CAP = 5000


def token_rows(records: DataFrame, tokens: Column | str = "tokens") -> DataFrame:
    """(src, id, country, token), one row a distinct token of a record."""
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    return records.select("src", "id", "country", F.explode(tokens).alias("token"))


def few(df: DataFrame, rows: int = FEW_COUNTRIES) -> DataFrame:
    """A broadcast of a table found to have at most so many rows; a larger one is left to be shuffled."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def entities_by_country(entities: DataFrame) -> DataFrame:
    return few(entities.groupBy("country").agg(F.count(F.lit(1)).alias("n")))


def inverse_frequencies(entity_tokens: DataFrame, n: DataFrame) -> DataFrame:
    """(country, token, df, n, idf) over the entities (source 1) of each country; ``n``: (country, n)."""
    df = entity_tokens.groupBy("country", "token").agg(F.count(F.lit(1)).alias("df"))
    return df.join(n, "country").withColumn("idf", F.log((F.col("n") + 1) / F.col("df")))


class Weights(NamedTuple):
    """Entities' tokens with unit-length weight ``ws``, queries' tokens with weight ``x``, and the queries' norms.

    A query's norm is divided out after its products are summed, so its tokens stay where the join on (country, token) has
    them.
    """

    index: DataFrame  # country, token, s1_id, df, ws
    asked: DataFrame  # country, token, q_src, q_id, df, x
    norms: DataFrame  # q_src, q_id, norm

    def unit(self) -> DataFrame:
        """The queries' tokens with unit-length weight ``wq``."""
        return self.asked.join(self.norms, list(QUERY)).withColumn("wq", F.col("x") / F.col("norm")).drop("x", "norm")


def weighted(records: DataFrame, tokens: Column | str = "tokens") -> Weights:
    """Tokens that no entity of the country has count in a query's norm with ln(n + 1). Queries of countries without entities
    have no row."""
    rows = token_rows(records, tokens)
    own = rows.where("src = 1")
    n = entities_by_country(records.where("src = 1"))
    idf = inverse_frequencies(own, n)
    norm = F.sqrt(F.sum(F.col("idf") * F.col("idf")).over(Window.partitionBy("id"))) + 1e-9
    index = own.join(idf, ["country", "token"]).withColumn("ws", F.col("idf") / norm)
    asked = rows.where("src in (2, 3)").join(n, "country").join(idf.drop("n"), ["country", "token"], "left")
    asked = asked.withColumn("x", F.coalesce("idf", F.log(F.col("n") + 1.0)))
    asked = asked.select("country", "token", F.col("src").alias("q_src"), F.col("id").alias("q_id"), "df", "x")
    norms = asked.groupBy(*QUERY).agg((F.sqrt(F.sum(F.col("x") * F.col("x"))) + 1e-9).alias("norm"))
    return Weights(index.select("country", "token", F.col("id").alias("s1_id"), "df", "ws"), asked, norms)


def scored_pairs(w: Weights, cap: int, rerank: bool = False) -> DataFrame:
    """(q_src, q_id, s1_id, bscore): pairs that share a token of at most ``cap`` entities, with their cosine.

    Capped tokens count in the norms only; with ``rerank`` they count in the score of pairs that other tokens have made.
    The products are shuffled once, by query: that serves the sums, the norms and the ranking after them.
    """
    key = [*QUERY, "s1_id"]
    usable = w.index.where(F.col("df") <= cap).drop("df").join(w.asked.where(F.col("df") <= cap).drop("df"), ["country", "token"])
    pairs = usable.repartition(*QUERY).groupBy(*key).agg(F.sum(F.col("x") * F.col("ws")).alias("bscore"))
    if rerank:
        common = w.asked.where(F.col("df") > cap).drop("df").join(pairs.select(*key), list(QUERY))
        more = common.join(w.index.where(F.col("df") > cap).drop("df"), ["country", "token", "s1_id"]).groupBy(*key).agg(F.sum(F.col("x") * F.col("ws")).alias("more"))
        pairs = pairs.join(more, key, "left").withColumn("bscore", F.col("bscore") + F.coalesce("more", F.lit(0.0))).drop("more")
    return pairs.join(w.norms, list(QUERY)).select(*key, F.round(F.col("bscore") / F.col("norm"), 6).alias("bscore"))


def top_k(pairs: DataFrame, k: int = 10, rel: float = 0.4) -> DataFrame:
    """The best ``k`` of each query with at least ``rel`` of its best score, ranked from 0, ties to the smaller entity."""
    by = Window.partitionBy(*QUERY)
    near = pairs.withColumn("best", F.max("bscore").over(by)).where(F.col("bscore") >= rel * F.col("best")).drop("best")
    rank = F.row_number().over(by.orderBy(F.desc("bscore"), "s1_id"))
    return near.withColumn("rn", rank).where(F.col("rn") <= k).withColumn("brank", F.col("rn") - 1).drop("rn")


def top_adaptive(pairs: DataFrame, queries: DataFrame, k: tuple[int, int, int] = (10, 20, 50), rel: float = 0.4, rel_hard: float = 0.3, ties: tuple[int, int] = (5, 10)) -> DataFrame:
    """:func:`top_k` whose k and cutoff vary with the query: more for near ties, non-ASCII names and empty addresses.

    ``queries``: (q_src, q_id, nonascii, addr_empty).
    """
    by = Window.partitionBy(*QUERY)
    near = pairs.withColumn("best", F.max("bscore").over(by)).where(F.col("bscore") >= min(rel, rel_hard) * F.col("best"))
    near = near.withColumn("ties", F.count_if(F.col("bscore") >= 0.9 * F.col("best")).over(by))
    near = near.withColumn("rn", F.row_number().over(by.orderBy(F.desc("bscore"), "s1_id"))).where(F.col("rn") <= max(k))
    near = near.join(queries, list(QUERY))
    very, some = F.col("addr_empty") | (F.col("ties") >= ties[1]), F.col("nonascii") | (F.col("ties") >= ties[0])
    near = near.withColumn("kq", F.when(very, k[2]).when(some, k[1]).otherwise(k[0])).withColumn("rq", F.when(very | some, rel_hard).otherwise(rel))
    kept = near.where((F.col("rn") <= F.col("kq")) & (F.col("bscore") >= (F.col("rq") - 1e-6) * F.col("best")))
    return kept.select(*QUERY, "s1_id", "bscore", (F.col("rn") - 1).alias("brank"))


def field_tokens(kind: str) -> Column:
    """The tokens of one single-field retriever."""
    core, number = F.col("name_core"), lambda t: t.rlike(r"^\d+$")
    if kind == "name":
        words, bare = T.tokens_of(core), F.replace(core, F.lit(" "), F.lit(""))
        whole = (F.size(words) >= 2) & ~number(bare) & (F.length(bare) >= 2)
        joined = F.when(whole, F.array(bare)).otherwise(F.array().cast("array<string>"))
        return F.array_distinct(F.concat(F.filter(words, lambda t: (F.length(t) >= 2) & ~number(t)), joined))
    if kind == "skel":
        return F.array_distinct(T.tokens_of(F.col("name_skel")))
    if kind == "addr":
        return F.array_distinct(F.filter(T.tokens_of(F.col("addr_norm")), lambda t: (F.length(t) >= 2) | number(t)))
    if kind == "num":
        return F.array_distinct(F.filter(T.tokens_of(F.col("addr_norm")), number))
    if kind in ("cng3", "cng4"):
        return T.char_ngrams(F.replace(core, F.lit(" "), F.lit("")), int(kind[-1]))
    raise ValueError(kind)


RETRIEVERS = ("name", "skel", "addr", "num", "cng3", "cng4")


def retrieve(records: DataFrame, kind: str | None = None, k: int = 10, rel: float = 0.4, cap: int = CAP, rerank: bool = False) -> DataFrame:
    """(q_src, q_id, s1_id, bscore, brank) of all tokens, or of one single-field retriever."""
    return top_k(scored_pairs(weighted(records, "tokens" if kind is None else field_tokens(kind)), cap, rerank), k, rel)


def query_signals(cands: DataFrame) -> DataFrame:
    """Candidates with their query's best score, near ties, count of scores of at least 0.4 of it, and relative score."""
    by = Window.partitionBy(*QUERY)
    out = cands.withColumn("best", F.max("bscore").over(by))
    out = out.withColumn("rel", F.col("bscore") / F.col("best"))
    return out.withColumn("ties", F.count_if(F.col("rel") >= 0.9).over(by)).withColumn("n04", F.count_if(F.col("rel") >= 0.4).over(by))

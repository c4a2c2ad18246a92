"""Candidate pairs to feature rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import EDIT, edit_struct, set_features
from .retrieval import QUERY, field_tokens, weighted

FIELDS = ("name_norm", "name_core", "addr_norm", "name_skel")
SHORT = {"name_norm": "name", "name_core": "core", "addr_norm": "addr", "name_skel": "skel"}
COSINE_FIELDS = ("name", "skel", "addr", "cng3", "num")
#: Feature names (fixed values).
SETS = ("num_jacc", "num_first_eq", "num_n1", "num_n2", "addr_jacc", "core_jacc", "skel_jacc", "core_len1", "core_len2", "addr_empty2")
CONTEXT = ("ctx_bscore", "ctx_brank", "ctx_gap_top1", "ctx_gap_second", "ctx_q_ncand", "ctx_s1_maxscore_gap", "ctx_s1_ncand", "ctx_s1_ntop")


def with_texts(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """Pairs with both sides' normalized texts: name1, core1, addr1, skel1 of the entity, name2 ... and nonascii2 of the query."""
    side = lambda n: [F.col(c).alias(f"{SHORT[c]}{n}") for c in FIELDS]
    entities = records.where("src = 1").select(F.col("id").alias("s1_id"), *side(1))
    queries = records.where("src in (2, 3)").select(F.col("src").alias("q_src"), F.col("id").alias("q_id"), F.col("nonascii").alias("nonascii2"), *side(2))
    return pairs.join(entities, "s1_id").join(queries, list(QUERY))


def _sides() -> dict[str, Column]:
    return {f"{s}{n}": F.col(f"{s}{n}") for s in SHORT.values() for n in (1, 2)}


def set_rows(texts: DataFrame) -> DataFrame:
    return texts.withColumns(set_features(_sides()))


def edit_rows(texts: DataFrame) -> DataFrame:
    got = texts.withColumn("__edits", edit_struct(_sides()))
    return got.select(*texts.columns, *[F.col("__edits")[c].alias(c) for c in EDIT])


def context(cands: DataFrame) -> DataFrame:
    """Candidates with what their query's and their entity's other candidates say. One shuffle by query, one by entity."""
    q, s = Window.partitionBy(*QUERY), Window.partitionBy("s1_id")
    first, second = (F.max(F.when(F.col("brank") == r, F.col("bscore"))).over(q) for r in (0, 1))
    return cands.select(
        "*",
        F.col("bscore").alias("ctx_bscore"),
        F.col("brank").cast("double").alias("ctx_brank"),
        F.round(first - F.col("bscore"), 6).alias("ctx_gap_top1"),
        F.round(F.col("bscore") - F.coalesce(second, F.lit(0.0)), 6).alias("ctx_gap_second"),
        F.count(F.lit(1)).over(q).alias("ctx_q_ncand"),
        F.round(F.max("bscore").over(s) - F.col("bscore"), 6).alias("ctx_s1_maxscore_gap"),
        F.count(F.lit(1)).over(s).alias("ctx_s1_ncand"),
        F.count_if(F.col("brank") == 0).over(s).alias("ctx_s1_ntop"),
    )


def field_cosines(pairs: DataFrame, records: DataFrame, fields: tuple[str, ...] = COSINE_FIELDS) -> DataFrame:
    """Pairs with ``ps_<field>``: the cosine of one field's tokens without cap, null where either side has none of them."""
    key = [*QUERY, "s1_id"]
    out = pairs.select(*key)
    for f in fields:
        w = weighted(records, field_tokens(f))
        own = pairs.select(*key)
        shared = own.join(w.unit().drop("df"), list(QUERY)).join(w.index.drop("df"), ["country", "token", "s1_id"]).groupBy(*key).agg(F.sum(F.col("wq") * F.col("ws")).alias("x"))
        counted = records.select("src", "id", (F.size(field_tokens(f)) > 0).alias("has")).where("has")
        left = counted.where("src = 1").select(F.col("id").alias("s1_id"), F.lit(True).alias("h1"))
        right = counted.where("src > 1").select(F.col("src").alias("q_src"), F.col("id").alias("q_id"), F.lit(True).alias("h2"))
        scored = own.join(left, "s1_id", "left").join(right, list(QUERY), "left").join(shared, key, "left")
        scored = scored.select(*key, F.when(F.col("h1") & F.col("h2"), F.round(F.coalesce("x", F.lit(0.0)), 6)).alias(f"ps_{f}"))
        out = out.join(scored, key)
    return out


def features(cands: DataFrame, records: DataFrame) -> DataFrame:
    """The full feature row of each candidate: context, sets and edit similarities; extra candidate columns come as ``cand_*``."""
    extra = [c for c in cands.columns if c not in (*QUERY, "s1_id", "bscore", "brank")]
    cands = cands.withColumnsRenamed({c: f"cand_{c}" for c in extra})
    rows = edit_rows(set_rows(with_texts(context(cands), records)))
    return rows.withColumn("q_src_f", F.col("q_src").cast("double")).withColumn("nonascii2", F.col("nonascii2").cast("int")).drop(*_sides())


def feature_names(rows: DataFrame, drop: tuple[str, ...] = ()) -> list[str]:
    return [c for c in rows.columns if c not in (*QUERY, "s1_id", "bscore", "brank", "label", "fold", "weight", *drop)]

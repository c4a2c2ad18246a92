"""Checks of result lists, as queries that find the violations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def list_violations(rows: DataFrame, required: DataFrame, valid_ids: DataFrame | None = None) -> DataFrame:
    """(rule, key) of each violation. ``rows``: (s1, ids), ids comma-separated, a null ids a row without its tab;
    ``required``: (s1); ``valid_ids``: (id), checked only if given."""
    good = rows.where("ids is not null")
    rule = lambda df, name, c: df.select(F.lit(name).alias("rule"), F.col(c).alias("key"))
    split = good.withColumn("a", F.when(F.trim("ids") == "", F.array().cast("array<string>")).otherwise(F.split("ids", ",")))
    each = split.select("s1", F.explode(F.array_distinct("a")).alias("id"))
    known = each.where("id rlike '^S[23]-'")
    out = [
        rule(rows.where("ids is null and trim(s1) <> ''"), "malformed_row", "s1"),
        rule(good.groupBy("s1").count().where("count > 1"), "duplicate_row", "s1"),
        rule(split.where(F.size("a") != F.size(F.array_distinct("a"))), "repeated_id", "s1"),
        rule(each.where("id like 'S1-%'").select("id").distinct(), "self_match", "id"),
        rule(each.where("id not rlike '^S[123]-'").select("id").distinct(), "wrong_prefix", "id"),
        rule(required.join(good, "s1", "left_anti"), "missing_s1", "s1"),
        rule(good.select("s1").distinct().join(required, "s1", "left_anti"), "unknown_s1", "s1"),
    ]
    if valid_ids is not None:
        out.append(rule(known.select("id").distinct().join(valid_ids, "id", "left_anti"), "unknown_id", "id"))
    all_rules = out[0]
    for x in out[1:]:
        all_rules = all_rules.unionByName(x)
    return all_rules


def not_candidates(matches: DataFrame, cands: DataFrame) -> DataFrame:
    """A warning, not an error: entities with a match that is no candidate. Both sides (s1, ids)."""
    each = lambda df: df.where("trim(ids) <> ''").select("s1", F.explode(F.split("ids", ",")).alias("id"))
    return each(matches).join(each(cands), ["s1", "id"], "left_anti").select(F.lit("not_candidate").alias("rule"), F.col("s1").alias("key")).distinct()

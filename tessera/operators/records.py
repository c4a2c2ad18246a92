"""Raw records to prepared records: (src, id, entity_id, country, name_*, addr_*, foreign, tokens)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

ORDER = ("src", "id", "entity_id", "country", "name_raw", "addr_raw", "name_norm", "name_core", "addr_norm", "name_skel", "nonascii", "tokens")


def block_tokens(core: Column, addr: Column, skel: Column) -> Column:
    """Distinct tokens by kind: ``n`` name words and the joined name, ``k`` skeletons, ``a`` address words and numbers."""
    number = lambda t: t.rlike(r"^\d+$")
    words = F.filter(T.tokens_of(core), lambda t: ~number(t))
    joined = F.when(F.size(words) >= 2, F.array(F.concat(F.lit("n|"), F.array_join(words, "")))).otherwise(F.array().cast("array<string>"))
    tag = lambda kind, a: F.transform(a, lambda t: F.concat(F.lit(f"{kind}|"), t))
    return F.array_distinct(
        F.concat(
            tag("n", F.filter(words, lambda t: F.length(t) >= 2)),
            joined,
            tag("k", T.tokens_of(skel)),
            tag("a", F.filter(T.tokens_of(addr), lambda t: (F.length(t) >= 2) | number(t))),
        )
    )


def parse_id(entity_id: Column) -> tuple[Column, Column]:
    """(source digit, number) of ``S<digit>-<number>``; null where the form is another."""
    form = r"^S(\d)-(\d+)$"
    digit, number = F.regexp_extract(entity_id, form, 1), F.regexp_extract(entity_id, form, 2)
    return F.try_to_number(digit, F.lit("9")).cast("byte"), F.when(number != "", number).try_cast("long")


def bad_ids(raw: DataFrame) -> DataFrame:
    """(entity_id, problem): ids that are malformed, do not rebuild to themselves, or occur more than once."""
    src, number = parse_id(F.col("entity_id"))
    rebuilt = F.concat(F.lit("S"), src, F.lit("-"), number)
    form = raw.where(F.coalesce(rebuilt != F.col("entity_id"), F.lit(True))).select("entity_id", F.lit("form").alias("problem"))
    twice = raw.groupBy("entity_id").count().where("count > 1").select("entity_id", F.lit("repeated").alias("problem"))
    return form.union(twice)


def normalized(raw: DataFrame) -> DataFrame:
    """Adds the normalized columns and the blocking tokens to (src, id, entity_id, country, name_raw, addr_raw)."""
    step = raw.withColumn("nonascii", ~T.is_ascii(F.col("name_raw"))).withColumn("__n", T.name_tokens(F.col("name_raw"))).withColumn("__a", T.address_tokens(F.col("addr_raw")))
    step = step.withColumn("__c", T.core_tokens(F.col("__n"), F.col("nonascii")))
    skeletons = F.filter(F.transform("__c", T.skeleton), lambda k: F.length(k) >= 2)
    step = step.select(
        "*",
        F.array_join("__n", " ").alias("name_norm"),
        F.array_join("__c", " ").alias("name_core"),
        F.array_join("__a", " ").alias("addr_norm"),
        F.array_join(skeletons, " ").alias("name_skel"),
    )
    return step.withColumn("tokens", block_tokens(F.col("name_core"), F.col("addr_norm"), F.col("name_skel"))).select(*ORDER)


def fold_of(number: Column) -> Column:
    """0..4 from a record's number by a multiplicative hash that cannot overflow."""
    return F.pmod(F.pmod(F.pmod(number, F.lit(1 << 32)) * F.lit(2654435761), F.lit(1 << 32)), F.lit(5)).cast("int")


def in_sample(number: Column, thousandths: int) -> Column:
    """A deterministic sample of records: so many of a thousand residues."""
    return F.pmod(F.pmod(number, F.lit(1000)) * F.lit(2654435761), F.lit(1000)) < thousandths

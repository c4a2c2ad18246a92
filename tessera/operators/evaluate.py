"""Metrics and diagnoses of candidates and matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import jaccard
from ..functions.text import tokens_of
from .retrieval import QUERY

PAIR = [*QUERY, "s1_id"]
KS = (1, 2, 3, 5, 10)
#: Causes of a miss, the first that holds (fixed values).
CAUSES = ("zero_overlap", "only_capped", "cutoff", "not_topk")


def per_entity(counted: DataFrame) -> DataFrame:
    """Adds precision, recall, f05 and f1 to rows with ntrue, npred, tp (null: 0). An entity without matches scores 1 if it
    has no prediction, else 0."""
    n = {c: F.coalesce(c, F.lit(0)).cast("double") for c in ("ntrue", "npred", "tp")}
    out = counted.withColumns(n)
    p, r = F.coalesce(F.try_divide("tp", "npred"), F.lit(0.0)), F.coalesce(F.try_divide("tp", "ntrue"), F.lit(0.0))
    alone = F.col("ntrue") == 0
    empty = (F.col("npred") == 0).cast("double")
    f05 = F.when(F.col("tp") > 0, F.try_divide(1.25 * p * r, 0.25 * p + r)).otherwise(0.0)
    f1 = F.when(F.col("tp") > 0, F.try_divide(2 * p * r, p + r)).otherwise(0.0)
    return out.withColumn("f05", F.when(alone, empty).otherwise(f05)).withColumn("f1", F.when(alone, empty).otherwise(f1))


def counted(entities: DataFrame, pred: DataFrame, truth: DataFrame) -> DataFrame:
    """(s1_id, other columns of entities, ntrue, npred, tp): predictions must be distinct."""
    hits = pred.select(*PAIR).join(truth.select(*PAIR).withColumn("hit", F.lit(1)), PAIR, "left")
    p = hits.groupBy("s1_id").agg(F.count(F.lit(1)).alias("npred"), F.count("hit").alias("tp"))
    t = truth.groupBy("s1_id").agg(F.count(F.lit(1)).alias("ntrue"))
    return entities.join(t, "s1_id", "left").join(p, "s1_id", "left")


def macro(per: DataFrame, *by: str) -> DataFrame:
    """The macro metrics over all rows of :func:`per_entity`, or by groups; grouping sets where ``by`` is named with rollup."""
    alone = F.col("ntrue") == 0
    many = lambda c: F.greatest(F.sum(c), F.lit(1.0))
    return per.groupBy(*by).agg(
        F.round(F.avg("f05"), 6).alias("macro_f05"),
        F.round(F.avg("f1"), 6).alias("macro_f1"),
        F.count(F.lit(1)).alias("n_s1"),
        F.round(F.sum("tp") / many("npred"), 6).alias("pair_precision"),
        F.round(F.sum("tp") / many("ntrue"), 6).alias("pair_recall"),
        F.coalesce(F.sum(F.col("npred") - F.col("tp")), F.lit(0.0)).cast("long").alias("false_merges"),
        F.round(F.avg(F.when(alone, (F.col("npred") == 0).cast("double"))), 6).alias("singleton_acc"),
        F.round(F.avg(F.when(~alone, F.col("f05"))), 6).alias("nonsingleton_f05"),
    )


def macro_f05(entities: DataFrame, pred: DataFrame, truth: DataFrame, *by: str) -> DataFrame:
    return macro(per_entity(counted(entities, pred, truth)), *by)


def ceiling(entities: DataFrame, cands: DataFrame, truth: DataFrame, *by: str) -> DataFrame:
    """The metrics of a perfect classifier over these candidates."""
    return macro_f05(entities, truth.join(cands.select(*PAIR), PAIR, "left_semi"), truth, *by)


def truth_ranks(cands: DataFrame, truth: DataFrame, missing: int = 99) -> DataFrame:
    return truth.join(cands.select(*PAIR, "brank"), PAIR, "left").withColumn("brank", F.coalesce("brank", F.lit(missing)))


def recall_at(ranks: DataFrame, *by: str, ks: tuple[int, ...] = KS) -> DataFrame:
    return ranks.groupBy(*by).agg(F.count(F.lit(1)).alias("n_true"), *[F.round(F.avg((F.col("brank") < k).cast("double")), 6).alias(f"recall_{k}") for k in ks])


def reduction(cands: DataFrame, records: DataFrame) -> DataFrame:
    """One row: pairs, pairs an entity, pairs a query, and the share of all possible pairs that was saved."""
    n = records.agg(F.count_if(F.col("src") == 1).alias("n1"), F.count_if(F.col("src") > 1).alias("nq"))
    return n.crossJoin(cands.agg(F.count(F.lit(1)).alias("pairs"))).select(
        "n1", "nq", "pairs", F.round(F.try_divide("pairs", "n1"), 6).alias("per_s1"), F.round(F.try_divide("pairs", "nq"), 6).alias("per_query"),
        F.round(1 - F.coalesce(F.try_divide("pairs", F.col("n1") * F.col("nq")), F.lit(0.0)), 9).alias("reduction"),
    )


def labelled(cands: DataFrame, truth: DataFrame) -> DataFrame:
    known = truth.select(*PAIR).withColumn("label", F.lit(1))
    return cands.join(known, PAIR, "left").withColumn("label", F.coalesce("label", F.lit(0)))


def missed(cands: DataFrame, truth: DataFrame) -> DataFrame:
    return truth.select(*PAIR).join(cands, PAIR, "left_anti")


def true_scores(pairs: DataFrame, index: DataFrame, asked: DataFrame, cap: int) -> DataFrame:
    """Listed pairs with n_shared, n_usable tokens and the usable tokens' cosine ``score``."""
    shared = pairs.select(*PAIR).join(asked.drop("df"), list(QUERY)).join(index, ["country", "token", "s1_id"])
    usable = F.col("df") <= cap
    got = shared.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("n_shared"), F.count_if(usable).alias("n_usable"), F.round(F.sum(F.when(usable, F.col("wq") * F.col("ws")).otherwise(0.0)), 6).alias("score"))
    out = pairs.select(*PAIR).join(got, PAIR, "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_shared", "n_usable")}).withColumn("score", F.coalesce("score", F.lit(0.0)))


def unlimited_rank(scored_true: DataFrame, all_pairs: DataFrame) -> DataFrame:
    """Adds ``rank``: the query's pairs that score above the true one, with k unlimited."""
    above = scored_true.join(all_pairs.select(*QUERY, F.col("bscore").alias("other")), list(QUERY)).where(F.col("other") > F.col("score") + 1e-6)
    return scored_true.join(above.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("rank")), PAIR, "left").withColumn("rank", F.coalesce("rank", F.lit(0)))


def miss_causes(scored_true: DataFrame, cands: DataFrame, rel: float) -> DataFrame:
    """Adds ``best`` of the query and the ``cause`` of the miss; the first that holds."""
    best = cands.where("brank = 0").select(*QUERY, F.col("bscore").alias("best"))
    out = scored_true.join(best, list(QUERY), "left").withColumn("best", F.coalesce("best", F.lit(0.0)))
    cut = F.col("score") < rel * F.col("best") - 1e-6
    return out.withColumn("cause", F.when(F.col("n_shared") == 0, "zero_overlap").when(F.col("n_usable") == 0, "only_capped").when(cut, "cutoff").otherwise("not_topk"))


def classifier_misses(best: DataFrame, cands: DataFrame, truth: DataFrame, t: float, margin: float) -> DataFrame:
    """True pairs among the candidates that are not assigned, with the reason."""
    found = truth.select(*PAIR).join(cands.select(*PAIR), PAIR, "left_semi").withColumnRenamed("s1_id", "true_id")
    rows = found.join(best, list(QUERY))
    why = F.when(F.col("s1_id") != F.col("true_id"), "lost_to_other_s1").when(F.col("p") < t, "below_threshold").when(F.round(F.col("p") - F.col("p2"), 9) < margin, "lost_on_margin")
    return rows.withColumn("reason", why).where("reason is not null").select(*QUERY, "true_id", "reason")


def slice_attributes() -> dict[str, Column]:
    """The attributes by which true pairs are sliced; a pair of texts without tokens on either side overlaps by 0."""
    overlap = lambda f: F.greatest(jaccard(tokens_of(F.col(f"{f}1")), tokens_of(F.col(f"{f}2"))), F.lit(0.0))
    name, addr, same = overlap("core"), overlap("addr"), F.col("name1") == F.col("name2")
    return {
        "nonascii": F.col("nonascii2"), "country": F.col("country"), "q_addr_empty": F.col("addr2") == "", "q_name_empty": F.col("core2") == "", "exact_name": same,
        "near_name": (name >= 0.5) & ~same, "weak_name_strong_addr": (name == 0) & (addr >= 0.5), "no_name_no_addr_overlap": (name == 0) & (addr < 0.5), "src": F.concat(F.lit("S"), F.col("q_src").cast("string")),
    }


def slices(rows: DataFrame, attributes: dict[str, Column] | None = None) -> DataFrame:
    """(attribute, value, pairs, share, recall, misses, and each cause's share of the misses) over every slice at once.

    ``rows`` are true pairs with the cause of their miss, null where they were found, and by default the texts of
    :func:`..pairs.with_texts` and the entity's country. All slices share a scan.
    """
    attributes = attributes or slice_attributes()
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("attribute"), v.cast("string").alias("value")) for k, v in attributes.items()]))
    part = lambda c: F.round(F.coalesce(F.try_divide(F.count_if(F.col("cause") == c), F.count("cause")), F.lit(0.0)), 6).alias(c)
    got = rows.select("cause", each.alias("s")).groupBy("s.attribute", "s.value").agg(
        F.count(F.lit(1)).alias("pairs"), F.round(F.avg(F.col("cause").isNull().cast("double")), 6).alias("recall"), F.count("cause").alias("misses"), *[part(c) for c in CAUSES]
    )
    # Every pair has one value of each attribute, so each attribute's pairs sum up to all of them.
    return got.withColumn("share", F.round(F.col("pairs") / F.sum("pairs").over(Window.partitionBy("attribute")), 6))


def summarize(per_fold: DataFrame, metric: str = "macro_f05") -> DataFrame:
    return per_fold.agg(F.round(F.avg(metric), 6).alias("mean"), F.round(F.stddev_pop(metric), 6).alias("std"), F.count(F.lit(1)).alias("folds"))


def simulate(superset: DataFrame, truth: DataFrame, queries: DataFrame, policies: list[tuple[str, int, float, int, float, int]]) -> DataFrame:
    """(policy, recall, pairs_per_query) of retrieval policies, over one generous candidate set.

    A policy is (name, k, rel, k_hard, rel_hard, ties): hard queries have at least ``ties`` near ties, a non-ASCII name or an
    empty address. ``queries``: (q_src, q_id, nonascii, addr_empty), all of them.
    """
    spark = superset.sparkSession
    by = Window.partitionBy(*QUERY)
    rows = labelled(superset, truth).withColumn("rel", F.col("bscore") / F.max("bscore").over(by))
    rows = rows.withColumn("ties", F.count_if(F.col("rel") >= 0.9).over(by)).join(queries, list(QUERY))
    rules = F.broadcast(spark.createDataFrame(policies, "policy string, k int, r double, kh int, rh double, tie int"))
    hard = F.col("nonascii") | F.col("addr_empty") | (F.col("ties") >= F.col("tie"))
    kept = rows.join(rules, (F.col("brank") < F.when(hard, F.col("kh")).otherwise(F.col("k"))) & (F.col("rel") >= F.when(hard, F.col("rh")).otherwise(F.col("r")) - 1e-6))
    got = kept.groupBy("policy").agg(F.sum("label").alias("hits"), F.count(F.lit(1)).alias("pairs"))
    n = truth.agg(F.count(F.lit(1)).alias("n_true")).crossJoin(queries.agg(F.count(F.lit(1)).alias("nq")))
    return got.crossJoin(n).select("policy", F.round(F.try_divide("hits", "n_true"), 6).alias("recall"), F.round(F.try_divide("pairs", "nq"), 6).alias("pairs_per_query"))


#: Tiers of queries by two conditions, and budgets for them (fixed values).
TIERS = {
    "A": ("ties >= 5 or nonascii", "addr_empty or ties >= 10"),
    "B": ("ties >= 3 or nonascii", "addr_empty or ties >= 8"),
    "C": ("ties >= 5 or nonascii or best < 0.3", "addr_empty or ties >= 10"),
    "D": ("ties >= 3 or nonascii or best < 0.3", "addr_empty or ties >= 5"),
}
BUDGETS = ((10, 20, 50, 0.3), (10, 15, 50, 0.3), (10, 20, 40, 0.3), (10, 25, 50, 0.3))


def simulate_tiers(superset: DataFrame, truth: DataFrame, queries: DataFrame, tiers: dict[str, tuple[str, str]] = TIERS, budgets=BUDGETS, rel: float = 0.4) -> DataFrame:
    """(policy, recall, pairs_per_query) for queries in three tiers (clear, ambiguous, very ambiguous by two conditions) with a
    k each; all policies are conditional sums of one pass."""
    by = Window.partitionBy(*QUERY)
    rows = labelled(superset, truth).withColumn("best", F.max("bscore").over(by)).withColumn("rel", F.col("bscore") / F.col("best"))
    rows = rows.withColumn("ties", F.count_if(F.col("rel") >= 0.9).over(by)).join(queries, list(QUERY))
    sums = []
    for name, (amb, very) in tiers.items():
        for k1, k2, k3, r in budgets:
            some, most = F.expr(amb), F.expr(very)
            kept = (F.col("brank") < F.when(most, k3).when(some, k2).otherwise(k1)) & (F.col("rel") >= F.when(most | some, r).otherwise(rel) - 1e-6)
            policy = F.lit(f"{name} {k1}/{k2}/{k3} r{r}")
            sums.append(F.struct(policy.alias("policy"), F.count_if(kept & (F.col("label") == 1)).alias("hits"), F.count_if(kept).alias("pairs")))
    got = rows.agg(F.array(*sums).alias("a")).select(F.explode("a").alias("x")).select("x.*")
    n = truth.agg(F.count(F.lit(1)).alias("n_true")).crossJoin(queries.agg(F.count(F.lit(1)).alias("nq")))
    return got.crossJoin(n).select("policy", F.round(F.try_divide("hits", "n_true"), 6).alias("recall"), F.round(F.try_divide("pairs", "nq"), 6).alias("pairs_per_query"))


def histogram(rows: DataFrame, value: str, edges: list[float]) -> DataFrame:
    """(bucket, n): counts between the edges, lower ones inclusive; -1 below the first, null values apart."""
    bucket = F.when(F.col(value) < edges[0], -1)
    for i, e in reversed(list(enumerate(edges))):
        bucket = bucket.when(F.col(value) >= e, i)
    return rows.withColumn("bucket", bucket).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


def coverage(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(field, missing, mean) of columns with nulls."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("x")) for c in columns]))
    return rows.select(each.alias("s")).groupBy("s.field").agg(F.round(F.avg(F.col("s.x").isNull().cast("double")), 6).alias("missing"), F.round(F.avg("s.x"), 5).alias("mean"))


def chosen(rows: DataFrame, n: int, *key: str, seed: int = 0) -> DataFrame:
    """``n`` rows without replacement, the same in every run: those whose key's digest is least."""
    return rows.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key])), *key).limit(n)

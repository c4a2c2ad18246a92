"""From scored pairs to at most one entity a query, and the search for the policy that decides."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .evaluate import macro_f05, per_entity
from .retrieval import QUERY


def best_per_query(scored: DataFrame) -> DataFrame:
    """(q_src, q_id, s1_id, p, p2): the best entity of each query and the runner-up's score, 0 if there is none."""
    by = Window.partitionBy(*QUERY).orderBy(F.desc("p"), "s1_id")
    two = scored.withColumn("rn", F.row_number().over(by)).where("rn <= 2")
    pick = lambda c, n: F.max(F.when(F.col("rn") == n, F.col(c)))
    return two.groupBy(*QUERY).agg(pick("s1_id", 1).alias("s1_id"), pick("p", 1).alias("p"), F.coalesce(pick("p", 2), F.lit(0.0)).alias("p2"))


def assign(best: DataFrame, t: float, margin: float = 0.0, t3: float | None = None) -> DataFrame:
    """Queries whose best entity scores at least ``t`` (``t3`` for source 3) and leads by ``margin``."""
    least = F.lit(t) if t3 is None else F.when(F.col("q_src") == 3, t3).otherwise(t)
    return best.where((F.col("p") >= least) & (F.round(F.col("p") - F.col("p2"), 9) >= margin))


def threshold_only(scored: DataFrame, t: float) -> DataFrame:
    return scored.where(F.col("p") >= t)


GRID = "t double, margin double, t3 double"


def policy_scores(best: DataFrame, truth: DataFrame, entities: DataFrame, grid: list[tuple[float, float]] | list[tuple[float, float, float | None]], t3: float | None = None) -> DataFrame:
    """(t, margin, t3, macro_f05, macro_f1) of every policy of the grid, from one pass over the best table.

    ``grid`` is a handful of constants (t, margin) or (t, margin, t3), so it multiplies the best table's rows by its length
    before they are summed. Only entities with a prediction meet the grid: one without scores 1 if it has no match, else 0.
    """
    spark = best.sparkSession
    policies = F.broadcast(spark.createDataFrame([(*g, t3) if len(g) == 2 else g for g in grid], GRID))
    own = entities.select("s1_id").join(truth.groupBy("s1_id").agg(F.count(F.lit(1)).alias("ntrue")), "s1_id", "left")
    n, single = own.agg(F.count(F.lit(1)), F.count_if(F.col("ntrue").isNull())).first()
    hits = best.join(truth.withColumn("hit", F.lit(1)), [*QUERY, "s1_id"], "left")
    least = F.when(F.col("q_src") == 3, F.coalesce("t3", "t")).otherwise(F.col("t"))
    kept = hits.join(policies, (F.col("p") >= least) & (F.round(F.col("p") - F.col("p2"), 9) >= F.col("margin")))
    pred = kept.groupBy("t", "margin", "t3", "s1_id").agg(F.count(F.lit(1)).alias("npred"), F.count("hit").alias("tp"))
    per = per_entity(pred.join(own, "s1_id")).groupBy("t", "margin", "t3").agg(F.sum("f05").alias("f05"), F.sum("f1").alias("f1"), F.count_if(F.col("ntrue") == 0).alias("lost"))
    same = [F.col(f"g.{c}").eqNullSafe(F.col(f"x.{c}")) for c in ("t", "margin", "t3")]
    out = policies.alias("g").join(per.alias("x"), same[0] & same[1] & same[2], "left")
    mean = lambda c: F.try_divide(F.coalesce(f"x.{c}", F.lit(0.0)) + F.lit(single) - F.coalesce("x.lost", F.lit(0)), F.lit(n))
    return out.select("g.t", "g.margin", "g.t3", mean("f05").alias("macro_f05"), mean("f1").alias("macro_f1"))


def _scores(best: DataFrame, truth: DataFrame, entities: DataFrame, grid: list) -> list[tuple]:
    """(macro_f05, policy) in the grid's order; a row a policy."""
    found = {(r["t"], r["margin"], r["t3"]): r["macro_f05"] or 0.0 for r in policy_scores(best, truth, entities, grid).collect()}
    return [(found[g], g) for g in dict.fromkeys((*g, None) if len(g) == 2 else tuple(g) for g in grid)]


# The grids of both searches.
COARSE = [(round(0.2 + 0.02 * i, 3), m) for i in range(31) for m in (0.0, 0.05, 0.1, 0.2)]
FINE_STEPS, FINE_MARGINS, FLAT, T3_STEPS = [round(-0.02 + 0.005 * i, 4) for i in range(9)], (0.0, 0.02, 0.05, 0.08, 0.1, 0.15), 0.05, [round(-0.1 + 0.02 * i, 3) for i in range(11)]
FIRST_COARSE, FIRST_STEPS, FIRST_MARGINS, FIRST_PLAIN = [round(0.05 * i, 2) for i in range(1, 19)] + [0.97], [round(-0.06 + 0.01 * i, 2) for i in range(12)], (0.0, 0.05, 0.1, 0.2), (0.3, 0.5, 0.7)


def best_of(scores: list[tuple]) -> tuple:
    """The best policy, ties to the lower threshold and the smaller margin."""
    return max(scores, key=lambda x: (round(x[0], 9), -x[1][0], -x[1][1]))


def search_policy(best: DataFrame, truth: DataFrame, entities: DataFrame) -> dict:
    """A coarse grid, then in one pass a finer one around its best, then in another its flatness and thresholds for source 3."""
    best = best.persist()
    try:
        f, (t, m, _) = best_of(_scores(best, truth, entities, COARSE))
        fine = [(round(t + d, 4), x) for d in FINE_STEPS for x in sorted({*FINE_MARGINS, m})]
        f, (t, m, _) = best_of([(f, (t, m, None)), *_scores(best, truth, entities, fine)])
        beside = [(round(t + d, 4), m, None) for d in (-FLAT, FLAT)]
        apart = [(t, m, round(t + d, 3)) for d in T3_STEPS]
        found = {g: x for x, g in _scores(best, truth, entities, [*beside, *apart])}
        f3, t3 = max(((found[g], -g[2]) for g in apart), default=(f, None))
        t3 = -t3 if f3 > f + 1e-5 else None
        return {"t": t, "margin": m, "t3": t3, "f05": max(f, f3) if t3 is not None else f, "flat": dict(zip((-FLAT, FLAT), (found[g] for g in beside), strict=True))}
    finally:
        best.unpersist()


def first_search(scored: DataFrame, truth: DataFrame, tune: DataFrame, holdout: DataFrame) -> dict:
    """The search of the first version: thresholds alone, then a grid around the best, beside thresholds without assignment.

    The frozen policy is scored on the held-out entities. ``search`` lists every policy tried with its score.
    """
    best = best_per_query(scored).persist()
    try:
        plain = _scores(best, truth, tune, [(t, 0.0) for t in FIRST_COARSE])
        t = best_of(plain)[1][0]
        near = [(round(min(0.99, max(0.01, t + d)), 2), m) for d in FIRST_STEPS for m in FIRST_MARGINS]
        tried = plain + _scores(best, truth, tune, near)
        f, (t, m, _) = best_of(tried)
        alone = {x: macro_f05(tune, threshold_only(scored, x).select(*QUERY, "s1_id"), truth).first()["macro_f05"] for x in FIRST_PLAIN}
        held = macro_f05(holdout, assign(best, t, m).select(*QUERY, "s1_id"), truth).first().asDict()
        return {"t": t, "margin": m, "f05": f, "holdout": held, "threshold_only": alone, "search": [{"t": g[0], "margin": g[1], "f05": x} for x, g in tried]}
    finally:
        best.unpersist()

"""The report on missed true pairs, and the record of an experiment."""

from __future__ import annotations

import subprocess
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.lists import markdown
from .evaluate import CAUSES, PAIR, classifier_misses, histogram, slices
from .learn import config_hash

# Edges of the report's histograms.
RANKS, CUTOFFS, SCORES = [10, 20, 50, 100], [0.0, 0.1, 0.2, 0.3, 0.4], [0.0, 0.1, 0.3, 0.4, 0.5, 0.6]
# The columns of the experiment log.
COLUMNS = (
    "exp_id parent change config_hash git_commit seed folds block_recall ceiling_f1 ceiling_f05 cand_per_s1 total_pairs f1_fold0 f1_fold1 f1_fold2 f1_mean f1_std f05_fold0 f05_fold1 f05_fold2 f05_mean"
    " f05_std precision recall singleton_acc t_block_s t_feat_s t_model_s peak_mem_gb model_params best_iter threshold margin decision notes timestamp"
).split()


def shares(rows: DataFrame, by: str, names: tuple[str, ...], total: int) -> DataFrame:
    """(by, pairs, share of these rows, share of all ``total`` pairs), a row for each name, also where there is none."""
    spark = rows.sparkSession
    order = F.broadcast(spark.createDataFrame(list(enumerate(names)), f"o int, {by} string"))
    got = order.join(rows.groupBy(by).agg(F.count(F.lit(1)).alias("n")), by, "left").withColumn("pairs", F.coalesce("n", F.lit(0)))
    own = rows.count()
    return got.orderBy("o").select(by, "pairs", F.round(F.col("pairs") / max(1, own), 3).alias("share"), F.round(F.col("pairs") / max(1, total), 4).alias("share_of_all"))


def bucketed(rows: DataFrame, value: str, edges: list[float]) -> DataFrame:
    """Counts between the edges as "low to high", the last one open."""
    label = F.element_at(F.array(*[F.lit(f"{a} to {b}") for a, b in zip(edges, [*edges[1:], "inf"], strict=True)]), F.col("bucket") + 1)
    return histogram(rows, value, edges).where("bucket >= 0").orderBy("bucket").select(label.alias(value), F.col("n").alias("pairs"))


def miss_report(title: str, truth: DataFrame, misses: DataFrame, pairs: DataFrame, best: DataFrame, scored: DataFrame, t: float, margin: float) -> str:
    """Markdown: causes of the misses, how far the missed were, slices, and what the classifier lost of the others.

    ``misses`` has the cause, score, best and unlimited rank of each missed true pair, ``pairs`` all true pairs with the cause
    (null: found), their texts and the entity's country; ``best`` and ``scored`` are as in :mod:`.assign`.
    """
    total, lost = truth.count(), misses.count()
    near = misses.where("cause = 'cutoff'").withColumn("ratio", F.col("score") / F.greatest("best", F.lit(1e-9)))
    gone = classifier_misses(best, scored, truth, t, margin)
    low = gone.where("reason = 'below_threshold'").join(best.select("q_src", "q_id", "p"), ["q_src", "q_id"])
    found = truth.join(scored.select(*PAIR), PAIR, "left_semi").count()
    reasons = ("lost_to_other_s1", "below_threshold", "lost_on_margin")
    return "\n".join([
        f"# {title}", "", f"True pairs: {total}; found among the candidates: {1 - lost / max(1, total):.4f}; missed: {lost}", "",
        markdown(shares(misses, "cause", CAUSES, total), "Causes of the misses"),
        markdown(bucketed(misses.where("cause = 'not_topk'"), "rank", RANKS), "Rank of the true entity where it is not among the best k"),
        markdown(bucketed(near, "ratio", CUTOFFS), "Score over the best score of misses by the cutoff"),
        markdown(slices(pairs).orderBy("attribute", "value"), "Slices: recall and mix of causes"),
        f"True pairs among the candidates: {found}; assigned: {1 - gone.count() / max(1, found):.4f}", "",
        markdown(shares(gone, "reason", reasons, total), f"Lost by the classifier at t={t}, margin={margin}"),
        markdown(bucketed(low, "p", SCORES), "Scores below the threshold"),
    ])


def experiment(row: dict, config: dict, parent: str = "", repository: str = ".") -> dict:
    """The log's row of an experiment: what was measured, its configuration's hash, the commit it ran on, and the time."""
    try:
        commit = subprocess.run(["git", "-C", repository, "rev-parse", "--short", "HEAD"], capture_output=True, text=True, check=True).stdout.strip()
    except (OSError, subprocess.CalledProcessError):
        commit = ""
    return {c: "" for c in COLUMNS} | {"parent": parent, "config_hash": config_hash(config), "git_commit": commit, "timestamp": time.strftime("%Y-%m-%d %H:%M")} | row

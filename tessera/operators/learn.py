"""Pair classifiers on Spark ML: gradient-boosted trees, out of fold, grouped by entity."""

from __future__ import annotations

import hashlib
import json

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import kept
from .pairs import feature_names
from .retrieval import QUERY

PARAMS = {"maxDepth": 6, "maxIter": 40, "stepSize": 0.1, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "minInstancesPerNode": 20, "seed": 7}


def assembled(rows: DataFrame, names: list[str]) -> DataFrame:
    """Adds ``features``; missing values are -1, as trees here have no branch for them."""
    rows = rows.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(-1.0)) for c in names})
    return VectorAssembler(inputCols=names, outputCol="features").transform(rows)


def share_of(salt: int, *key: str) -> Column:
    """0 to 0.9999 by the digest of a key, the same in any engine."""
    digest = F.substring(F.md5(F.concat_ws("|", F.lit(str(salt)), *[F.col(c).cast("string") for c in key])), 1, 8)
    return F.pmod(F.conv(digest, 16, 10).cast("long"), F.lit(10_000)) / 10_000.0


def sampled_training(rows: DataFrame, keep_entities: float = 1.0, keep_easy: float = 1.0, hard_rel: float = 0.6, seed: int = 0) -> DataFrame:
    """Training rows with ``weight``: whole entities by hash, all positives and hard negatives (rank 0 or near the query's
    best score over all its candidates), and a share of easy negatives that weighs for the rest."""
    rows = rows.withColumn("best", F.max("bscore").over(Window.partitionBy(*QUERY))).where(share_of(seed + 1, "s1_id") < keep_entities)
    hard = (F.col("label") == 1) | (F.col("brank") == 0) | (F.col("bscore") >= hard_rel * F.col("best"))
    rows = rows.withColumn("hard", hard).where(F.col("hard") | (share_of(seed + 2, *QUERY, "s1_id") < keep_easy))
    return rows.withColumn("weight", F.when(F.col("hard"), 1.0).otherwise(1.0 / keep_easy)).drop("hard", "best")


def train(rows: DataFrame, names: list[str], params: dict | None = None, validation: str | None = None):
    extra = {"validationIndicatorCol": validation} if validation else {}
    weight = {"weightCol": "weight"} if "weight" in rows.columns else {}
    return GBTClassifier(featuresCol="features", labelCol="label", **weight, **(PARAMS | (params or {})), **extra).fit(assembled(rows, names))


def score(rows: DataFrame, model, names: list[str]) -> DataFrame:
    out = model.transform(assembled(rows, names))
    return out.select(*QUERY, "s1_id", F.round(vector_to_array("probability")[1], 6).alias("p"))


def out_of_fold(rows: DataFrame, folds: tuple[int, ...] = (0, 1, 2, 3, 4), params: dict | None = None, drop: tuple[str, ...] = (), only: tuple[int, ...] | None = None) -> tuple[DataFrame, list]:
    """Scores of each fold's rows by a model that saw none of its entities, and (feature, importance) of the first model.

    ``rows`` has label and fold. With ``only``, models train on those folds alone, and entities of the others are scored by
    the model of their number modulo the models.
    """
    names = feature_names(rows, drop)
    rows = kept(rows)  # every fold reads it, and the scores outlive this call
    scored, importance = None, []
    use = only or folds
    for i, k in enumerate(use):
        model = train(rows.where(F.col("fold").isin(list(use)) & (F.col("fold") != k)), names, params)
        mine = F.col("fold") == k
        if only:
            mine = mine | (~F.col("fold").isin(list(use)) & (F.pmod("s1_id", F.lit(len(use))) == i))
        part = score(rows.where(mine), model, names)
        scored = part if scored is None else scored.unionByName(part)
        importance = importance or sorted(zip(names, model.featureImportances.toArray().tolist(), strict=True), key=lambda x: -x[1])
    return scored, importance


def kept_model(spark, path: str, make):
    """The model saved at ``path``, trained and saved first if there is none."""
    from ..sources.lists import exists

    if not exists(spark, f"{path}/metadata/_SUCCESS"):
        make().write().overwrite().save(path)
    return GBTClassificationModel.load(path)


def config_hash(config: dict) -> str:
    return hashlib.sha1(json.dumps(config, sort_keys=True).encode()).hexdigest()[:10]

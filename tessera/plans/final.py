"""The whole linkage as one resumable run: prepare, retrieve, train, choose the policy, link, write, validate.

Each step's table is made once; a run that was broken off goes on behind its last whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assign as A
from ..operators import evaluate as E
from ..operators import learn as L
from ..operators import pairs as P
from ..operators import records as R
from ..operators import retrieval as C
from ..operators.validate import list_violations, not_candidates
from ..sources import lists
from ..sources.layout import Layout

TUNE, HOLDOUT = (0, 1, 2), (3, 4)


def prepare(spark: SparkSession, at: Layout, split: str) -> DataFrame:
    def make() -> DataFrame:
        raw = [lists.raw_records(lists.read_tsv(spark, at.source(split, s)), s) for s in (1, 2, 3)]
        whole = raw[0].unionByName(raw[1]).unionByName(raw[2])
        if bad := R.bad_ids(whole).limit(5).collect():
            raise ValueError(f"ids that cannot be used: {[tuple(b) for b in bad]}")
        return R.normalized(whole)

    return lists.resumable(spark, at.table(split, "records"), make, ("country",)).withColumn("src", F.col("src").cast("byte"))


def feature_table(spark: SparkSession, at: Layout, split: str, records: DataFrame, **how) -> tuple[DataFrame, DataFrame]:
    cands = lists.resumable(spark, at.table(split, "candidates"), lambda: C.retrieve(records, **how))
    return cands, lists.resumable(spark, at.table(split, "features"), lambda: P.features(cands, records))


def evaluate(best: DataFrame, truth: DataFrame, entities: DataFrame, policy: dict) -> dict:
    """Metrics of the held-out folds, and the most that these candidates allow is left to :func:`..operators.evaluate.ceiling`."""
    pred = A.assign(best, policy["t"], policy["margin"], policy["t3"])
    return E.macro_f05(entities.where(F.col("fold").isin(*HOLDOUT)), pred, truth).first().asDict()


def by_country(best: DataFrame, truth: DataFrame, entities: DataFrame) -> dict[str, dict]:
    """The policy tuned for each country by itself. The countries are few by nature and come as a list."""
    out = {}
    for r in entities.select("country").distinct().orderBy("country").toLocalIterator():
        own = entities.where(F.col("country") == r["country"]).select("s1_id")
        out[r["country"]] = A.search_policy(best.join(own, "s1_id", "left_semi"), truth.join(own, "s1_id", "left_semi"), own)
    return out


def run(spark: SparkSession, at: Layout, params: dict | None = None, **how) -> dict:
    """Returns the policy, its held-out metrics and the violations found in the written lists (none is the rule)."""
    records = prepare(spark, at, "train")
    truth = lists.resumable(spark, at.table("train", "truth"), lambda: lists.must_exist(lists.truth_pairs(lists.read_tsv(spark, at.truth(), _truth_schema())), records))
    entities = records.where("src = 1").select(F.col("id").alias("s1_id"), "country", R.fold_of(F.col("id")).alias("fold"))
    _, feats = feature_table(spark, at, "train", records, **how)
    rows = E.labelled(feats, truth).join(entities.select("s1_id", "fold"), "s1_id")
    scored = lists.resumable(spark, at.table("train", "scores"), lambda: L.out_of_fold(rows, params=params)[0])
    best = A.best_per_query(scored)
    tune = entities.where(F.col("fold").isin(*TUNE))
    policy = A.search_policy(best.join(tune.select("s1_id"), "s1_id", "left_semi"), truth, tune)
    report = evaluate(best, truth, entities, policy)
    names = P.feature_names(rows)
    model = L.kept_model(spark, at.table("model"), lambda: L.train(rows, names, params))
    lists.write_json(spark, at.table("policy.json"), policy | {"features": names})

    test = prepare(spark, at, "test")
    cands, feats = feature_table(spark, at, "test", test, **how)
    if P.feature_names(feats) != names:
        raise ValueError("the features of the test split differ from the model's")
    matched = A.assign(A.best_per_query(L.score(feats, model, names)), policy["t"], policy["margin"], policy["t3"])
    own = test.where("src = 1").select(F.col("id").alias("s1_id"))
    lists.write_list_file(lists.id_lists(matched, own), at.output("matching_results.tsv"))
    lists.write_list_file(lists.id_lists(cands, own, "candidate_entity_ids"), at.output("candidate_pairs.tsv"))

    written = [lists.read_lists(spark, at.output(n)) for n in ("matching_results.tsv", "candidate_pairs.tsv")]
    required = own.select(F.concat(F.lit("S1-"), F.col("s1_id").cast("string")).alias("s1"))
    valid = test.where("src > 1").select(F.col("entity_id").alias("id"))
    found = list_violations(written[0], required, valid).unionByName(list_violations(written[1], required, valid)).unionByName(not_candidates(*written))
    summary = {"policy": policy, "holdout": report, "violations": [tuple(r) for r in found.limit(100).collect()], "config": L.config_hash({"params": params, "how": how})}
    lists.write_json(spark, at.output("run.json"), summary)
    return summary


def _truth_schema():
    from pyspark.sql import types as T

    return T.StructType([T.StructField(c, T.StringType()) for c in ("source1_entity_id", "matched_entity_ids")])

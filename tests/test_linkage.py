import math

import pytest
from pyspark.sql import functions as F

from tessera.operators import assign as A
from tessera.operators import evaluate as E
from tessera.operators import learn as L
from tessera.operators import pairs as P
from tessera.operators import records as R
from tessera.operators import report
from tessera.operators import retrieval as C
from tessera.operators.validate import list_violations, not_candidates
from tessera.sources import lists
from tessera.streaming.linking import link, link_stream

RAW = "src byte, id long, entity_id string, country string, name_raw string, addr_raw string"
PEOPLE = [
    (1, 1, "S1-1", "US", "Acme Rockets Inc", "12 Main Street"),
    (1, 2, "S1-2", "US", "Blue Ocean Foods", "7 Hill Road"),
    (1, 3, "S1-3", "IN", "Acme Rockets", "12 Main Street"),
    (2, 1, "S2-1", "US", "ACME Rockets", "12 Main St"),
    (3, 1, "S3-1", "US", "Blue Ocean", "7 Hill Rd"),
    (3, 2, "S3-2", "FR", "Acme Rockets", "12 Main St"),
    (2, 2, "S2-2", "US", "", ""),
]


@pytest.fixture(scope="module")
def people(spark):
    return R.normalized(spark.createDataFrame(PEOPLE, RAW)).cache()


def test_block_tokens(people):
    got = {r["entity_id"]: set(r["tokens"]) for r in people.collect()}
    assert {"n|acme", "n|rockets", "n|acmerockets", "a|12", "a|mn", "a|st"} <= got["S1-1"]
    assert got["S2-2"] == set()


def test_retrieval_stays_in_country(people):
    got = {(r["q_src"], r["q_id"], r["s1_id"], r["brank"]) for r in C.retrieve(people).collect()}
    assert (2, 1, 1, 0) in got and (3, 1, 2, 0) in got
    assert not any((s, q) == (3, 2) for s, q, _, _ in got)
    assert not any(e == 3 for _, _, e, _ in got)


def test_idf(people):
    entities = people.where("src = 1")
    idf = {(r["country"], r["token"]): r["idf"] for r in C.inverse_frequencies(C.token_rows(people).where("src = 1"), C.entities_by_country(entities)).collect()}
    assert math.isclose(idf["US", "n|acme"], math.log(3)) and math.isclose(idf["IN", "n|acme"], math.log(2))


def test_rerank_only_adds(people):
    w = C.weighted(people)
    low = {tuple(r)[:3]: r["bscore"] for r in C.scored_pairs(w, 1).collect()}
    high = {tuple(r)[:3]: r["bscore"] for r in C.scored_pairs(w, 1, rerank=True).collect()}
    assert low.keys() == high.keys() and all(high[k] >= low[k] for k in low)


def test_ranks_are_gapless_and_order_free(people):
    once = sorted(map(tuple, C.retrieve(people).collect()))
    again = sorted(map(tuple, C.retrieve(people.repartition(3, "id")).collect()))
    assert once == again
    by = {}
    for s, q, _, _, rank in once:
        by.setdefault((s, q), []).append(rank)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


SCORES = "q_src int, q_id long, s1_id long, p double"


@pytest.mark.parametrize(
    "scores, t, margin, t3, want",
    [
        ([(2, 1, 1, 0.9), (2, 1, 2, 0.5)], 0.6, 0.2, None, [1]),
        ([(2, 1, 1, 0.7), (2, 1, 2, 0.6)], 0.6, 0.2, None, []),
        ([(2, 1, 1, 0.55)], 0.6, 0.2, None, []),
        ([(2, 1, 1, 0.15)], 0.1, 0.2, None, []),
        ([(3, 1, 1, 0.65)], 0.6, 0.0, 0.7, []),
    ],
)
def test_assign(spark, scores, t, margin, t3, want):
    best = A.best_per_query(spark.createDataFrame(scores, SCORES))
    assert [r["s1_id"] for r in A.assign(best, t, margin, t3).collect()] == want


def test_metric_examples(spark):
    truth = spark.createDataFrame([(2, 47, 0), (3, 812, 0)], "q_src int, q_id long, s1_id long")
    pred = spark.createDataFrame([(2, 47, 0), (2, 193, 0), (3, 812, 0)], truth.schema)
    both = spark.createDataFrame([(0,), (1,)], "s1_id long")
    m = E.macro_f05(both, pred, truth).first()
    assert abs(m["macro_f05"] - (0.7142857 + 1) / 2) < 1e-5 and m["false_merges"] == 1
    wrong = pred.withColumn("s1_id", F.lit(1).cast("long"))
    assert E.macro_f05(both.where("s1_id = 1"), wrong, truth).first()["macro_f05"] == 0.0
    assert E.macro_f05(both.where("s1_id = 0"), pred.limit(0), truth).first()["macro_f05"] == 0.0


def test_policy_search(spark):
    scored = spark.createDataFrame([(2, i, i, 0.5 + 0.04 * i) for i in range(10)], SCORES)
    truth = scored.where("p > 0.7").select("q_src", "q_id", "s1_id")
    entities = scored.select("s1_id")
    got = A.search_policy(A.best_per_query(scored), truth, entities)
    assert got["f05"] == 1.0 and 0.65 < got["t"] <= 0.75


def test_policies_against_single_runs(spark):
    """Every policy's score from one pass equals the metric of its own assignment, entities without a prediction included."""
    import random

    g = random.Random(3)
    scored = spark.createDataFrame([(g.choice((2, 3)), q, g.randrange(25), round(g.random(), 3)) for q in range(120) for _ in range(2)], SCORES).dropDuplicates(["q_src", "q_id", "s1_id"])
    truth = scored.where("q_id % 3 = 0").groupBy("q_src", "q_id").agg(F.max("s1_id").alias("s1_id"))
    entities, best = spark.range(30).toDF("s1_id"), A.best_per_query(scored).cache()
    grid = [(0.3, 0.0, None), (0.5, 0.1, None), (0.5, 0.1, 0.9), (1.1, 0.0, None)]
    got = {(r["t"], r["margin"], r["t3"]): (r["macro_f05"], r["macro_f1"]) for r in A.policy_scores(best, truth, entities, grid).collect()}
    for t, m, t3 in grid:
        want = E.macro_f05(entities, A.assign(best, t, m, t3), truth).first()
        assert got[t, m, t3] == pytest.approx((want["macro_f05"], want["macro_f1"]), abs=1e-6)
    first = A.first_search(scored, truth, entities.where("s1_id < 20"), entities.where("s1_id >= 20"))
    assert first["f05"] == max(x["f05"] for x in first["search"]) and 19 < len(first["search"]) <= 19 + 48 and first["holdout"]["n_s1"] == 10 and set(first["threshold_only"]) == {0.3, 0.5, 0.7}


def test_truth_must_exist(spark, people):
    truth = spark.createDataFrame([(2, 1, 1), (3, 1, 2)], "q_src int, q_id long, s1_id long")
    assert lists.must_exist(truth, people).count() == 2
    with pytest.raises(ValueError, match="S1-77"):
        lists.must_exist(truth.union(spark.createDataFrame([(2, 1, 77)], truth.schema)), people)


def test_miss_report(spark, people):
    recs = people
    truth = spark.createDataFrame([(2, 1, 1), (3, 1, 2), (2, 2, 1)], "q_src int, q_id long, s1_id long")
    w = C.weighted(recs)
    every = C.scored_pairs(w, 50)
    cands = C.top_k(every)
    trues = E.true_scores(truth, w.index, w.unit(), 50)
    misses = E.unlimited_rank(E.miss_causes(trues.join(cands, E.PAIR, "left_anti"), cands, 0.4), every)
    country = recs.where("src = 1").select(F.col("id").alias("s1_id"), "country")
    pairs = P.with_texts(truth, recs).join(country, "s1_id").join(misses.select(*E.PAIR, "cause"), E.PAIR, "left")
    scored = cands.select(*E.PAIR, F.col("bscore").alias("p"))
    text = report.miss_report("Test", truth, misses, pairs, A.best_per_query(scored), scored, 0.99, 0.0)
    assert "missed: 1" in text and "| zero_overlap | 1 | 1.0 | 0.3333 |" in text and "| q_name_empty | true | 1 | 0.0 | 1 | 1.0 | 0.0 | 0.0 | 0.0 | 0.333333 |" in text and "| below_threshold | 1 |" in text


def test_ids(spark):
    raw = spark.createDataFrame([("S1-10",), ("S1-007",), ("bad",), ("S2-5",), ("S2-5",)], "entity_id string")
    assert {tuple(r) for r in R.bad_ids(raw).collect()} == {("S1-007", "form"), ("bad", "form"), ("S2-5", "repeated")}


def test_validator(spark):
    rows = [("S1-1", "S2-1,S3-1"), ("S1-2", ""), ("S1-3", "S2-1,S2-1"), ("S1-4", "S1-9"), ("S1-5", "Q-1"), ("S1-6", "S2-77"), ("S1-7", None), ("S1-1", "S2-1"), ("S1-99", "S2-1")]
    df = spark.createDataFrame(rows, "s1 string, ids string")
    need = spark.createDataFrame([(f"S1-{i}",) for i in range(1, 9)], "s1 string")
    valid = spark.createDataFrame([("S2-1",), ("S3-1",)], "id string")
    got = {tuple(r) for r in list_violations(df, need, valid).collect()}
    assert got == {("malformed_row", "S1-7"), ("duplicate_row", "S1-1"), ("repeated_id", "S1-3"), ("self_match", "S1-9"), ("wrong_prefix", "Q-1"), ("missing_s1", "S1-7"), ("missing_s1", "S1-8"), ("unknown_s1", "S1-99"), ("unknown_id", "S2-77")}
    assert list_violations(spark.createDataFrame([("S1-1", "")], df.schema), need.limit(1)).isEmpty()
    assert {r["key"] for r in not_candidates(df.where("s1 = 'S1-1'"), spark.createDataFrame([("S1-1", "S2-1")], df.schema)).collect()} == {"S1-1"}


def test_files(spark, tmp_path):
    raw = tmp_path / "a.tsv"
    raw.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\tA "quoted\\ name\t\tUS\n', encoding="utf-8")
    assert [tuple(r) for r in lists.read_tsv(spark, str(raw)).collect()] == [("S1-1", 'A "quoted\\ name', "", "US")]
    pairs = spark.createDataFrame([(3, 5, 1), (2, 9, 1), (2, 9, 1)], "q_src int, q_id long, s1_id long")
    out = str(tmp_path / "out")
    lists.write_lists(lists.id_lists(pairs, spark.createDataFrame([(1,), (2,)], "s1_id long")), out)
    assert {tuple(r) for r in lists.read_lists(spark, out).collect()} == {("S1-1", "S2-9,S3-5"), ("S1-2", "")}
    assert lists.header_of(spark, out) == "ok" and lists.header_of(spark, str(tmp_path / "none")) == "missing"
    lists.write_json(spark, str(tmp_path / "p.json"), {"t": 0.5})
    assert lists.read_json(spark, str(tmp_path / "p.json")) == {"t": 0.5}
    calls = []
    make = lambda: calls.append(1) or spark.range(3).toDF("id")
    for _ in range(2):
        assert lists.resumable(spark, str(tmp_path / "t"), make).count() == 3
    assert calls == [1]
    seen = []
    new = lambda df: seen.append(df.count()) or df.withColumn("x", F.col("id") * 2)
    for n in (3, 5, 5):
        assert lists.top_up(spark, str(tmp_path / "u"), spark.range(n), ["id"], new).count() == n
    assert seen == [3, 2]
    lists.append_log(spark, str(tmp_path / "log"), {"a": 1}, ["a", "b"])
    lists.append_log(spark, str(tmp_path / "log"), {"b": 2}, ["a", "b"])
    lists.append_log(spark, str(tmp_path / "log"), report.experiment({"a": 'x, "y"'}, {"k": 1}) | {"b": None}, ["a", "b", "config_hash", "timestamp"][:2])
    assert (tmp_path / "log").read_text() == 'a,b\n1,\n,2\n"x, ""y""",\n'
    row = report.experiment({"exp_id": "E1"}, {"k": 1}, parent="E0")
    assert list(row) == report.COLUMNS and len(row) == 36 and row["timestamp"] and row["config_hash"] and row["parent"] == "E0"
    one = tmp_path / "one.tsv"
    lists.write_list_file(lists.id_lists(pairs, spark.range(1, 40).toDF("s1_id")).repartition(5), str(one))
    lines = one.read_text().split("\n")
    assert lines[:3] == ["source1_entity_id\tmatched_entity_ids", "S1-1\tS2-9,S3-5", "S1-2\t"] and len(lines) == 41 and lines[-1] == "" and not (tmp_path / "one.tsv.parts").exists()
    assert "| id |" in lists.markdown(spark.range(1).toDF("id"), "t")


def test_stream_equals_batch(spark, people, tmp_path):
    cols = people.columns
    people.where("src > 1").write.parquet(str(tmp_path / "in"))
    arriving = spark.readStream.schema(people.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = link_stream(people.where("src = 1"), arriving.select(*cols), str(tmp_path / "out"), str(tmp_path / "ck"), t=0.3, margin=0.0)
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, link(people, t=0.3, margin=0.0).collect()))


def test_learning(spark):
    rows = spark.range(400).select(
        F.lit(2).alias("q_src"), F.col("id").alias("q_id"), (F.col("id") % 80).alias("s1_id"), (F.rand(1)).alias("bscore"), F.lit(0).alias("brank"),
        (F.col("id") % 2).cast("double").alias("x"), F.rand(2).alias("noise"), (F.col("id") % 2).cast("int").alias("label"), (F.col("id") % 80 % 5).cast("int").alias("fold"),
    )
    scored, importance = L.out_of_fold(rows, params={"maxDepth": 2, "maxIter": 2, "minInstancesPerNode": 1})
    got = {r["q_id"]: r["p"] for r in scored.collect()}
    assert len(got) == 400 and all((p > 0.5) == (q % 2 == 1) for q, p in got.items())
    assert importance[0][0] == "x"
    kept = L.sampled_training(rows.withColumn("brank", F.lit(5)), keep_easy=0.5, hard_rel=2.0)
    assert kept.where("label = 1").count() == 200 and 50 < kept.where("label = 0").count() < 150
    assert L.config_hash({"a": 1, "b": 2}) == L.config_hash({"b": 2, "a": 1})

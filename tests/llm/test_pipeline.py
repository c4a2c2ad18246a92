import re

import corpus_pipeline as P
from tessera.llm.exact_dedup import exact_dedup
from tessera.llm.mixing import mix_by_source
from tessera.llm.near_dedup import near_duplicates

from ..conftest import SMALL
from .test_near_dedup import brute


def test_stages(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mixing", "packing"]
    kept = P.language_id(spark, docs, SMALL)
    assert kept.columns == docs.columns and kept.where("text rlike '[a-z]'").count() == docs.where("text rlike '[a-z]'").count()
    exact = P.exact(spark, docs, SMALL)
    assert exact.count() == docs.selectExpr("regexp_replace(text, '[ \\t-\\r]', '') t").distinct().count()
    assert exact_dedup(exact).where("group_size > 1").count() == 0
    near = P.near(spark, docs, SMALL)
    assert near.columns == docs.columns and near.count() == near_duplicates(docs).where("kept").count()
    mixed = P.mixing(spark, docs, SMALL)
    assert mixed.columns == docs.columns and mixed.groupBy("doc_id").count().where("count > 2").count() == 0
    for f in (P.language_id, P.exact, P.near, P.mixing):
        assert f(spark, no_docs, SMALL).count() == 0
        assert f(spark, odd_docs, SMALL).columns == odd_docs.columns
    assert P.packing(spark, no_docs, SMALL).count() == 0


def test_stages_on_odd_rows(spark, odd_docs):
    """What stays of nulls, empty and very long texts, ties, repeats and columns named like outputs, stage by stage."""
    rows = lambda df: sorted(map(repr, df.collect()))
    every = odd_docs.collect()
    said = {repr(r) for r in P.language_id(spark, odd_docs, SMALL).collect()}
    assert said <= set(map(repr, every)) and not any(repr(r) in said for r in every if not any(c.isalpha() for c in r["text"] or ""))

    groups = {}
    for r in every:
        groups.setdefault("".join(re.split(r"[\x20\x09-\x0D]", r["text"] or "")), []).append(r)
    best = [min(g, key=lambda r: (-len(r["text"] or ""), r["doc_id"] is None, r["doc_id"] or 0)) for g in groups.values()]
    exact = P.exact(spark, odd_docs, SMALL)
    assert rows(exact) == sorted(map(repr, best))

    _, classes = brute(every)
    near = P.near(spark, odd_docs, SMALL)
    assert near.count() == len(classes) and set(rows(near)) <= set(map(repr, every))
    ids = {r["doc_id"] for r in near.collect()}
    assert all(min(int(i) for i in c if i != "None") in ids for c in classes if c != ["None"])

    mixed = P.mixing(spark, odd_docs, SMALL).collect()
    copies = {r["doc_id"]: r["copies"] for r in mix_by_source(odd_docs.select("doc_id", "source", "text")).collect() if r["size"]}
    assert not any(not (r["text"] or "").split() for r in mixed)
    for i, n in copies.items():
        assert sum(r["doc_id"] == i for r in mixed) == n * sum(r["doc_id"] == i and bool((r["text"] or "").split()) for r in every)

    packed = P.packing(spark, odd_docs, SMALL).collect()
    whole = sorted(((r["sequence_id"], r["offset"], r["length"]) for r in packed))
    assert [a * 1024 + b for a, b, _ in whole] == [sum(n for *_, n in whole[:k]) for k in range(len(whole))] and {r["doc_id"] for r in packed} == {r["doc_id"] for r in every}


def test_run(spark):
    got = P.run(spark, SMALL).collect()
    full = {}
    for r in got:
        full[r["sequence_id"]] = full.get(r["sequence_id"], 0) + r["length"]
    assert got and all(n == 1024 for k, n in full.items() if k < max(full))

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm.exact_dedup import SQL, exact_dedup, filter_pages, hit, op5_exact_dedup, page_of, slots_for

from ..conftest import SMALL


def test_against_sql(spark, same):
    same(op5_exact_dedup(spark, SMALL), SQL)


@pytest.mark.parametrize("slots", [1 << 10, 1 << 25, 2])
def test_odd_rows_at_any_filter_size(odd_docs, slots):
    got = exact_dedup(odd_docs, max_slots=slots).collect()
    rows = odd_docs.collect()
    assert len(got) == len(rows)
    groups = {}
    for r in rows:
        n = re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "")
        groups.setdefault(hashlib.sha256(n.encode()).hexdigest(), []).append(r)
    for sha, members in groups.items():
        mine = [r for r in got if r["text_sha256"] == sha]
        best = min(members, key=lambda r: (-len(r["text"] or ""), r["doc_id"] is None, r["doc_id"] or 0))
        assert {r["keep_id"] for r in mine} == {best["doc_id"]}
        assert [r["kept"] for r in mine].count(True) == 1 and all(r["group_size"] == len(members) for r in mine)
        assert next(r for r in mine if r["kept"])["doc_id"] == best["doc_id"]
    assert "size" in got[0].asDict() and isinstance(got[0]["kept"], bool)


def test_empty_and_hot(spark, no_docs):
    assert exact_dedup(no_docs).count() == 0
    hot = spark.range(3000).selectExpr("id doc_id", "case when id % 3 = 0 then 'a b' else cast(id as string) end text")
    got = exact_dedup(hot)
    assert got.where("kept").count() == 2001
    assert got.where("group_size = 1000 and keep_id = 0").count() == 1000


def test_few_unique_rows_move(spark):
    """At 16 slots a row under 1 % of the rows without a twin go to the exact step; the filter tells no twin to be alone."""
    rows = spark.range(40_000).selectExpr("id", "pmod(xxhash64(id), 1L << 20) slot")
    twice = rows.groupBy("slot").count().where("count > 1").select("slot")
    pages = filter_pages(twice)
    met = rows.join(F.broadcast(pages), page_of("slot") == F.col("page"), "left").select("slot", hit("slot", "words").alias("hit"))
    assert met.where("hit").count() == rows.join(twice, "slot").count() > 500
    docs = spark.range(40_000).selectExpr("id doc_id", "cast(id as string) text")
    plan = exact_dedup(docs)
    assert slots_for(40_000) == 1 << 20 and plan.where("group_size > 1").count() == 0
    both = docs.select(F.expr("sha2(text, 256)").alias("sha")).selectExpr("pmod(xxhash64(sha), 1L << 20) a", "pmod(xxhash64(1, sha), 1L << 20) b")
    one, two = (both.groupBy(c).count().where("count > 1").select(c) for c in "ab")
    assert both.join(one, "a").join(two, "b").count() < 400


def test_python_free(spark):
    plan = op5_exact_dedup(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))

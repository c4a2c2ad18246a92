"""The registered queries over the driver's tables, each beside its SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import similarity as S
from ..functions import text as X
from ..operators import assign as A
from ..operators import evaluate as E
from ..operators import learn as L
from ..operators import pairs as P
from ..operators import records as R
from ..operators import retrieval as C
from ..operators.retrieval import QUERY
from ..operators.validate import list_violations, not_candidates
from ..sources import lists as files
from ..sources.lists import id_lists
from ..sources.shared import kept, scratch
from . import sql as Z
from .views import CAP, K, REL, candidates, documents, entities, numbered_records, planted_truth, raw_records, records, scored, table, truth

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
PAIR = [*QUERY, "s1_id"]
T0, MARGIN = 0.3, 0.05


def plain(df: DataFrame) -> DataFrame:
    """Integers as long and floats as double, as SQL has them."""
    wide = {T.ByteType: "long", T.ShortType: "long", T.IntegerType: "long", T.FloatType: "double"}
    return df.select(*[F.col(f.name).cast(wide[type(f.dataType)]).alias(f.name) if type(f.dataType) in wide else F.col(f.name) for f in df.schema.fields])


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL if there is one."""

    def register(f):
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(f(spark, sf_dir))

        QUERIES[f.__name__] = run
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return run

    return register


def joined(a) -> F.Column:
    return F.array_join(a, " ")


# --- scans and normalization


@query(f"WITH {Z.CANDS} SELECT q_src, q_id, s1_id, bscore, brank FROM cand")
def block_topk(spark, d):
    """The flagship: documents to records to the best candidates of each query."""
    return candidates(spark, d)


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def scan_project(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 49 AND l_returnflag = 'R'")
def filter_pushdown(spark, d):
    return table(spark, d, "lineitem").where("l_quantity >= 49 and l_returnflag = 'R'").select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT count(*) AS n FROM lineitem")
def row_count(spark, d):
    return table(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {Z.DOCS} SELECT entity_id, CAST(substr(entity_id, 2, 1) AS BIGINT) AS src, CAST(substr(entity_id, 4) AS BIGINT) AS number, true AS same FROM raw")
def id_parse_roundtrip(spark, d):
    src, number = R.parse_id(F.col("entity_id"))
    raw = raw_records(spark, d)
    return raw.select("entity_id", src.alias("src"), number.alias("number"), (F.concat(F.lit("S"), src, F.lit("-"), number) == F.col("entity_id")).alias("same"))


SPOILT = "SELECT entity_id FROM raw UNION ALL SELECT replace(entity_id, '-', '-0') FROM raw WHERE id % 50 = 1 UNION ALL SELECT 'X' || entity_id FROM raw WHERE id % 50 = 2 UNION ALL SELECT entity_id FROM raw WHERE id % 70 = 3"


@query(f"WITH {Z.DOCS}, sp AS ({SPOILT}) SELECT entity_id, 'form' AS problem FROM sp WHERE NOT regexp_full_match(entity_id, 'S\\d-(0|[1-9]\\d*)') UNION ALL SELECT entity_id, 'repeated' FROM sp GROUP BY entity_id HAVING count(*) > 1")
def id_problems(spark, d):
    """Ids that cannot be used, among the records' own and planted ones."""
    raw = raw_records(spark, d).select("id", "entity_id")
    parts = [raw.select("entity_id"), *[raw.where(w).select(F.expr(e).alias("entity_id")) for w, e in (("id % 50 = 1", "replace(entity_id, '-', '-0')"), ("id % 50 = 2", "'X' || entity_id"), ("id % 70 = 3", "entity_id"))]]
    return R.bad_ids(parts[0].union(parts[1]).union(parts[2]).union(parts[3]))


@query(f"SELECT doc_id, {Z.fold('text')} AS folded FROM documents")
def ascii_folding(spark, d):
    return table(spark, d, "documents").select("doc_id", X.ascii_fold(F.col("text")).alias("folded"))


NULLISH = "CASE doc_id % 4 WHEN 0 THEN 'n/a ' WHEN 1 THEN '<NULL> ' WHEN 2 THEN 'nullify None ' ELSE '' END || text"


@query(f"SELECT doc_id, {Z.blank(NULLISH)} AS blanked FROM documents")
def null_blank(spark, d):
    mark = F.expr("CASE doc_id % 4 WHEN 0 THEN 'n/a ' WHEN 1 THEN '<NULL> ' WHEN 2 THEN 'nullify None ' ELSE '' END")
    return table(spark, d, "documents").select("doc_id", X.blank_nulls(F.concat(mark, F.col("text"))).alias("blanked"))


@query(f"SELECT page_id, {Z.site('url')} AS label FROM pages")
def domain_extract(spark, d):
    return table(spark, d, "pages").select("page_id", X.site_label(F.col("url")).alias("label"))


@query(f"WITH {Z.DOCS} SELECT src, id, array_to_string({Z.name_words('name_raw')}, ' ') AS tokens FROM raw")
def name_tokens(spark, d):
    return raw_records(spark, d).select("src", "id", joined(X.name_tokens(F.col("name_raw"))).alias("tokens"))


@query(f"WITH {Z.DOCS} SELECT src, id, array_to_string({Z.addr_words('addr_raw')}, ' ') AS tokens FROM raw")
def addr_tokens(spark, d):
    return raw_records(spark, d).select("src", "id", joined(X.address_tokens(F.col("addr_raw"))).alias("tokens"))


STREET = "lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || CASE l_linenumber % 4 WHEN 0 THEN 'th' WHEN 1 THEN '' WHEN 2 THEN 'st' ELSE 'x' END"


@query(f"SELECT t AS token, {Z.number('t')} AS canonical FROM (SELECT DISTINCT {STREET} AS t FROM lineitem)")
def num_token(spark, d):
    t = F.expr(STREET.replace("VARCHAR", "STRING"))
    return table(spark, d, "lineitem").select(t.alias("token")).distinct().select("token", X.number_token(F.col("token")).alias("canonical"))


@query(f"SELECT DISTINCT t AS token, {Z.skeleton('t')} AS skeleton FROM (SELECT unnest(regexp_split_to_array({Z.fold('text')}, '[^a-z0-9]+')) AS t FROM documents) WHERE t <> ''")
def skeleton(spark, d):
    words = table(spark, d, "documents").select(F.explode(F.split(X.ascii_fold(F.col("text")), "[^a-z0-9]+")).alias("token")).where("token <> ''").distinct()
    return words.select("token", X.skeleton(F.col("token")).alias("skeleton"))


@query(f"WITH {Z.RECORDS} SELECT src, id, name_core, nonascii FROM rec")
def core_name(spark, d):
    return records(spark, d).select("src", "id", "name_core", "nonascii")


@query(f"WITH {Z.RECORDS} SELECT src, id, entity_id, country, name_norm, name_core, addr_norm, name_skel, nonascii FROM rec")
def prepared_records(spark, d):
    return records(spark, d).select("src", "id", "entity_id", "country", "name_norm", "name_core", "addr_norm", "name_skel", "nonascii")


@query(f"WITH {Z.RECORDS} SELECT src, id, array_to_string(list_sort({Z.TOKENS}), ' ') AS tokens FROM rec")
def block_tokens(spark, d):
    return records(spark, d).select("src", "id", joined(F.array_sort("tokens")).alias("tokens"))


@query(f"WITH {Z.RECORDS} SELECT src, id, array_to_string(list_sort({Z.FIELD['cng3']}), ' ') AS g3, array_to_string(list_sort({Z.FIELD['cng4']}), ' ') AS g4 FROM rec")
def char_ngrams(spark, d):
    return records(spark, d).select("src", "id", joined(F.array_sort(C.field_tokens("cng3"))).alias("g3"), joined(F.array_sort(C.field_tokens("cng4"))).alias("g4"))


# --- retrieval


@query(f"WITH {Z.RECORDS}, {Z.weights()} SELECT country, token, df, n, round(idf, 6) AS idf FROM idf")
def doc_freq_idf(spark, d):
    recs = records(spark, d)
    found = C.inverse_frequencies(C.token_rows(recs).where("src = 1"), C.entities_by_country(recs.where("src = 1")))
    return found.select("country", "token", "df", "n", F.round("idf", 6).alias("idf"))


@query(f"WITH {Z.RECORDS}, {Z.weights()} SELECT q_src, q_id, token, round(wq, 6) AS w FROM qw")
def token_norms(spark, d):
    return C.weighted(records(spark, d)).unit().select("q_src", "q_id", "token", F.round("wq", 6).alias("w"))


@query(f"WITH {Z.RECORDS}, {Z.weights()} SELECT q_src, q_id, CAST(coalesce(sum(CASE WHEN df <= {CAP} THEN df END), 0) AS BIGINT) AS cost FROM qw GROUP BY ALL")
def query_cost(spark, d):
    asked = C.weighted(records(spark, d)).asked
    return asked.groupBy(*QUERY).agg(F.coalesce(F.sum(F.when(F.col("df") <= CAP, F.col("df"))), F.lit(0)).alias("cost"))


@query(f"WITH {Z.DOCS} SELECT src, id FROM raw WHERE src > 1 AND (id % 1000) * 2654435761 % 1000 < 200")
def query_sample_hash(spark, d):
    return raw_records(spark, d).where((F.col("src") > 1) & R.in_sample(F.col("id"), 200)).select("src", "id")


@query(f"WITH {Z.DOCS} SELECT id AS s1_id, {Z.FOLD} AS fold FROM raw WHERE src = 1")
def fold_assign(spark, d):
    return entities(spark, d).select("s1_id", "fold")


@query(f"WITH {Z.RECORDS}, {Z.weights()}, {Z.pairs()} SELECT q_src, q_id, s1_id, bscore FROM pr")
def block_join_scores(spark, d):
    return C.scored_pairs(C.weighted(records(spark, d)), CAP)


ADAPT = f"""WITH {Z.RECORDS}, {Z.weights()}, {Z.pairs()},
a1 AS (SELECT *, max(bscore) OVER (PARTITION BY q_src, q_id) AS best FROM pr),
a2 AS (SELECT *, count(*) FILTER (WHERE bscore >= 0.9 * best) OVER (PARTITION BY q_src, q_id) AS ties, row_number() OVER (PARTITION BY q_src, q_id ORDER BY bscore DESC, s1_id) AS rn FROM a1 WHERE bscore >= 0.3 * best),
a3 AS (SELECT a2.*, addr_norm = '' OR ties >= 10 AS very, nonascii OR ties >= 5 AS amb FROM a2 JOIN rec ON src = q_src AND id = q_id WHERE rn <= 50)
SELECT q_src, q_id, s1_id, bscore, rn - 1 AS brank FROM a3 WHERE rn <= CASE WHEN very THEN 50 WHEN amb THEN 20 ELSE 10 END AND bscore >= (CASE WHEN very OR amb THEN 0.3 ELSE 0.4 END - 1e-6) * best"""


def query_flags(recs: DataFrame) -> DataFrame:
    return recs.where("src > 1").select(F.col("src").alias("q_src"), F.col("id").alias("q_id"), "nonascii", (F.col("addr_norm") == "").alias("addr_empty"))


@query(ADAPT)
def block_adaptive(spark, d):
    recs = records(spark, d)
    return C.top_adaptive(C.scored_pairs(C.weighted(recs), CAP), query_flags(recs))


@query(f"WITH {Z.RECORDS}, {Z.weights()}, {Z.pairs(20, rerank=True)}, {Z.top()} SELECT q_src, q_id, s1_id, bscore, brank FROM cand")
def block_rerank(spark, d):
    return candidates(spark, d, cap=20, rerank=True)


for _kind in C.RETRIEVERS:
    def _retriever(spark, d, kind=_kind):
        recs = numbered_records(spark, d) if kind == "num" else records(spark, d)
        return C.retrieve(recs, kind, cap=CAP, k=K, rel=REL)

    _retriever.__name__ = f"retriever_{_kind}"
    query(f"WITH {Z.NUMBERED if _kind == 'num' else Z.RECORDS}, {Z.weights(Z.FIELD[_kind])}, {Z.pairs()}, {Z.top()} SELECT q_src, q_id, s1_id, bscore, brank FROM cand")(_retriever)

UNION = ",\n".join([Z.RECORDS, *[x for i, k in enumerate(("name", "skel", "num")) for x in (Z.weights(Z.FIELD[k], f"u{i}"), Z.pairs(p=f"u{i}"), Z.top(p=f"u{i}"))]])


@query(f"WITH {UNION} " + " UNION ".join(f"SELECT q_src, q_id, s1_id FROM u{i}cand WHERE brank < 5" for i in range(3)))
def retriever_union(spark, d):
    parts = [candidates(spark, d, kind=k).where("brank < 5").select(*PAIR) for k in ("name", "skel", "num")]
    return parts[0].union(parts[1]).union(parts[2]).distinct()


SCREEN = ",\n".join([Z.CANDS, Z.TRUTH, *[x for k in ("name", "skel", "num") for x in (Z.weights(Z.FIELD[k], k), Z.pairs(p=k), Z.top(p=k))]])


@query(f"WITH {SCREEN}, " + "h AS (SELECT 'main' AS retriever, q_src, q_id, s1_id FROM cand UNION ALL " + " UNION ALL ".join(f"SELECT '{k}', q_src, q_id, s1_id FROM {k}cand UNION ALL (SELECT 'main+{k}', q_src, q_id, s1_id FROM cand UNION SELECT 'main+{k}', q_src, q_id, s1_id FROM {k}cand)" for k in ("name", "skel", "num")) + ") SELECT retriever, count(*) AS pairs, count(t.s1_id) AS hits, round(count(t.s1_id) / (SELECT count(*) FROM truth), 6) AS recall FROM h LEFT JOIN truth t USING (q_src, q_id, s1_id) GROUP BY retriever")
def retriever_screen(spark, d):
    main = candidates(spark, d).select(*PAIR)
    rows = main.select(F.lit("main").alias("retriever"), *PAIR)
    for k in ("name", "skel", "num"):
        own = candidates(spark, d, kind=k).select(*PAIR)
        rows = rows.unionByName(own.select(F.lit(k).alias("retriever"), *PAIR)).unionByName(main.union(own).distinct().select(F.lit(f"main+{k}").alias("retriever"), *PAIR))
    true = truth(spark, d)
    got = rows.join(true.withColumn("hit", F.lit(1)), PAIR, "left").groupBy("retriever").agg(F.count(F.lit(1)).alias("pairs"), F.count("hit").alias("hits"))
    return got.crossJoin(true.agg(F.count(F.lit(1)).alias("n"))).select("retriever", "pairs", "hits", F.round(F.try_divide("hits", "n"), 6).alias("recall"))


@query(f"WITH {Z.CANDS} SELECT q_src, q_id, s1_id, round(best, 6) AS best, ties, n04, round(bscore / best, 6) AS rel FROM (SELECT *, count(*) FILTER (WHERE bscore / best >= 0.9) OVER w AS ties, count(*) FILTER (WHERE bscore / best >= 0.4) OVER w AS n04 FROM (SELECT *, max(bscore) OVER (PARTITION BY q_src, q_id) AS best FROM cand) WINDOW w AS (PARTITION BY q_src, q_id))")
def query_signals(spark, d):
    return C.query_signals(candidates(spark, d)).select(*PAIR, F.round("best", 6).alias("best"), "ties", "n04", F.round("rel", 6).alias("rel"))


# --- truth, recall, diagnoses


@query(f"WITH {Z.CANDS}, {Z.PLANTED} SELECT * FROM truth ANTI JOIN cand USING (q_src, q_id, s1_id)")
def candidate_anti(spark, d):
    return E.missed(candidates(spark, d), planted_truth(spark, d))


@query(f"WITH {Z.CANDS}, {Z.TRUTH} SELECT c.q_src, c.q_id, c.s1_id, c.brank, CAST(t.s1_id IS NOT NULL AS BIGINT) AS label FROM cand c LEFT JOIN truth t USING (q_src, q_id, s1_id)")
def label_join(spark, d):
    return E.labelled(candidates(spark, d), truth(spark, d)).select(*PAIR, "brank", "label")


RANKS = f"{Z.CANDS}, {Z.TRUTH}, rk AS (SELECT t.q_src, t.q_id, t.s1_id, coalesce(brank, 99) AS brank FROM truth t LEFT JOIN cand USING (q_src, q_id, s1_id))"
RECALLS = "count(*) AS n_true, " + ", ".join(f"round(avg(CAST(brank < {k} AS DOUBLE)), 6) AS recall_{k}" for k in E.KS)


@query(f"WITH {RANKS} SELECT {RECALLS} FROM rk")
def recall_at_k(spark, d):
    return E.recall_at(E.truth_ranks(candidates(spark, d), truth(spark, d)))


@query(f"WITH {RANKS} SELECT coalesce(country, 'ALL') AS country, coalesce(q_src, 0) AS q_src, {RECALLS} FROM rk JOIN doc ON id = s1_id AND src = 1 GROUP BY ROLLUP (country, q_src)")
def recall_rollup(spark, d):
    ranks = E.truth_ranks(candidates(spark, d), truth(spark, d)).join(documents(spark, d).where("src = 1").select(F.col("id").alias("s1_id"), "country"), "s1_id")
    out = ranks.rollup("country", "q_src").agg(F.count(F.lit(1)).alias("n_true"), *[F.round(F.avg((F.col("brank") < k).cast("double")), 6).alias(f"recall_{k}") for k in E.KS])
    return out.withColumn("country", F.coalesce("country", F.lit("ALL"))).withColumn("q_src", F.coalesce("q_src", F.lit(0)))


@query(f"WITH {Z.CANDS}, n AS (SELECT count(*) FILTER (WHERE src = 1) AS n1, count(*) FILTER (WHERE src > 1) AS nq FROM rec), p AS (SELECT count(*) AS pairs FROM cand) SELECT n1, nq, pairs, round(pairs / n1, 6) AS per_s1, round(pairs / nq, 6) AS per_query, round(1 - pairs / (n1 * nq), 9) AS reduction FROM n, p")
def reduction_ratio(spark, d):
    return E.reduction(candidates(spark, d), records(spark, d))


TRUES = f"""{Z.RECORDS}, {Z.weights()}, {Z.pairs(20)}, {Z.top(3)}, {Z.PLANTED},
sh AS (SELECT t.q_src, t.q_id, t.s1_id, count(ix.token) AS n_shared, count(*) FILTER (WHERE ix.df <= 20) AS n_usable, round(coalesce(sum(CASE WHEN ix.df <= 20 THEN wq * ws END), 0), 6) AS score
  FROM truth t LEFT JOIN qw ON qw.q_src = t.q_src AND qw.q_id = t.q_id LEFT JOIN ix ON ix.country = qw.country AND ix.token = qw.token AND ix.s1_id = t.s1_id GROUP BY ALL)"""


def _trues(spark, d):
    recs, true = records(spark, d), planted_truth(spark, d)
    w = C.weighted(recs)
    every = C.scored_pairs(w, 20)
    return true, every, C.top_k(every, 3, REL), E.true_scores(true, w.index, w.unit(), 20)


@query(f"WITH {TRUES} SELECT sh.q_src, sh.q_id, sh.s1_id, score, count(pr.s1_id) AS rank FROM sh LEFT JOIN pr ON pr.q_src = sh.q_src AND pr.q_id = sh.q_id AND pr.bscore > sh.score + 1e-6 GROUP BY ALL")
def truth_rank_unlimited(spark, d):
    _, every, _, trues = _trues(spark, d)
    return E.unlimited_rank(trues, every).select(*PAIR, "score", "rank")


CAUSES = f"""{TRUES},
cs AS MATERIALIZED (SELECT m.*, CASE WHEN n_shared = 0 THEN 'zero_overlap' WHEN n_usable = 0 THEN 'only_capped' WHEN score < {REL} * best - 1e-6 THEN 'cutoff' ELSE 'not_topk' END AS cause
  FROM (SELECT sh.*, coalesce(b.bscore, 0) AS best FROM sh ANTI JOIN cand USING (q_src, q_id, s1_id) LEFT JOIN cand b ON b.brank = 0 AND b.q_src = sh.q_src AND b.q_id = sh.q_id) m)"""


@query(f"WITH {CAUSES} SELECT q_src, q_id, s1_id, n_shared, n_usable, score, best, cause FROM cs")
def miss_cause(spark, d):
    _, _, cands, trues = _trues(spark, d)
    return E.miss_causes(trues.join(cands, PAIR, "left_anti"), cands, REL).select(*PAIR, "n_shared", "n_usable", "score", "best", "cause")


@query(f"WITH {CAUSES} SELECT cause, count(*) AS n, round(avg(score), 6) AS mean_score, CAST(count(*) FILTER (WHERE score >= 0.5) AS BIGINT) AS high FROM cs GROUP BY cause")
def miss_histogram(spark, d):
    _, _, cands, trues = _trues(spark, d)
    rows = E.miss_causes(trues.join(cands, PAIR, "left_anti"), cands, REL)
    return rows.groupBy("cause").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 6).alias("mean_score"), F.count_if(F.col("score") >= 0.5).alias("high"))


#: The slices' attributes, of the pair's entity (e) and query (q).
ATTRS = {
    "nonascii": "q.nonascii", "country": "e.country", "q_addr_empty": "q.addr_norm = ''", "q_name_empty": "q.name_core = ''", "exact_name": "e.name_norm = q.name_norm",
    "near_name": "cj >= 0.5 AND e.name_norm <> q.name_norm", "weak_name_strong_addr": "cj = 0 AND aj >= 0.5", "no_name_no_addr_overlap": "cj = 0 AND aj < 0.5", "src": "'S' || q.src",
}
SLICED = f"""{CAUSES}, jc AS MATERIALIZED (SELECT t.*, cs.cause, e, q, {Z.jacc(Z.split("e.name_core"), Z.split("q.name_core"))} AS cj, {Z.jacc(Z.split("e.addr_norm"), Z.split("q.addr_norm"))} AS aj
  FROM truth t JOIN rec e ON e.src = 1 AND e.id = t.s1_id JOIN rec q ON q.src = t.q_src AND q.id = t.q_id LEFT JOIN cs ON cs.q_src = t.q_src AND cs.q_id = t.q_id AND cs.s1_id = t.s1_id),
sl AS (SELECT * FROM (SELECT cause, greatest(cj, 0) AS cj, greatest(aj, 0) AS aj, e, q FROM jc), LATERAL (SELECT unnest([{', '.join(f"{{'attribute': '{k}', 'value': CAST({v} AS VARCHAR)}}" for k, v in ATTRS.items())}]) AS x))
SELECT x.attribute, x.value, count(*) AS pairs, round(count(*) / (SELECT count(*) FROM jc), 6) AS share, round(avg(CAST(cause IS NULL AS DOUBLE)), 6) AS recall, count(cause) AS misses,
{', '.join(f"round(coalesce(count(*) FILTER (WHERE cause = '{c}') / nullif(count(cause), 0), 0), 6) AS {c}" for c in E.CAUSES)} FROM sl GROUP BY ALL"""


@query(f"WITH {SLICED}")
def slice_report(spark, d):
    """Recall, misses and their causes in slices of the true pairs."""
    recs, (true, _, cands, trues) = records(spark, d), _trues(spark, d)
    causes = E.miss_causes(trues.join(cands, PAIR, "left_anti"), cands, REL).select(*PAIR, "cause")
    return E.slices(P.with_texts(true, recs).join(recs.where("src = 1").select(F.col("id").alias("s1_id"), "country"), "s1_id").join(causes, PAIR, "left"))


RULES = [("k10 r0.4", 10, 0.4, 10, 0.4, 99), ("k5 r0.4", 5, 0.4, 5, 0.4, 99), ("k10 hard 30", 10, 0.4, 30, 0.3, 5), ("k3 hard 50", 3, 0.5, 50, 0.2, 3)]


@query(f"WITH {Z.SUPER}, {Z.TRUTH}, rules(policy, k, r, kh, rh, tie) AS (VALUES " + ", ".join(str(r) for r in RULES) + """),
s1 AS (SELECT c.*, bscore / max(bscore) OVER (PARTITION BY q_src, q_id) AS rel FROM cand c), s2 AS (SELECT *, count(*) FILTER (WHERE rel >= 0.9) OVER (PARTITION BY q_src, q_id) AS ties FROM s1),
s3 AS (SELECT s2.*, nonascii OR addr_norm = '' AS flag, t.s1_id IS NOT NULL AS hit FROM s2 JOIN rec ON src = s2.q_src AND id = s2.q_id LEFT JOIN truth t ON t.q_src = s2.q_src AND t.q_id = s2.q_id AND t.s1_id = s2.s1_id)
SELECT policy, round(count(*) FILTER (WHERE hit) / (SELECT count(*) FROM truth), 6) AS recall, round(count(*) / (SELECT count(*) FROM rec WHERE src > 1), 6) AS pairs_per_query
FROM s3 JOIN rules ON brank < CASE WHEN flag OR ties >= tie THEN kh ELSE k END AND rel >= CASE WHEN flag OR ties >= tie THEN rh ELSE r END - 1e-6 GROUP BY policy""")
def policy_sim(spark, d):
    return E.simulate(candidates(spark, d, k=50, rel=0.2), truth(spark, d), query_flags(records(spark, d)), RULES)


TIER_SQL = " UNION ALL ".join(
    f"SELECT '{name} {k1}/{k2}/{k3} r{r}' AS policy, count(*) FILTER (WHERE kept AND hit) AS hits, count(*) FILTER (WHERE kept) AS pairs FROM (SELECT hit, brank < CASE WHEN {very} THEN {k3} WHEN {amb} THEN {k2} ELSE {k1} END AND rel >= CASE WHEN {very} OR {amb} THEN {r} ELSE 0.4 END - 1e-6 AS kept FROM s3)"
    for name, (amb, very) in E.TIERS.items()
    for k1, k2, k3, r in E.BUDGETS
)


@query(f"""WITH {Z.SUPER}, {Z.TRUTH}, s1 AS (SELECT c.*, max(bscore) OVER (PARTITION BY q_src, q_id) AS best FROM cand c),
s2 AS (SELECT *, bscore / best AS rel, count(*) FILTER (WHERE bscore / best >= 0.9) OVER (PARTITION BY q_src, q_id) AS ties FROM s1),
s3 AS MATERIALIZED (SELECT s2.*, nonascii, addr_norm = '' AS addr_empty, t.s1_id IS NOT NULL AS hit FROM s2 JOIN rec ON src = s2.q_src AND id = s2.q_id LEFT JOIN truth t ON t.q_src = s2.q_src AND t.q_id = s2.q_id AND t.s1_id = s2.s1_id)
SELECT policy, round(hits / (SELECT count(*) FROM truth), 6) AS recall, round(pairs / (SELECT count(*) FROM rec WHERE src > 1), 6) AS pairs_per_query FROM ({TIER_SQL})""")
def policy_tiers(spark, d):
    return E.simulate_tiers(candidates(spark, d, k=50, rel=0.2), truth(spark, d), query_flags(records(spark, d)))


RANK_EDGES = [0, 1, 2, 5, 10, 20, 50]


@query(f"WITH {TRUES}, rk AS (SELECT sh.q_src, sh.q_id, sh.s1_id, count(pr.s1_id) AS rank FROM sh LEFT JOIN pr ON pr.q_src = sh.q_src AND pr.q_id = sh.q_id AND pr.bscore > sh.score + 1e-6 GROUP BY ALL) SELECT CASE " + " ".join(f"WHEN rank >= {e} THEN {i}" for i, e in reversed(list(enumerate(RANK_EDGES)))) + " END AS bucket, count(*) AS n FROM rk GROUP BY 1")
def rank_buckets(spark, d):
    _, every, _, trues = _trues(spark, d)
    return E.histogram(E.unlimited_rank(trues, every), "rank", RANK_EDGES)


SCORE_EDGES = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.7, 0.9]


@query(f"WITH {Z.SCORED} SELECT CASE " + " ".join(f"WHEN p >= {e} THEN {i}" for i, e in reversed(list(enumerate(SCORE_EDGES)))) + " END AS bucket, count(*) AS n FROM sc GROUP BY 1")
def score_buckets(spark, d):
    return E.histogram(scored(spark, d), "p", SCORE_EDGES)


# --- pair features


def _texts(spark, d):
    recs = records(spark, d)
    return P.with_texts(C.retrieve(recs, cap=CAP, k=K, rel=REL), recs)


@query(f"WITH {Z.CANDS}, {Z.SIDES} SELECT q_src, q_id, s1_id, nonascii2, {Z.SETS} FROM sd")
def pair_set_features(spark, d):
    return P.set_rows(_texts(spark, d)).select(*PAIR, "nonascii2", *P.SETS)


@query(f"WITH {Z.CANDS} {Z.CONTEXT}")
def context_features(spark, d):
    return P.context(candidates(spark, d)).select(*PAIR, *P.CONTEXT)


def _cosine_sql(fields: tuple[str, ...]) -> str:
    parts, cols, joins = [], [], []
    for i, f in enumerate(fields):
        p = f"f{i}"
        parts.append(Z.weights(Z.FIELD[f], p))
        parts.append(f"{p}h AS (SELECT DISTINCT src, id FROM {p}tok), {p}x AS (SELECT c.q_src, c.q_id, c.s1_id, sum(wq * ws) AS x FROM cand c JOIN {p}qw w ON w.q_src = c.q_src AND w.q_id = c.q_id JOIN {p}ix i ON i.country = w.country AND i.token = w.token AND i.s1_id = c.s1_id GROUP BY ALL)")
        cols.append(f"CASE WHEN a{i}.id IS NOT NULL AND b{i}.id IS NOT NULL THEN round(coalesce(x{i}.x, 0), 6) END AS ps_{f}")
        joins.append(f"LEFT JOIN {p}h a{i} ON a{i}.src = 1 AND a{i}.id = c.s1_id LEFT JOIN {p}h b{i} ON b{i}.src = c.q_src AND b{i}.id = c.q_id LEFT JOIN {p}x x{i} ON x{i}.q_src = c.q_src AND x{i}.q_id = c.q_id AND x{i}.s1_id = c.s1_id")
    return f"WITH {Z.CANDS}, {', '.join(parts)} SELECT c.q_src, c.q_id, c.s1_id, {', '.join(cols)} FROM cand c {' '.join(joins)}"


@query(_cosine_sql(P.COSINE_FIELDS))
def field_cosine(spark, d):
    recs = records(spark, d)
    return P.field_cosines(C.retrieve(recs, cap=CAP, k=K, rel=REL), recs)


def _coverage_sql() -> str:
    head, _, _ = _cosine_sql(P.COSINE_FIELDS).partition(" SELECT c.q_src, c.q_id, c.s1_id, CASE")
    tail = _cosine_sql(P.COSINE_FIELDS)[len(head) :]
    return f"{head}, cv AS MATERIALIZED ({tail}) " + " UNION ALL ".join(f"SELECT 'ps_{f}' AS field, round(avg(CAST(ps_{f} IS NULL AS DOUBLE)), 6) AS missing, round(avg(ps_{f}), 5) AS mean FROM cv" for f in P.COSINE_FIELDS)


@query(_coverage_sql())
def cosine_coverage(spark, d):
    return E.coverage(field_cosine.__wrapped__(spark, d), tuple(f"ps_{f}" for f in P.COSINE_FIELDS))


@query(f"WITH {Z.CANDS}, {Z.SIDES} SELECT q_src, q_id, s1_id, CAST(levenshtein(core1, core2) AS BIGINT) AS distance FROM sd")
def levenshtein_pairs(spark, d):
    return _texts(spark, d).select(*PAIR, F.levenshtein("core1", "core2").alias("distance"))


@query(f"WITH {Z.CANDS}, {Z.SIDES} SELECT q_src, q_id, s1_id, round(jaro_winkler_similarity(core1, core2), 6) AS similarity FROM sd")
def jaro_winkler_pairs(spark, d):
    return _texts(spark, d).select(*PAIR, F.round(S.jaro("core1", "core2"), 6).alias("similarity"))


def _pairs_by(name: str, f, tests: str):
    def run(spark, d):
        cols = [F.round(f(f"{c}1", f"{c}2"), 6).alias(f"{c}_{tests}") for c in ("name", "core", "addr")]
        return _texts(spark, d).select(*PAIR, *cols)

    run.__name__ = name
    query(f"WITH {Z.CANDS}, {Z.SIDES}, {Z.edit_query(tests)}")(run)


_pairs_by("indel_ratio_pairs", S.indel_ratio, "ratio")
_pairs_by("token_set_pairs", S.token_set, "tset")
_pairs_by("token_sort_pairs", S.token_sort, "tsort")
_pairs_by("partial_ratio_pairs", S.partial, "partial")


KEYED = "USING (q_src, q_id, s1_id)"
BARE = "SELECT replace(core1, ' ', '') AS p, replace(core2, ' ', '') AS q FROM sd"
FEATURES = f"""WITH {Z.CANDS}, {Z.SIDES}, cx AS ({Z.CONTEXT}), st AS (SELECT q_src, q_id, s1_id, CAST(nonascii2 AS BIGINT) AS nonascii2, {Z.SETS}, round(jaro_winkler_similarity(core1, core2), 6) AS core_jw FROM sd),
{', '.join(f"e{k} AS (WITH {Z.edit_query(k)})" for k in ('ratio', 'tset', 'tsort', 'partial'))}, sk AS (WITH {Z.edit_query('tset', ('skel',))}),
ns AS (WITH {Z.edits(BARE)} SELECT q_src, q_id, s1_id, round(r, 6) AS core_nospace_ratio FROM sd JOIN rt ON rt.p = replace(core1, ' ', '') AND rt.q = replace(core2, ' ', ''))
SELECT c.q_src, c.q_id, c.s1_id, c.bscore, c.brank, CAST(c.q_src AS DOUBLE) AS q_src_f, cx.* EXCLUDE (q_src, q_id, s1_id), st.* EXCLUDE (q_src, q_id, s1_id),
{', '.join(f"{x}.* EXCLUDE (q_src, q_id, s1_id)" for x in ('eratio', 'etset', 'etsort', 'epartial', 'sk', 'ns'))}
FROM cand c JOIN cx {KEYED} JOIN st {KEYED} JOIN eratio {KEYED} JOIN etset {KEYED} JOIN etsort {KEYED} JOIN epartial {KEYED} JOIN sk {KEYED} JOIN ns {KEYED}"""


@query(FEATURES)
def feature_rows(spark, d):
    recs = records(spark, d)
    rows = P.features(C.retrieve(recs, cap=CAP, k=K, rel=REL), recs)
    return rows.withColumns({c: F.round(c, 6) for c in S.EDIT})


# --- assignment and evaluation


@query(f"WITH {Z.BEST} SELECT q_src, q_id, s1_id, p, p2 FROM bq")
def best_per_query(spark, d):
    return A.best_per_query(scored(spark, d))


KEPT = f"SELECT q_src, q_id, s1_id FROM bq WHERE p >= {T0} AND round(p - p2, 9) >= {MARGIN}"


def _assigned(spark, d):
    return A.assign(A.best_per_query(scored(spark, d)), T0, MARGIN)


@query(f"WITH {Z.BEST} {KEPT}")
def assign(spark, d):
    return _assigned(spark, d).select(*PAIR)


@query(f"WITH {Z.SCORED} SELECT q_src, q_id, s1_id, p FROM sc WHERE p >= {T0}")
def threshold_only(spark, d):
    return A.threshold_only(scored(spark, d), T0)


METRIC = f"WITH {Z.BEST}, {Z.TRUTH}, {Z.ENT}, {Z.counted(KEPT)}"


@query(f"{METRIC} SELECT {Z.MACRO} FROM cn")
def macro_f05(spark, d):
    return E.macro_f05(entities(spark, d), _assigned(spark, d), truth(spark, d))


@query(f"{METRIC} SELECT coalesce(country, 'ALL') AS country, {Z.MACRO} FROM cn GROUP BY GROUPING SETS ((country), ())")
def country_eval(spark, d):
    per = E.per_entity(E.counted(entities(spark, d), _assigned(spark, d), truth(spark, d)))
    both = per.withColumn("country", F.explode(F.array("country", F.lit("ALL"))))
    return E.macro(both, "country")


@query(f"WITH {Z.CANDS}, {Z.TRUTH}, {Z.ENT}, {Z.counted('SELECT * FROM truth SEMI JOIN cand USING (q_src, q_id, s1_id)')} SELECT {Z.MACRO} FROM cn")
def ceiling(spark, d):
    return E.ceiling(entities(spark, d), candidates(spark, d), truth(spark, d))


@query(f"{METRIC}, pf AS (SELECT fold, avg(f05) AS f FROM cn GROUP BY fold) SELECT round(avg(f), 6) AS mean, round(stddev_pop(f), 6) AS std, count(*) AS folds FROM pf")
def fold_summary(spark, d):
    per = E.per_entity(E.counted(entities(spark, d), _assigned(spark, d), truth(spark, d)))
    return E.summarize(per.groupBy("fold").agg(F.avg("f05").alias("macro_f05")))


GRID = [(t, m) for t in (0.2, 0.3, 0.4, 0.5, 0.6) for m in (0.0, 0.05, 0.1)]


def _grid_sql(least: str) -> str:
    return f"""WITH {Z.BEST}, {Z.TRUTH}, {Z.ENT}, g(t, margin) AS (VALUES {', '.join(f'({t}, {m})' for t, m in GRID)}),
kp AS (SELECT g.t, g.margin, b.q_src, b.q_id, b.s1_id FROM bq b JOIN g ON b.p >= {least} AND round(b.p - b.p2, 9) >= g.margin),
pn AS (SELECT k.t, k.margin, k.s1_id, count(*) AS npred, count(tr.s1_id) AS tp FROM kp k LEFT JOIN truth tr ON k.q_src = tr.q_src AND k.q_id = tr.q_id AND k.s1_id = tr.s1_id GROUP BY ALL),
tn AS (SELECT s1_id, count(*) AS ntrue FROM truth GROUP BY s1_id),
cn AS (SELECT g.t, g.margin, coalesce(ntrue, 0) AS ntrue, coalesce(npred, 0) AS npred, coalesce(tp, 0) AS tp FROM ent CROSS JOIN g LEFT JOIN tn ON tn.s1_id = ent.s1_id LEFT JOIN pn ON pn.s1_id = ent.s1_id AND pn.t = g.t AND pn.margin = g.margin)
SELECT CAST(t AS DOUBLE) AS t, CAST(margin AS DOUBLE) AS margin, round(avg(CASE WHEN ntrue = 0 THEN CAST(npred = 0 AS DOUBLE) WHEN tp = 0 THEN 0.0 ELSE 1.25 * (tp / npred) * (tp / ntrue) / (0.25 * (tp / npred) + tp / ntrue) END), 6) AS macro_f05,
round(avg(CASE WHEN ntrue = 0 THEN CAST(npred = 0 AS DOUBLE) WHEN tp = 0 THEN 0.0 ELSE 2.0 * (tp / npred) * (tp / ntrue) / (tp / npred + tp / ntrue) END), 6) AS macro_f1 FROM cn GROUP BY t, margin"""


def _grid(spark, d, t3=None):
    out = A.policy_scores(A.best_per_query(scored(spark, d)), truth(spark, d), entities(spark, d), GRID, t3)
    return out.select("t", "margin", F.round("macro_f05", 6).alias("macro_f05"), F.round("macro_f1", 6).alias("macro_f1"))


@query(_grid_sql("g.t"))
def policy_grid(spark, d):
    return _grid(spark, d)


@query(_grid_sql("CASE WHEN b.q_src = 3 THEN 0.45 ELSE g.t END"))
def per_source_threshold(spark, d):
    return _grid(spark, d, 0.45)


@query(f"WITH {Z.BEST}, {Z.TRUTH}, f AS (SELECT t.q_src, t.q_id, t.s1_id AS true_id FROM truth t SEMI JOIN cand USING (q_src, q_id, s1_id)) SELECT * FROM (SELECT f.q_src, f.q_id, true_id, CASE WHEN b.s1_id <> true_id THEN 'lost_to_other_s1' WHEN p < {T0} THEN 'below_threshold' WHEN round(p - p2, 9) < {MARGIN} THEN 'lost_on_margin' END AS reason FROM f JOIN bq b ON f.q_src = b.q_src AND f.q_id = b.q_id) WHERE reason IS NOT NULL")
def classifier_misses(spark, d):
    rows = scored(spark, d)
    return E.classifier_misses(A.best_per_query(rows), rows, truth(spark, d), T0, MARGIN)


@query(f"WITH {Z.BEST}, {Z.ENT}, k AS ({KEPT}), l AS (SELECT s1_id, string_agg('S' || q_src || '-' || q_id, ',' ORDER BY q_src, q_id) AS ids FROM k GROUP BY s1_id) SELECT 'S1-' || e.s1_id AS source1_entity_id, coalesce(ids, '') AS matched_entity_ids FROM ent e LEFT JOIN l ON e.s1_id = l.s1_id")
def match_lists(spark, d):
    return id_lists(_assigned(spark, d), entities(spark, d).select("s1_id")).drop("s1_id")


def _dirty_lists(spark, d):
    """The result lists with planted faults, by the entity's number."""
    lists = match_lists.__wrapped__(spark, d).toDF("s1", "ids")
    n = F.substring("s1", 4, 20).cast("long")
    bad = F.when(n % 11 == 0, F.concat("ids", F.lit(",S1-5"))).when(n % 11 == 1, F.lit("X9-1,S2-999999999")).when(n % 11 == 2, F.lit("S2-7,S2-7")).otherwise(F.col("ids"))
    dirty = lists.withColumn("ids", bad).where(n % 13 != 0)
    return lists, dirty.union(dirty.where(n % 17 == 3)).union(dirty.where(n % 19 == 3).select(F.concat(F.lit("S1-9"), F.lpad(n.cast("string"), 12, "0")), "ids"))


DIRTY = f"""WITH {Z.BEST}, {Z.ENT}, k AS ({KEPT}), l AS (SELECT s1_id, string_agg('S' || q_src || '-' || q_id, ',' ORDER BY q_src, q_id) AS ids FROM k GROUP BY s1_id),
good AS (SELECT e.s1_id AS n, 'S1-' || e.s1_id AS s1, coalesce(ids, '') AS ids FROM ent e LEFT JOIN l ON e.s1_id = l.s1_id),
d0 AS (SELECT n, s1, CASE n % 11 WHEN 0 THEN ids || ',S1-5' WHEN 1 THEN 'X9-1,S2-999999999' WHEN 2 THEN 'S2-7,S2-7' ELSE ids END AS ids FROM good WHERE n % 13 <> 0),
dirty AS MATERIALIZED (SELECT s1, ids FROM d0 UNION ALL SELECT s1, ids FROM d0 WHERE n % 17 = 3 UNION ALL SELECT 'S1-9' || lpad(CAST(n AS VARCHAR), 12, '0'), ids FROM d0 WHERE n % 19 = 3),
sp AS (SELECT s1, CASE WHEN trim(ids) = '' THEN [] ELSE string_split(ids, ',') END AS a FROM dirty), ea AS (SELECT DISTINCT s1, unnest(a) AS id FROM sp)"""


@query(f"""{DIRTY} SELECT 'duplicate_row' AS rule, s1 AS key FROM dirty GROUP BY s1 HAVING count(*) > 1 UNION ALL SELECT 'repeated_id', s1 FROM sp WHERE len(a) <> len(list_distinct(a))
UNION ALL SELECT DISTINCT 'self_match', id FROM ea WHERE id LIKE 'S1-%' UNION ALL SELECT DISTINCT 'wrong_prefix', id FROM ea WHERE NOT regexp_matches(id, '^S[123]-')
UNION ALL SELECT 'missing_s1', s1 FROM good WHERE s1 NOT IN (SELECT s1 FROM dirty) UNION ALL SELECT DISTINCT 'unknown_s1', s1 FROM dirty WHERE s1 NOT IN (SELECT s1 FROM good)
UNION ALL SELECT DISTINCT 'unknown_id', id FROM ea WHERE regexp_matches(id, '^S[23]-') AND id NOT IN (SELECT entity_id FROM raw WHERE src > 1)""")
def validator_report(spark, d):
    lists, dirty = _dirty_lists(spark, d)
    return list_violations(dirty, lists.select("s1"), raw_records(spark, d).where("src > 1").select(F.col("entity_id").alias("id")))


@query(f"{DIRTY}, cl AS (SELECT DISTINCT 'S1-' || s1_id AS s1, 'S' || q_src || '-' || q_id AS id FROM cand) SELECT DISTINCT 'not_candidate' AS rule, s1 AS key FROM ea WHERE (s1, id) NOT IN (SELECT s1, id FROM cl)")
def subset_warning(spark, d):
    cands = id_lists(candidates(spark, d), entities(spark, d).select("s1_id"), "candidate_entity_ids").select(F.col("source1_entity_id").alias("s1"), F.col("candidate_entity_ids").alias("ids"))
    return not_candidates(_dirty_lists(spark, d)[1], cands)


# --- learning


@query()
def gbt_oof(spark, d):
    """Out-of-fold scores of the candidates by gradient-boosted trees over all features."""
    recs = records(spark, d)
    cands = E.labelled(C.retrieve(recs, cap=CAP, k=K, rel=REL), truth(spark, d)).drop("label")
    rows = kept(E.labelled(P.features(cands, recs), truth(spark, d)).join(entities(spark, d).select("s1_id", "fold"), "s1_id"))
    return L.out_of_fold(rows, params={"maxDepth": 4, "maxIter": 8})[0]


@query(f"WITH {Z.CANDS}, {Z.TRUTH}, lb AS (SELECT c.*, CAST(t.s1_id IS NOT NULL AS BIGINT) AS label, max(bscore) OVER (PARTITION BY c.q_src, c.q_id) AS best FROM cand c LEFT JOIN truth t USING (q_src, q_id, s1_id)), hd2 AS (SELECT *, label = 1 OR brank = 0 OR bscore >= 0.6 * best AS hard FROM lb WHERE {Z.share(1, 's1_id')} < 0.8) SELECT q_src, q_id, s1_id, label, CASE WHEN hard THEN 1.0::DOUBLE ELSE 1.0::DOUBLE / 0.3 END AS weight FROM hd2 WHERE hard OR {Z.share(2, 'q_src', 'q_id', 's1_id')} < 0.3")
def training_sample(spark, d):
    """Training rows of four fifths of the entities, with three tenths of the easy negatives."""
    rows = E.labelled(candidates(spark, d), truth(spark, d))
    return L.sampled_training(rows, keep_entities=0.8, keep_easy=0.3).select(*PAIR, "label", "weight")


@query(f"WITH {Z.DOCS}, {Z.ENT} SELECT s1_id, md5('5|' || s1_id) AS place FROM ent ORDER BY place, s1_id LIMIT 20")
def chosen_entities(spark, d):
    """Twenty entities without replacement, the same in every run."""
    own = entities(spark, d).select("s1_id")
    return E.chosen(own, 20, "s1_id", seed=5).select("s1_id", F.md5(F.concat_ws("|", F.lit("5"), F.col("s1_id").cast("string"))).alias("place"))


@query("SELECT row_number() OVER () - 1 AS place, column_name AS name FROM (DESCRIBE lineitem) WHERE column_name NOT IN ('l_comment', 'l_shipmode')")
def schema_columns(spark, d):
    """Names in order from the file's footer alone, without those that are dropped."""
    return spark.createDataFrame(list(enumerate(P.feature_names(table(spark, d, "lineitem"), ("l_comment", "l_shipmode")))), "place long, name string")


@query(_grid_sql("g.t") + " ORDER BY macro_f05 DESC, t, margin LIMIT 1")
def policy_argmax(spark, d):
    """The best policy of the grid, ties to the lower threshold and the smaller margin."""
    return _grid(spark, d).orderBy(F.desc("macro_f05"), "t", "margin").limit(1)


# --- files written to the shared folder and read again


@query(f"WITH {Z.DOCS} SELECT src, id, entity_id, country, name_raw, addr_raw FROM raw")
def tsv_roundtrip(spark, d):
    """Records of three sources as verbatim TSV folders, scanned as the parts of one table."""
    raw, at = raw_records(spark, d), scratch(spark)
    parts = []
    for src in (1, 2, 3):
        rows = raw.where(F.col("src") == src).select("entity_id", F.col("name_raw").alias("business_name"), F.col("addr_raw").alias("business_address"), "country")
        files.write_tsv(rows, f"{at}/source{src}")
        parts.append(files.raw_records(files.read_tsv(spark, f"{at}/source{src}"), src))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(f"WITH {Z.DOCS} SELECT src, id, country, length(name_raw) AS name_length FROM raw")
def resumed_table(spark, d):
    """A partitioned zstd table asked for twice; the second time it is read, not made."""
    at = f"{scratch(spark)}/records"
    files.resumable(spark, at, lambda: raw_records(spark, d).select("src", "id", "country", F.length("name_raw").alias("name_length")), ("src",))
    return files.resumable(spark, at, _never, ("src",)).select("src", "id", "country", "name_length")


def _never() -> DataFrame:
    raise AssertionError("a finished table is not made again")


@query(f"WITH {Z.DOCS} SELECT id, md5(name_raw) AS digest, CASE WHEN src = 2 THEN 0 ELSE 1 END AS made FROM raw")
def keyed_store(spark, d):
    """A keyed table of digests, first of source 2 and then topped up with the keys it lacks."""
    rows, at = raw_records(spark, d).select("src", "id", "name_raw"), f"{scratch(spark)}/digests"
    digest = lambda made: lambda new: new.select("id", F.md5("name_raw").alias("digest"), F.lit(made).cast("long").alias("made"))
    files.top_up(spark, at, rows.where("src = 2"), ["id"], digest(0))
    return files.top_up(spark, at, rows, ["id"], digest(1))


@query(f"WITH {Z.BEST}, {Z.ENT}, k AS ({KEPT}), l AS (SELECT s1_id, string_agg('S' || q_src || '-' || q_id, ',' ORDER BY q_src, q_id) AS ids FROM k GROUP BY s1_id) SELECT 'S1-' || e.s1_id AS s1, coalesce(ids, '') AS ids, 'ok' AS header FROM ent e LEFT JOIN l ON e.s1_id = l.s1_id")
def list_file(spark, d):
    """The result lists as one TSV file with one header, read again line by line."""
    at = f"{scratch(spark)}/matching_results.tsv"
    files.write_list_file(id_lists(_assigned(spark, d), entities(spark, d).select("s1_id")), at)
    return files.read_lists(spark, at).withColumn("header", F.lit(files.header_of(spark, at)))


@query(f"WITH {Z.DOCS}, {Z.TRUTH} SELECT q_src, q_id, s1_id FROM truth")
def truth_file(spark, d):
    """The truth as lists in TSV, read again as pairs; each of its ids must be a record's."""
    at = f"{scratch(spark)}/truth"
    lists = id_lists(truth(spark, d), entities(spark, d).select("s1_id"))
    files.write_tsv(lists.select("source1_entity_id", "matched_entity_ids"), at)
    fields = T.StructType([T.StructField(c, T.StringType()) for c in ("source1_entity_id", "matched_entity_ids")])
    return files.must_exist(files.truth_pairs(files.read_tsv(spark, at, fields)), raw_records(spark, d))


TALLY = "SELECT lang, count(*) AS n FROM documents GROUP BY lang"


def _tally(spark, d) -> list:
    """A row a language."""
    return table(spark, d, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").collect()


@query(TALLY)
def json_roundtrip(spark, d):
    """Counts by language as a JSON document."""
    at = f"{scratch(spark)}/counts.json"
    files.write_json(spark, at, {r["lang"]: r["n"] for r in _tally(spark, d)})
    return spark.createDataFrame(sorted(files.read_json(spark, at).items()), "lang string, n long")


@query(f"SELECT lang, CAST(n AS VARCHAR) AS n, '' AS note FROM ({TALLY})")
def appended_log(spark, d):
    """Counts by language as lines appended one by one to a CSV log; columns that a line lacks are empty."""
    at = f"{scratch(spark)}/log.csv"
    for r in _tally(spark, d):
        files.append_log(spark, at, r.asDict(), ["lang", "n", "note"])
    log = spark.read.option("header", True).csv(at)
    return log.select("lang", "n", F.coalesce("note", F.lit("")).alias("note"))


@query(f"SELECT '| ' || lang || ' | ' || n || ' |' AS line FROM ({TALLY}) UNION ALL SELECT unnest(['## Languages', '| lang | n |', '| --- | --- |'])")
def markdown_table(spark, d):
    """Counts by language as a Markdown table, line by line."""
    at = f"{scratch(spark)}/report.md"
    files.write_text(spark, at, files.markdown(table(spark, d, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "Languages"))
    return spark.read.text(at).where("value <> ''").select(F.col("value").alias("line"))


# --- plain relational forms over the star schema


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty, round(avg(l_discount), 4) AS disc FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def cube_totals(spark, d):
    return table(spark, d, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"), F.round(F.avg("l_discount"), 4).alias("disc"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 250000)")
def customers_without_orders(spark, d):
    """Customers without a large order."""
    return table(spark, d, "customer").join(table(spark, d, "orders").where("o_totalprice > 250000").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey", "c_name")


@query("SELECT o_custkey, o_orderkey, o_totalprice, rn FROM (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 3")
def top_orders(spark, d):
    rank = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey"))
    return table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", rank.alias("rn")).where("rn <= 3")

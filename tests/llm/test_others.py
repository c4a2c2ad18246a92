import json
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import ann, html_text, language_id, line_dedup, mixing, toxicity, url_filter

from ..conftest import SMALL
from .conftest import words

# --- line dedup


def test_lines_against_sql(spark, same):
    same(line_dedup.op1_line_dedup(spark, SMALL), line_dedup.SQL)


def test_lines(spark, odd_docs, no_docs):
    rows = [(i, "h" if i % 2 else None, f"menu\nown {i}\n\nmenu\nrare") for i in range(10)] + [(99, "small", "menu\nx"), (98, None, None)]
    df = spark.createDataFrame(rows, "id long, host string, text string")
    got = {r["id"]: r for r in line_dedup.line_dedup(df, F.col("host"), line_dedup.lines_of_text(F.col("text")), keep=("id",)).collect()}
    assert got[1]["text"] == "own 1" and (got[1]["n_lines"], got[1]["n_dropped"]) == (4, 3)
    assert got[2]["host"] == "" and got[2]["text"] == "own 2"
    assert got[99]["text"] == "menu\nx" and got[98]["text"] == ""
    whole = line_dedup.line_dedup(odd_docs, F.col("source"), line_dedup.lines_of_text(F.col("text")))
    assert whole.count() == odd_docs.count() and whole.columns.count("host") == 1
    assert line_dedup.line_dedup(no_docs, F.col("source"), line_dedup.lines_of_text(F.col("text"))).count() == 0
    plan = line_dedup.op1_line_dedup(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


# --- URL filters


def test_urls_against_sql(spark, same):
    same(url_filter.op3_url_filters(spark, SMALL), url_filter.SQL)


URLS = [
    (None, "", "", None, "allow"), ("no scheme", "", "", None, "allow"), ("http://A.Net/x", "a.net", "/x", "net/", "block"), ("http://net", "net", "", None, "allow"),
    ("https://WWW.example.NET/en/1?x#y", "www.example.net", "/en/1", "example.net/en/", "allow"), ("http://example.net/EN/", "example.net", "/EN/", "net/", "block"),
    ("http://example.com/de/", "example.com", "/de/", "example.com/de/", "block"), ("http://badexample.com/de/", "badexample.com", "/de/", None, "allow"),
    ("x://org/fr/", "org", "/fr/", "org/fr/", "allow"), ("x://evil.com/a.example.com/de/", "evil.com", "/a.example.com/de/", None, "allow"), ("x://a?b", "a", "", None, "allow"),
    ("x://cheap-pills.example.com", "cheap-pills.example.com", "", None, "block"), ("x://a.com/a/spam-/", "a.com", "/a/spam-/", None, "block"), ("x://a.com/a/b/c/casino", "a.com", "/a/b/c/casino", None, "allow"),
    ("x://a.com/x/buy-poker/1", "a.com", "/x/buy-poker/1", None, "block"), ("x://a.com/casino-royale", "a.com", "/casino-royale", None, "allow"), ("x://a.com/b/porn.html?x", "a.com", "/b/porn.html", None, "block"), ("x://é.net/ü", "é.net", "/ü", "net/", "block"),
    ("x://a.net/" + "p" * 5000, "a.net", "/" + "p" * 5000, "net/", "block"), ("x://y://z.net/", "y:", "//z.net/", None, "allow"),
]


def test_urls(spark):
    df = spark.createDataFrame([(u, "old") for u, *_ in URLS], "url string, host string")
    got = [tuple(r) for r in url_filter.filter_urls(df).select("url", "host", "path", "rule", "verdict").collect()]
    assert got == URLS
    assert url_filter.filter_urls(df.limit(0)).count() == 0


def as_regex(glob):
    return re.compile("".join(".*" if p == "**" else "[^/]*" if p == "*" else re.escape(p) for p in re.findall(r"\*\*|.", glob)), re.S)


@pytest.mark.parametrize("most", [1 << 26, 0])
def test_automaton_against_regex(monkeypatch, most):
    """Also where the memory of steps is emptied all the time."""
    monkeypatch.setattr(url_filter, "MOST_BYTES", most)
    g = random.Random(3)
    globs = [re.sub(r"\*{2,}", "**", "".join(g.choice(["a", "b", "/", "*", "**"]) for _ in range(g.randint(0, 9)))) for _ in range(60)]
    m = url_filter.Automaton(globs)
    assert m.size > 128
    run = m.runner()
    for _ in range(1500):
        text = "".join(g.choice("ab/") for _ in range(g.randint(0, 12)))
        assert m.matched(run(text.encode())) == [i for i, x in enumerate(globs) if as_regex(x).fullmatch(text)]


def test_verdicts_of_all_globs():
    """The thousand default globs on URLs made of their own words, against regular expressions."""
    assert len(url_filter.GLOBS) > 1000
    g, tests = random.Random(9), [as_regex(x) for x in url_filter.GLOBS]
    run = (m := url_filter.Automaton(list(url_filter.GLOBS))).runner()
    for _ in range(400):
        word = lambda: g.choice(["", "news", "buy-", "a"]) + g.choice([*url_filter.UNWANTED, "x", "y", "z", ""]) + g.choice(["", "", ".html", ".php", "s"])
        url = f"{g.choice(['www.a', word()])}.com" + "".join(f"/{word()}" for _ in range(g.randint(0, 4)))
        assert m.matched(run(url.encode())) == [i for i, x in enumerate(tests) if x.fullmatch(url)]


def test_long_urls_and_many_globs():
    import time

    m = url_filter.Automaton(list(url_filter.GLOBS))
    for url in (b"a.com/" + b"p" * 1_000_000, b"a.com" + b"/q" * 500_000, b"casino.com/" + b"xyz-" * 250_000):
        began = time.perf_counter()
        m.runner()(url)
        assert time.perf_counter() - began < 0.5
    many = url_filter.Automaton([f"*.site{i}.com/**" for i in range(50_000)])
    assert many.matched(many.runner()(b"www.site4321.com/x")) == [4321]


def test_globs_of_a_table(spark):
    globs = url_filter.globs_of(spark.createDataFrame([("b.com/**",), (None,), ("a.*",), ("a.*",)], "glob string"))
    assert globs == ("a.*", "b.com/**")
    df = spark.createDataFrame([("x://a.org",), ("x://b.com/1",), ("x://c.com/1",)], "url string")
    assert [r["verdict"] for r in url_filter.filter_urls(df, rules=(("allow", "com/"), ("block", "org/")), globs=globs).collect()] == ["block", "allow", "allow"]
    ties = (("block", "ab.c/"), ("allow", "ab.c/"))  # of equal rules the earlier
    assert url_filter.filter_urls(spark.createDataFrame([("x://ab.c/",)], "url string"), rules=ties).first()["verdict"] == "block"


# --- nearest neighbours


def test_neighbours(spark):
    g = np.random.default_rng(5)
    x = g.normal(size=(3000, 16)).astype(np.float32)
    x[500:900] = x[3]  # a hot vector
    rows = [(i, v.tolist(), "old") for i, v in enumerate(x)]
    rows += [(5000, None, ""), (5020, [0.0] * 16, ""), (5040, [float("nan")] * 16, ""), (5060, [None] * 16, ""), (5080, [], ""), (None, x[0].tolist(), "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0, fit_rows=1000).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    x = x.astype(float)
    hits = 0
    assert sorted(got) == list(range(0, 3000, 20))
    for q, found in got.items():
        s = (x * x[q]).sum(axis=1)
        order = [i for i in np.lexsort((np.arange(len(x)), -s)) if i != q][:20]
        hits += len({i for i, _ in found} & set(order))
        assert [i for i, _ in found] == [i for i, _ in sorted(found, key=lambda z: (-z[1], z[0]))] and len(found) == 20
        assert all(abs(s[i] - v) < 1e-9 for i, v in found)
    assert hits / (20 * len(got)) >= 0.9
    assert ann.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.search(df.where("vec_id < 5"), F.col("vec_id") % 20 == 0).count() == 4


def test_every_row_is_a_candidate(spark):
    """Rows that share an id, also the query's, and vectors of rarer lengths take part, each in its own right."""
    rows = [(0, [1.0, 0.0]), (1, [5.0, 0.0]), (1, [3.0, 1.0]), (0, [2.0, 0.0]), (2, [1.0, 1.0, 1.0]), (20, [2.0, 0.0, 0.0]), (3, [4.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.search(df, F.col("vec_id") % 20 == 0).collect())
    first, second = [(1, 5.0), (3, 4.0), (1, 3.0), (0, 2.0)], [(1, 10.0), (3, 8.0), (1, 6.0), (0, 2.0)]
    assert got == sorted([(0, i + 1, *x) for a in (first, second) for i, x in enumerate(a)] + [(20, 1, 2, 2.0)])


def test_cells_grow_with_the_rows():
    assert [ann.centroids_for(n) for n in (10, 65_536, 10**6, 10**8, 10**12)] == [32, 32, 63, 200, 256]


# --- toxicity


def test_toxicity(spark, odd_docs, no_docs):
    g = random.Random(1)
    bad = ["vile", "nasty", "awful"]
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 6 == 0
        text = words(i, g.randint(5, 40), "abcd") + (" " + g.choice(bad) + " " + words(i + 9999, 5, "abcd") if toxic else "")
        rows.append((i, text))
        if i % 2 == 0:
            labels.append((i, int(toxic)))
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, known)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    held = [i for i, r in got.items() if r["held_out"]]
    assert 200 < len(held) < 400
    right = sum(got[i]["predicted"] == int(i % 6 == 0) for i in held)
    assert right / len(held) > 0.97
    again = toxicity.train(docs, known)
    assert np.allclose(model[1], again[1]) and model[2] == again[2]
    odd = toxicity.score(odd_docs, model).collect()
    assert len(odd) == 13 and all(0 <= r["score"] <= 1 for r in odd)
    assert toxicity.score(no_docs, toxicity.train(no_docs, known.limit(0))).count() == 0


def plain_risk(w, bias, positive, unlabelled, prior):
    """The two parts of the non-negative risk, document by document."""
    score = lambda doc: bias + sum(w[k] for k in doc)
    as_one, as_zero = (lambda f: math.log(1 + math.exp(-f))), (lambda f: math.log(1 + math.exp(f)))
    mean = lambda loss, docs: sum(loss(score(d)) for d in docs) / len(docs)
    return prior * mean(as_one, positive), mean(as_zero, unlabelled) - prior * mean(as_zero, positive)


def test_risk_against_loops():
    """The risk's parts by loops, its gradient by small differences, and the step's turn where the second part is negative."""
    g = np.random.default_rng(7)
    signs = set()
    for trial in range(12):
        docs = [[sorted(g.choice(5, int(g.integers(0, 5)), replace=False).tolist()) for _ in range(n)] for n in (6, 9)]
        sparse = [(np.repeat(np.arange(len(d)), [len(x) for x in d]), np.array([k for x in d for k in x], int), len(d)) for d in docs]
        w, bias, prior = g.normal(size=5) * 2, float(g.normal()) - trial % 2 * 2, (0.2, 0.8)[trial % 2]
        one, zero, grad = toxicity.risk(w, bias, *sparse, prior)
        assert np.allclose((one, zero), plain_risk(w, bias, *docs, prior))
        signs.add(zero >= 0)

        def aim(x, docs=docs, prior=prior, zero=zero):
            a, b = plain_risk(x[:-1], x[-1], *docs, prior)
            return a + b if zero >= 0 else -b

        x, h = np.append(w, bias), 1e-6
        slope = [(aim(x + h * e) - aim(x - h * e)) / (2 * h) for e in np.eye(6)]
        assert np.allclose(grad, slope, atol=1e-6)
    assert signs == {True, False}


def test_scores_against_loops(spark):
    words_, weights, bias = np.array(sorted(__import__("zlib").crc32(x) for x in (b"bad", b"good")), np.uint32), np.array([1.5, -2.0]), -0.25
    weigh = dict(zip(words_.tolist(), weights.tolist(), strict=True))
    texts = ["bad", "Good bad BAD", "", None, "goodbad, good!", "nothing " * 50_000 + "bad"]
    df = spark.createDataFrame([(i, t, 7.0, 9, "x") for i, t in enumerate(texts)], "doc_id long, text string, score double, predicted int, held_out string")
    got = toxicity.score(df, (words_, weights, bias)).orderBy("doc_id").collect()
    import zlib

    for r, t in zip(got, texts, strict=True):
        f = bias + sum(weigh.get(zlib.crc32(w.encode()), 0.0) for w in set(re.findall(r"[a-z]+", (t or "").lower())))
        assert math.isclose(r["score"], 1 / (1 + math.exp(-f)), rel_tol=1e-9) and r["predicted"] == int(f >= 0) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def test_an_id_counts_once(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "b"), (1, "a")] * 50 + [(i, f"t{i}") for i in range(2, 30)], "doc_id long, text string")
    seen = []
    real = toxicity.hashed_words
    monkeypatch.setattr(toxicity, "hashed_words", lambda rows: seen.append(sorted(map(tuple, rows.select("id", "text").collect()))) or real(rows))
    toxicity.train(docs, spark.createDataFrame([(1, 1), (1, 0), (2, 0)], "doc_id long, toxic int"))
    assert seen[0] in ([(1, "a")], []) and len(seen[1]) == len({i for i, _ in seen[1]})


# --- language


def test_language(spark, odd_docs, no_docs):
    kinds = {"aa": "abcde", "bb": "fghij"}
    rows = [(i, words(i, 3 + i % 50, kinds[k]), k if i % 10 else "aa" if k == "bb" else "bb", f"{k}{i % 3}") for i, k in enumerate(["aa", "bb"] * 150)]
    rows += [(900, "123 !?", "aa", "aa0"), (901, None, None, None), (902, "", "bb", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in language_id.identify(df, host_col="source").collect()}
    assert all(got[i]["detected"] == ("aa" if i % 2 == 0 else "bb") and got[i]["accepted"] for i in range(300))
    assert all(got[i]["detected"] == "und" and not got[i]["accepted"] and got[i]["confidence"] == 0 for i in (900, 901, 902))
    odd = language_id.identify(odd_docs, host_col="source").collect()
    assert len(odd) == 13 and language_id.identify(no_docs, host_col="source").count() == 0
    # Where a text says little, host and declaration decide.
    more = df.union(spark.createDataFrame([(950, "k", "bb", "bb1"), (951, "k", "aa", "aa1")], df.schema))
    few = {r["doc_id"]: r["detected"] for r in language_id.identify(more, host_col="source").where("doc_id >= 950").collect()}
    assert few == {950: "bb", 951: "aa"}
    pages = spark.createDataFrame([(i, words(i, 30, kinds[k]), k.upper() + "-XX", f"http://h{i % 4}.{k}/p") for i, k in enumerate(["aa", "bb"] * 40)], "page_id long, text string, html_lang string, url string")
    assert language_id.identify(pages, declared_col="html_lang", url_col="url").where("(detected = 'aa') <> (page_id % 2 = 0)").count() == 0


def test_rare_languages(spark):
    """A language is modelled however many rows others have; one with too few rows is not taken for a frequent one."""
    rows = [(i, words(i, 8, "abcde"), "aa", "s") for i in range(6000)] + [(7000 + i, words(i, 30, "fghij"), "bb", "s") for i in range(5)] + [(8000, words(1, 30, "klmno"), "cc", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: (r["detected"], r["accepted"]) for r in language_id.identify(df, host_col="source").where("doc_id >= 7000").collect()}
    assert got == {**{7000 + i: ("bb", True) for i in range(5)}, 8000: ("und", False)}


def test_copies_are_one_text_of_the_fit(spark):
    """A text copied thousands of times does not crowd the others out of the sample."""
    rows = [(words(i, 20, "abcde"), "aa") for i in range(40)] + [("zz zz zz", "aa")] * 4000
    df = spark.createDataFrame(rows, "t string, d string")
    names, model = language_id.fit_models(df, "d", "t", fit_rows=60)
    code = language_id.trigrams(["zz zz zz"])[0]
    assert names == ["aa"] and np.exp(model[code, 0]).max() < 0.05


def plain_posterior(rows, names, model):
    """The fused posterior of (text, declared, host), by loops over all rows."""
    text = language_id.text_scores([t for t, _, _ in rows], model)
    letters = [any(c.isalpha() for c in t) for t, _, _ in rows]
    said = text.argmax(axis=1)
    k = len(names)
    suffix = lambda h: h.rsplit(".", 1)[-1] if "." in h else ""
    corpus, by_suffix, by_host, table = np.ones(k), {}, {}, np.full((k, k), language_id.PULL_TABLE)
    for (_, d, h), s, fine in zip(rows, said, letters, strict=True):
        if fine:
            corpus[s] += 1
            by_suffix.setdefault(suffix(h), np.zeros(k))[s] += 1
            by_host.setdefault(h, np.zeros(k))[s] += 1
            if d in names:
                table[names.index(d), s] += 1
    corpus, table = corpus / corpus.sum(), np.log(table / table.sum(axis=0))
    pull = lambda c, up, by: (c + by * up) / (c.sum() + by)
    out = []
    for (_, d, h), s, fine in zip(rows, text, letters, strict=True):
        if not fine:
            out.append(("und", 0.0))
            continue
        prior = pull(by_host[h], pull(by_suffix[suffix(h)], corpus, language_id.PULL_SUFFIX), language_id.PULL_HOST)
        total = s + np.log(prior) + (table[names.index(d)] if d in names else 0)
        p = np.exp(total - total.max())
        out.append((names[int(total.argmax())], float(1 / p.sum())))
    return out


@pytest.mark.parametrize("broadcast", [50_000, 2])
def test_fusion_against_loops(spark, monkeypatch, broadcast):
    """Text, declaration, suffix and host, with hosts broadcast and with hosts joined by shuffle."""
    monkeypatch.setattr(language_id, "BROADCAST_HOSTS", broadcast)
    g = random.Random(6)
    kinds = {"aa": "abcde", "bb": "cdefg", "cc": "efghi"}
    rows = []
    for i in range(240):
        k = g.choice("aa aa bb cc".split())
        rows.append((words(i, g.choice((1, 1, 2, 12)), kinds[k]) if i % 31 else "12 34", g.choice([k, k, "", "aa"]), g.choice([f"h{i % 3}.{k}", f"x.{k}", "local", ""])))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string")
    names, model = language_id.fit_models(df.select("lang", "text"), "lang", "text")
    want = plain_posterior(rows, names, model)
    got = sorted(language_id.identify(df, host_col="source").collect(), key=lambda r: r["doc_id"])
    assert [r["detected"] for r in got] == [w[0] for w in want] and len({w[0] for w in want}) == 4
    assert np.allclose([r["confidence"] for r in got], [w[1] for w in want], atol=1e-6)


def test_pages_languages(spark):
    """Markup, suffix and host decide where the text says little; null and broken pages are und."""
    kinds = {"aa": "abcde", "bb": "fghij"}
    rows = [(i, f"http://s{i % 5}.{k}/p", f'<!DOCTYPE html><HTML class=x LANG="{k.upper()}-XX"><body><p>{words(i, 30, kinds[k])}</p></body></html>', "old") for i, k in enumerate(["aa", "bb"] * 40)]
    rows += [(100, "http://s1.bb/x", "<p>q</p>", ""), (101, "http://new.aa/x", '<meta http-equiv="content-language" content="aa"><p>q</p>', ""), (102, None, None, ""), (103, "http://s0.aa/", "", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, detected string")
    got = {r["page_id"]: r["detected"] for r in language_id.identify_pages(df).collect()}
    assert all(got[i] == ("aa" if i % 2 == 0 else "bb") for i in range(80)) and [got[i] for i in (100, 101, 102, 103)] == ["bb", "aa", "und", "und"]
    assert language_id.language_id_pages(spark, SMALL).where("not accepted").count() <= 2


def test_clashing_names_and_ties(spark):
    """Input columns named like outputs give way; languages that tie go by code point."""
    df = spark.createDataFrame([(i, words(i // 2, 9, "abc"), k, 0.5, True, "x") for i, k in enumerate(["bb", "aa"] * 20)], "doc_id long, text string, lang string, confidence double, accepted boolean, detected string")
    out = language_id.identify(df, declared_col="lang")
    assert sorted(out.columns) == sorted(df.columns)
    blank = language_id.identify(df.withColumn("lang", F.lit(None).cast("string")), declared_col="lang").collect()
    assert {r["detected"] for r in blank} == {"und"} and out.where("detected = 'aa'").count() == 40


def test_trigram_scores_against_loop():
    g = np.random.default_rng(0)
    model = g.normal(size=(language_id.BUCKETS, 3)).astype(np.float32)
    texts = ["", "a", "Ab c", "é🎉", "x" * 50]
    want = []
    for t in texts:
        b = b" " + t.lower().encode() + b" "
        total = np.zeros(3)
        for i in range(len(b) - 2):
            code = (b[i] << 16 | b[i + 1] << 8 | b[i + 2]) * 2654435761 % (1 << 32) >> 16
            total += model[code]
        want.append(total * language_id.TEMPER)
    assert np.allclose(language_id.text_scores(texts, model), want, atol=1e-3)


# --- HTML

PAGE = """<html><head><title>T</title><style>p{}</style><script>if (a<b) "</p>"</script></head><body><header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a></ul></nav>
<div class="cookie-notice">We use cookies</div><div id="main">%s</div><aside>Side</aside><form>Name <input></form><div class="comments"><p>Nice post indeed, thanks a lot for all of it!</p></div><footer>&copy; me</footer></body></html>"""


@pytest.mark.parametrize(
    "html, want",
    [
        (None, ""), ("", ""), ("<p></p>", ""), ("plain &amp; simple", "plain & simple"), ("<p>a\n  b<br>c</p><p>d", "a b c\nd"), ("5 < 6 <b>and</b> &eacute;&#33;", "5 < 6 and é!"),
        (PAGE % "<p>First paragraph with <a href=y>a link</a> in it.<p>Second one; it is long enough to be an article of its own.", "First paragraph with a link in it.\nSecond one; it is long enough to be an article of its own."),
        ("<article><header><h1>Head</h1></header><p>x<div class=ad>buy</div><p>y</article><p>more", "Head\nx\ny"), ("<!-- <p>no</p> --><p>yes", "yes"), ("<nav>only menu</nav>", ""),
    ],
)
def test_main_text(html, want):
    assert html_text.main_text(html) == want


LONG = "A paragraph that is long enough to be the middle of an article by itself, whatever stands around it."


@pytest.mark.parametrize(
    "inner",
    [
        f"<p>{LONG}<h2><a href=x>Heading</a></h2><ul><li><a href=y>item</a><li><a href=z>other</a></ul><p><a href=s>source</a><p>{LONG}",
        f"<h1>Title</h1><p>By me<p>Today<p>At noon<p>In town<p>{LONG}<p>Yes.<p>So it is.<p>The end.<p>Bye.",
        "<p><a href=x>Only a link</a>",
    ],
)
def test_no_line_of_an_article_is_lost(inner):
    """Linked lines in the middle and short lines at the ends stay, in a page that marks no article; lines of other containers go."""
    want = [x.strip() for x in re.sub(r"<[^>]*>", "\n", inner).split("\n") if x.strip()]
    assert html_text.main_text(PAGE % inner).split("\n") == want
    if LONG in inner:
        got = html_text.main_text(PAGE.replace("<aside>", "<div>Elsewhere</div><div>Else</div><div>More</div><aside>") % inner).split("\n")
        assert got[: len(want)] == want and "More" not in got


@pytest.mark.parametrize(
    "html, want",
    [
        (f'<div class="content has-sidebar"><p>{LONG}</div>', LONG), (f'<div class="no-sidebar"><p>{LONG}</div>', LONG), (f'<div class="sidebar-layout"><p>{LONG}<p>{LONG}</div>', f"{LONG}\n{LONG}"),
        (f"<form id=aspnet><p>{LONG}</form>", LONG), (f'<div class="content has-sidebar"><p>{LONG}</div><div class="left-sidebar"><p>Other things to read</div>', LONG),
        (f"<div><p>{LONG}</p><p><a href=r>See the full report here</a></p><p>{LONG}</p></div>", f"{LONG}\nSee the full report here\n{LONG}"),
        (f"<article><p>short teaser</article><div><p>{LONG}<p>{LONG}</div>", f"{LONG}\n{LONG}"), (f"<article><p>{LONG}</article><article><h2>Card</h2></article>", LONG),
        (f"<article><p>{LONG}</article><article><p>{LONG} Again.</article>", f"{LONG}\n{LONG} Again."), (f"<div><p>{LONG}</div><div class=comments><p>{LONG}<p>{LONG}<p>{LONG}</div>", LONG),
    ],
)
def test_wrappers_cards_and_links(html, want):
    """Classes that describe a layout, forms around a page, teaser cards and lines of links lose no article."""
    assert html_text.main_text(html) == want


@pytest.mark.parametrize("unit", ["<a ", "<a x='", "<b>", "</i>", "<b><div></div>", "<!-", "<![CDATA[", "</script ", "<title>", "<p><b>", "&amp", '<a "x> y', "<div class=nav>"])
def test_time_is_linear(unit):
    """A megabyte of broken markup takes about a second or less; text that is read again and again would take hours."""
    import time

    html = unit * (1_000_000 // len(unit)) + "'"
    began = time.perf_counter()
    html_text.main_text(html)
    html_text.main_text("<p>" + html + '"')
    assert time.perf_counter() - began < 12


def test_unmarked_pages_against_brute_force():
    """Pages without marked parts against a plain search for the outermost windows, line by line."""
    g = random.Random(8)
    for _ in range(300):
        lines = [words(g.randint(0, 1 << 30), g.choice((1, 1, 2, 3, 12, 25))) for _ in range(g.randint(1, 14))]
        links = [g.random() < 0.3 for _ in lines]
        rooms = sorted(g.randint(0, 3) for _ in lines)
        html = "".join("<div>" * (i == 0 or rooms[i] != rooms[i - 1]) + (f"<p><a href=x>{t}</a></p>" if a else f"<p>{t}</p>") + "</div>" * (i + 1 == len(lines) or rooms[i] != rooms[i + 1]) for i, (t, a) in enumerate(zip(lines, links, strict=True)))
        w = [0 if a else len(t) for t, a in zip(lines, links, strict=True)]
        starts = [i for i in range(len(w)) if w[i] and sum(w[i : i + 3]) >= 60]
        ends = [i for i in range(len(w)) if w[i] and sum(w[max(0, i - 2) : i + 1]) >= 60]
        if starts:
            first, last = starts[0], ends[-1]
            keep = [i for i in range(len(w)) if first <= i <= last or rooms[i] in (rooms[first], rooms[last])]
        else:
            keep = range(len(w))
        assert html_text.main_text(html) == "\n".join(lines[i] for i in keep)


def test_pages(spark):
    got = html_text.op8_html_extraction(spark, SMALL).collect()
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    assert len(got) == len(pages)
    for r in got:
        html = pages[r["page_id"]]["html"]
        inner = re.search(r"(?s)<article>(.*?)(</article>|<footer>|$)", html)[1]
        inner = re.sub(r"<[^>]*>", "", re.sub(r"<br>", " ", re.sub(r"</?(p|h1)>", "\n", inner)))
        from html import unescape

        assert r["text"] == "\n".join(x for x in (re.sub(r"\s+", " ", unescape(y)).strip() for y in inner.split("\n")) if x)
        assert r["n_chars"] == len(r["text"])
    long = spark.createDataFrame([(1, "<p>" + "word " * 200_000, "old"), (2, None, None)], "page_id long, html string, text string")
    assert [r["n_chars"] for r in html_text.extract_text(long).orderBy("page_id").collect()] == [999_999, 0]


def test_surge_and_dive():
    w = np.array([0, 5, 0, 0, 0, 90, 10, 80, 0, 0, 0, 4])
    assert html_text.surge_to_dive(w, 3, 60) == (5, 8)
    assert html_text.surge_to_dive(w, 1, 1000) == (0, 0) and html_text.surge_to_dive(np.zeros(0, int), 3, 1) == (0, 0)


# --- mixing


def plain_quotas(sizes, words_in_all, weights, most):
    """The same by small steps of water into the sources."""
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    w = [weights[i % len(weights)] for i in range(len(order))]
    lo, hi = 0.0, 1e12
    for _ in range(200):
        level = (lo + hi) / 2
        if sum(min(most * n, level * k) for (_, n), k in zip(order, w, strict=True)) < words_in_all:
            lo = level
        else:
            hi = level
    return {s: min(most * n, hi * k) for (s, n), k in zip(order, w, strict=True)}


def test_quotas():
    g = random.Random(2)
    for _ in range(30):
        sizes = [(f"s{i}", g.randint(0, 1000)) for i in range(g.randint(1, 9))] + [(None, g.randint(1, 50))]
        total = 1.5 * sum(n for _, n in sizes)
        got, want = mixing.quotas(sizes, total, (3, 1, 2), 2), plain_quotas(sizes, total, (3, 1, 2), 2)
        assert all(math.isclose(got[s], want[s], rel_tol=1e-6, abs_tol=1e-3) for s, _ in sizes)


def test_flow_is_cheapest():
    """Against all integer flows of a small overlapping case."""
    supply, demand, arcs = [3.0, 2.0, 2.0], [4.0, 3.0], [(0, 0), (1, 0), (1, 1), (2, 1)]
    flow = mixing.min_cost_flow(supply, demand, arcs, 2)
    total = lambda s: sum(f.get(s, 0) for f in flow)
    assert math.isclose(total(0), 4) and math.isclose(total(1), 3)
    cost = lambda x, n: min(x, n) + 3 * max(0, x - n)
    mine = sum(cost(sum(f.values()), n) for f, n in zip(flow, supply, strict=True))
    best = min(
        cost(a, 3) + cost(b + c, 2) + cost(d, 2)
        for a in range(7) for b in range(5) for c in range(5) for d in range(5)
        if a + b == 4 and c + d == 3 and b + c <= 4 and a <= 6 and d <= 4
    )
    assert math.isclose(mine, best)


def test_every_quota_comes_from_the_flow(spark, monkeypatch):
    """Sources of one pattern each are networks of their own, solved like others."""
    solved = []
    real = mixing.shortest_paths
    monkeypatch.setattr(mixing, "shortest_paths", lambda *a: solved.append(real(*a)) or solved[-1])
    got = mixing.op9_mixing(spark, SMALL).collect()
    assert len(solved) == len({r["source_size"] for r in got}) > 3
    assert sorted(sum(f[0].values()) for f in solved) == pytest.approx(sorted({r["source_size"]: r["target"] for r in got}.values()))
    assert mixing.min_cost_flow([5.0, 0.0], [12.0, 3.0], [(0, 0), (1, 1)], 2) == [{0: 10.0}, {}]


def test_mix(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    once = {r["doc_id"]: r for r in mixing.mix_by_source(docs).collect()}
    again = {r["doc_id"]: r["taken"] for r in mixing.mix_by_source(docs.repartition(7)).collect()}
    assert again == {k: r["taken"] for k, r in once.items()}
    by = {}
    for r in once.values():
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) and r["taken"] in (0, r["size"], 2 * r["size"])
        by.setdefault(r["source"], []).append(r)
    for rows in by.values():
        largest = max(r["size"] for r in rows)
        assert rows[0]["source_size"] == sum(r["size"] for r in rows)
        assert abs(sum(r["taken"] for r in rows) - rows[0]["target"]) <= largest
    want = plain_quotas([(s, rows[0]["source_size"]) for s, rows in by.items()], 1.5 * sum(r["size"] for r in once.values()), (3, 1, 2), 2)
    assert all(math.isclose(want[s], rows[0]["target"], rel_tol=1e-6) for s, rows in by.items())
    odd = mixing.mix_by_source(odd_docs).collect()
    assert len(odd) == 13 and {r["source"] for r in odd} == {None, "", "a", "b", "c"} and all(isinstance(r["size"], int) for r in odd)
    assert mixing.mix_by_source(no_docs).count() == 0


def test_mix_of_overlapping_sources(spark):
    rows = [(i, ["a"] if i % 3 == 0 else ["a", "b"] if i % 3 == 1 else ["b", None], 10) for i in range(300)] + [(999, [], 5), (998, None, 5)]
    df = spark.createDataFrame(rows, "doc_id long, sources array<string>, n long")
    got = mixing.mix(df, F.col("sources"), F.col("n"), F.col("doc_id")).collect()
    assert sum(r["taken"] for r in got) == pytest.approx(4500, abs=40)
    assert all(r["taken"] == 0 for r in got if r["doc_id"] >= 998) and json


def test_language_portions(monkeypatch):
    """Texts are scored in order, in lists of bounded size; a longer text is a list of its own."""
    from tessera.llm import language_id as L

    monkeypatch.setattr(L, "PORTION", 5)
    assert list(L.portions(["abc", "de", "fghijkl", "", "m"])) == [["abc", "de"], ["fghijkl"], ["", "m"]]
    assert list(L.portions([])) == []

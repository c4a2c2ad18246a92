"""Language identification by Bayesian evidence fusion.

Four kinds of evidence about a page meet in one posterior: the likelihood of its text under byte-trigram models, the
language its markup declares, the suffix of its address, and a prior of its host. How far declarations and suffixes are to
be believed, and the host priors, come from grouped aggregations over all rows of what the text alone says. A host's prior
is smoothed towards its suffix's, and that towards the whole corpus's. Only the trigram models are fitted on a sample,
bounded by ``FIT_ROWS`` a declared language; texts are always read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ROW, checkpoint, give_back, join_unique, packed, small_batches, table, unpacked
from .html_text import extract_text
from .url_filter import host_of

BUCKETS = 1 << 16
#: Most rows a declared language that the trigram models are fitted on, and most languages modelled.
FIT_ROWS, MAX_LANGUAGES = 1500, 200
#: A tongue needs so many declared rows to be modelled, in a corpus of any size. Rows that declare another one stay unjudged.
LEAST_ROWS = 5
#: Pseudo-counts that pull a host to its suffix, a suffix to the corpus, and a reliability table to uniform.
PULL_HOST, PULL_SUFFIX, PULL_TABLE = 20.0, 50.0, 1.0
#: Trigrams overlap and are far from independent: their log-likelihood is scaled down so.
TEMPER = 0.2
#: At most so many hosts have their priors broadcast (a few MB); beyond it they are joined by shuffle.
BROADCAST_HOSTS = 50_000
PORTION = 1 << 20
OUTPUT = ("detected", "confidence", "accepted")


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each byte trigram of all lower-cased texts, number of them in each text). One space pads either end."""
    raw = [b" " + t.lower().encode("utf-8", "replace") + b" " for t in texts]
    size = np.array([len(x) - 2 for x in raw], np.int64)  # at least 0
    b = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32)
    code = (b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]) * np.uint32(2654435761) >> np.uint32(16) if len(b) > 2 else np.zeros(0, np.uint32)
    ends = np.cumsum(size + 2)
    good = np.ones(len(code), bool)
    for k in (-1, -2):  # trigrams that reach over a text's end
        at = ends + k
        good[at[at < len(code)]] = False
    return code[good], size


def portions(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, in lists of at most ``PORTION`` characters or one text: scoring takes some 20 bytes a character."""
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size > PORTION and i > begin:
            yield texts[begin:i]
            begin, size = i, len(t)
    if begin < len(texts):
        yield texts[begin:]


def text_scores(texts: list[str], model: np.ndarray) -> np.ndarray:
    """texts x languages: tempered log-likelihoods. An empty text scores 0 everywhere."""
    code, size = trigrams(texts)
    out = np.zeros((len(texts), model.shape[1]))
    begin = np.cumsum(size) - size
    full = np.flatnonzero(size > 0)
    if len(full):
        for k in range(model.shape[1]):  # by column, so that the largest array is one float a byte
            out[full, k] = np.add.reduceat(model[:, k][code], begin[full])
    return out * TEMPER


def fit_models(rows: DataFrame, declared: str, text: str, fit_rows: int = FIT_ROWS) -> tuple[list[str], np.ndarray]:
    """(languages by code point, 65,536 x languages of log probabilities), from at most ``fit_rows`` texts of each declared one.

    The sample is the distinct texts of least hash, so it is the same in every run and copies of one text count as one;
    trigram counts are summed on the executors.
    """
    known = rows.where(F.col(declared).isNotNull() & (F.trim(declared) != "")).withColumn("__h", F.xxhash64(text))
    n = known.groupBy(declared).agg(F.count(F.lit(1)).alias("count"), F.approx_count_distinct("__h").alias("texts"))
    n = n.where(F.col("count") >= LEAST_ROWS).orderBy(F.desc("count"), declared).limit(MAX_LANGUAGES).collect()
    names = sorted(r[declared] for r in n)
    if not names:
        return ["und"], np.zeros((BUCKETS, 1), np.float32)
    # Of each language, a share of texts by hash that holds about twice fit_rows; then the least hashes exactly.
    share = {r[declared]: min(1.0, 2.0 * fit_rows / max(1, r["texts"])) for r in n}
    level = F.create_map(*[F.lit(x) for k in names for x in (k, share[k])])[F.col(declared)]
    pool = known.where(F.col(declared).isin(names)).where(F.pmod("__h", F.lit(1_000_000)) < level * 1_000_000).dropDuplicates([declared, "__h"])
    pool = pool.withColumn("__k", F.row_number().over(Window.partitionBy(declared).orderBy("__h"))).where(f"__k <= {fit_rows}")
    place = {k: i for i, k in enumerate(names)}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(names), BUCKETS), np.int64)
        for b in batches:
            for lang, part in b.groupby(b.columns[0]):
                total[place[lang]] += np.bincount(trigrams(list(part.iloc[:, 1]))[0], minlength=BUCKETS)
        for lang, k in place.items():
            at = np.flatnonzero(total[k])
            if len(at):
                yield pd.DataFrame({"lang": lang, "at": [at.astype("<i4").tobytes()], "n": [total[k][at].astype("<i8").tobytes()]})

    counts = np.full((BUCKETS, len(names)), 0.1)
    for r in pool.select(declared, text).mapInPandas(count, "lang string, at binary, n binary").toLocalIterator():
        counts[np.frombuffer(r["at"], "<i4"), place[r["lang"]]] += np.frombuffer(r["n"], "<i8")
    return names, np.log(counts / counts.sum(axis=0)).astype(np.float32)


def suffix_of(host: Column) -> Column:
    """The last label of a host that has several, else empty."""
    return F.when(host.contains("."), F.substring_index(host, ".", -1)).otherwise(F.lit(""))


def identify(docs: DataFrame, text_col: str = "text", declared_col: str | None = "lang", host_col: str | None = None, url_col: str | None = None, keep: tuple[str, ...] | None = None, accept: tuple[str, ...] | None = None, least: float = 0.5, fit_rows: int = FIT_ROWS, inside: tuple[str, str] | None = None) -> DataFrame:
    """Each row of ``docs`` with ``detected, confidence, accepted``.

    ``inside`` names a kept struct column and its field that holds the text, in place of ``text_col``: long texts are then
    carried once.

    ``host_col`` names the host, or ``url_col`` an address to take it from. A row is accepted when its text holds a letter,
    its best language's posterior is at least ``least``, and ``accept`` (default: all modelled) has that language. A text
    without any letter is ``und`` with confidence 0, and so is one that declares a language without a model. Of languages with
    the same posterior the first by code point counts. Missing declarations, hosts and suffixes (null or empty) are no
    evidence. Input columns named like an output are replaced; repeated rows are judged alike; an empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    if inside:
        place, beside = F.col(ROW)[inside[0]][inside[1]], []
    elif text_col in (docs.columns if keep is None else keep) and text_col not in OUTPUT:
        place, beside = F.col(ROW)[text_col], []
    else:
        place, beside = F.col("__text"), [docs[f"`{text_col}`"].alias("__text")]
    text = F.coalesce(place, F.lit(""))
    tag = F.lower(F.trim(F.coalesce(docs[f"`{declared_col}`"], F.lit("")))) if declared_col else F.lit("")
    host = host_of(docs[f"`{url_col}`"]) if url_col else F.coalesce(docs[f"`{host_col}`"], F.lit("")) if host_col else F.lit("")
    rows = docs.select(packed(docs, OUTPUT, keep), *beside, F.regexp_extract(tag, "^[a-z]*", 0).alias("__declared"), host.cast("string").alias("__host"))
    names, model = fit_models(rows.select("__declared", text.alias("__text")), "__declared", "__text", fit_rows)
    models = spark.sparkContext.broadcast(model)  # 65,536 floats a language, at most MAX_LANGUAGES of them

    @F.pandas_udf("array<double>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in map(list, batches):
            out: list[np.ndarray] = []
            for part in portions(texts):
                out += list(text_scores(part, models.value))
            yield pd.Series(out)
        give_back()

    letters = text.rlike(r"\p{L}") & F.col("__declared").isin(["", *names])  # and can be judged
    scored = rows.withColumn("__s", score(text))
    best = F.array_position("__s", F.array_max("__s")).cast("int") - 1
    said = scored.where(letters).groupBy("__host", "__declared", best.alias("l")).count()
    said = said.persist() if len(names) > 1 else said
    try:
        # Corpus, then suffixes, then declarations: bounded by languages and suffixes; hosts stay distributed.
        with_suffix = said.withColumn("s", suffix_of(F.col("__host")))
        by_tag = {(r["__declared"], r["l"]): r["n"] for r in said.groupBy("__declared", "l").agg(F.sum("count").alias("n")).where(F.col("__declared").isin(names)).collect()}
        corpus = np.ones(len(names))
        for r in said.groupBy("l").agg(F.sum("count").alias("n")).collect():
            corpus[r["l"]] += r["n"]
        by_host = with_suffix.groupBy("__host", "s", "l").agg(F.sum("count").alias("n"))
        corpus_p = corpus / corpus.sum()
        base = F.array(*[F.lit(float(p)) for p in corpus_p])
        slots = lambda of: F.array(*[F.sum(F.when(F.col("l") == k, F.col(of)).otherwise(0)).cast("double") for k in range(len(names))])
        suffixes = by_host.groupBy("s").agg(slots("n").alias("c"))
        pulled = lambda c, up, pull: F.zip_with(c, up, lambda x, u: (x + pull * u) / (F.aggregate(c, F.lit(0.0), lambda a, y: a + y) + pull))
        suffixes = suffixes.select("s", pulled(F.col("c"), base, PULL_SUFFIX).alias("up"))
        hosts = by_host.groupBy("__host", "s").agg(slots("n").alias("c"), F.sum("n").alias("n")).join(suffixes, "s")
        hosts = hosts.select("__host", "n", F.transform(pulled(F.col("c"), F.col("up"), PULL_HOST), lambda p: F.log(p)).alias("__prior"))
        # P(declared | language); a suffix enters through the prior that hosts are pulled to.
        rely = np.full((len(names), len(names)), PULL_TABLE)
        for (d, k), n in by_tag.items():
            rely[names.index(d), k] += n
        rely = np.log(rely / rely.sum(axis=0))
        count = hosts.count()
        hosts = spark.createDataFrame(hosts.collect(), hosts.schema) if count <= BROADCAST_HOSTS else hosts
    finally:
        said.unpersist()
    whole = F.array(*[F.lit(float(x)) for x in np.log(corpus_p)])
    evidence = F.create_map(*[x for i, d in enumerate(names) for x in (F.lit(d), F.array(*[F.lit(float(v)) for v in rely[i]]))])
    if count <= BROADCAST_HOSTS:
        out = scored.join(F.broadcast(hosts.drop("n")), "__host", "left")
    else:
        out = join_unique(checkpoint(scored.withColumn("__letters", letters).drop("__text")), hosts, "__host", F.col("n"), docs.count(), "left")
        letters = F.col("__letters")
    none = F.array_repeat(F.lit(0.0), len(names))
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    out = out.withColumn("__s", add(add(F.col("__s"), F.coalesce("__prior", whole)), F.coalesce(F.try_element_at(evidence, F.col("__declared")), none)))
    top = F.array_max("__s")
    out = out.withColumn("confidence", F.when(letters, F.lit(1.0) / F.aggregate(F.transform("__s", lambda x: F.exp(x - top)), F.lit(0.0), lambda a, x: a + x)).otherwise(0.0))
    out = out.withColumn("detected", F.when(letters, F.element_at(F.array(*[F.lit(x) for x in names]), F.array_position("__s", top).cast("int"))).otherwise("und"))
    fine = F.col("detected").isin(list(accept)) if accept else F.lit(True)
    out = out.withColumn("accepted", letters & (F.col("confidence") >= least) & fine)
    return out.select(*unpacked(out), *OUTPUT)


#: Where a page declares its language: the root element's attribute, else a meta element (fixed patterns).
MARKUP = (r"""(?is)<html\b[^>]*?\s(?:xml:)?lang\s*=\s*["']?\s*([a-z]+)""", r"""(?is)<meta\b[^>]*?content-language[^>]*?\bcontent\s*=\s*["']?\s*([a-z]+)""")


def declared_by(html: Column) -> Column:
    """The primary language tag that markup declares, in lower case; empty if none."""
    found = [F.lower(F.regexp_extract(F.coalesce(html, F.lit("")), pattern, 1)) for pattern in MARKUP]
    return F.when(found[0] != "", found[0]).otherwise(found[1])


def identify_pages(pages: DataFrame, html_col: str = "html", url_col: str = "url", **how) -> DataFrame:
    """Each row of ``pages`` with ``detected, confidence, accepted``: likelihood of the extracted main text, the markup's own
    declaration, the suffix of the address and the host's prior. Null html is an empty text, a null url no evidence."""
    rows = extract_text(pages.select(pages[f"`{html_col}`"].alias("html"), pages[f"`{url_col}`"].alias("url"), packed(pages).alias("page")))
    rows = rows.select("page", "text", "url", declared_by(F.col("html")).alias("lang"))
    found = identify(rows, url_col="url", keep=("page",), **how)
    kept = [c for c in pages.columns if c not in OUTPUT]
    return found.select(*[F.col("page")[c].alias(c) for c in kept], *OUTPUT)


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every page, with the evidence of markup, address suffix and host."""
    return identify_pages(table(spark, sf_dir, "pages")).select("page_id", *OUTPUT)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document: its declared language as markup's, its source as host."""
    docs = table(spark, sf_dir, "documents")
    return identify(docs, host_col="source", keep=("doc_id",)).select("doc_id", *OUTPUT)

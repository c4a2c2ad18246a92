"""Toxicity classification by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; documents without regard to any label are the unlabelled set. A linear model on
the presence of words minimises the non-negative risk estimator: with class prior p, ``p * R+(pos) + max(0, R-(unlabelled) -
p * R-(pos))``; where the bracket turns negative, the step goes against it, as overfitting shows there. The prior is the
toxic share of all labelled training rows. Scores are logistic, so 0.5 is the Bayes boundary under that prior.

The fit runs in numpy on the driver on samples bounded by ``MOST_POSITIVE`` and ``MOST_UNLABELLED`` documents (those of least
hash); each sampled document arrives as its distinct words' hashes. Scoring reads every whole text on the executors.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW, packed, small_batches, table, unpacked

MOST_POSITIVE, MOST_UNLABELLED = 3000, 9000
#: The least positives a word must occur in to be weighed, and how far from chance; the samples bound the words.
LEAST_POSITIVES, LEAST_Z = 3, 4
WORD = re.compile(r"[^\W\d_]+")
STEPS, RATE, DECAY = 300, 0.05, 1e-4
OUTPUT = ("held_out", "score", "predicted")


def word_set(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from: crc32 of the id as text is divisible by 5. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


Sparse = tuple[np.ndarray, np.ndarray, int]  # row and word of each entry of a 0/1 matrix, rows


def risk(w: np.ndarray, bias: float, positive: Sparse, unlabelled: Sparse, prior: float) -> tuple[float, float, np.ndarray]:
    """(prior * R+(positive), R-(unlabelled) - prior * R-(positive), the gradient to step along) under the logistic loss.

    The risk is the first plus the second where that is not negative. Where it is, the step is the gradient of its negation.
    """
    (rp, kp, n), (ru, ku, m) = positive, unlabelled
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    fp, fu = bias + np.bincount(rp, w[kp], n), bias + np.bincount(ru, w[ku], m)
    as_positive = prior * np.logaddexp(0, -fp).mean()
    negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
    # Gradients by document: of the loss as positive (s - 1) and as negative (s).
    gp, gu = prior * (sigmoid(fp) - 1) / n, np.zeros(m)
    hp, hu = -prior * sigmoid(fp) / n, sigmoid(fu) / m
    gp, gu = (gp + hp, gu + hu) if negative >= 0 else (-hp, -hu)
    grad = np.bincount(kp, gp[rp], len(w)) + np.bincount(ku, gu[ru], len(w))
    return as_positive, negative, np.append(grad, gp.sum() + gu.sum())


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, seed: int = 5) -> tuple[np.ndarray, np.ndarray, float]:
    """(word hashes, weights, bias) from the word-hash arrays of the documents of each set."""
    prior = min(1 - 1e-6, max(prior, 1e-6))
    nothing = np.zeros(0, np.uint32), np.zeros(0), float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled:
        return nothing
    pos, unl = np.concatenate(positive), np.concatenate(unlabelled)
    words, n = np.unique(pos, return_counts=True)
    words, n = words[n >= LEAST_POSITIVES], n[n >= LEAST_POSITIVES]
    seen, m = np.unique(unl, return_counts=True)
    at = np.minimum(np.searchsorted(seen, words), max(0, len(seen) - 1))
    m = np.where(seen[at] == words, m[at], 0) if len(seen) else np.zeros(len(words))
    p, q = n / len(positive), (m + 1) / (len(unlabelled) + 1)
    z = (p - q) / np.sqrt(np.maximum(q * (1 - q), 1e-9) / len(positive))  # words commoner among positives than by chance
    words = words[np.abs(z) > LEAST_Z]
    if not len(words):
        return nothing

    def matrix(docs: list[np.ndarray]) -> Sparse:
        row = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        flat = np.concatenate(docs)
        k = np.minimum(np.searchsorted(words, flat), len(words) - 1)
        good = words[k] == flat
        return row[good], k[good], len(docs)

    sets = matrix(positive), matrix(unlabelled)
    w, bias = np.zeros(len(words)), nothing[2]
    state = [np.zeros(len(words) + 1), np.zeros(len(words) + 1)]
    for step in range(1, STEPS + 1):
        g = risk(w, bias, *sets, prior)[2]
        g[:-1] += DECAY * w
        for s, x, b in ((0, g, 0.9), (1, g * g, 0.999)):
            state[s] = b * state[s] + (1 - b) * x
        move = RATE * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:-1], bias - float(move[-1])
    return words, w, bias


def sample(rows: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows of (id, text): those of least hash. Two steps, so that no task orders all rows."""
    n = rows.count()
    if n > 2 * most:
        rows = rows.where(F.pmod(F.xxhash64(F.lit(8), "id"), F.lit(1_000_000)) < 2.0 * most / n * 1_000_000)
    return rows.orderBy(F.xxhash64("id"), "id").limit(most)


def hashed_words(rows: DataFrame) -> list[np.ndarray]:
    """The distinct words of each text as sorted 32-bit hashes; rows come to the driver, so callers bound them."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"w": [np.unique(np.array([zlib.crc32(w.encode("utf-8", "replace")) for w in word_set(t)], "<u4")).tobytes() for t in b["text"]]})

    return [np.frombuffer(r["w"], "<u4") for r in rows.select("text").mapInPandas(work, "w binary").toLocalIterator()]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[np.ndarray, np.ndarray, float]:
    """Fit on documents that are not held out. Rows of ``labels`` without an id or label say nothing; an id labelled more than
    once counts as toxic if any label says so. Labels other than 1 count only in the class prior."""
    known = labels.select(labels[f"`{id_col}`"].alias("id"), labels[f"`{label_col}`"].alias("y")).where("id is not null and y is not null").where(~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.max((F.col("y") == 1).cast("int")).alias("y"))
    n, ones = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    prior = min(0.9, max(0.005, ones / n)) if n else 0.05
    texts = docs.select(docs[f"`{id_col}`"].alias("id"), F.coalesce(docs[f"`{text_col}`"], F.lit("")).alias("text")).where("id is not null").where(~held_out(F.col("id")))
    # Ids first: texts are fetched for the sampled ids alone, at most MOST_POSITIVE and MOST_UNLABELLED; of an id's texts the least.
    toxic = sample(known.where("y = 1").select("id"), MOST_POSITIVE)
    any_ids = sample(texts.select("id"), MOST_UNLABELLED)
    fetch = lambda ids: hashed_words(texts.join(F.broadcast(ids.distinct()), "id").groupBy("id").agg(F.min("text").alias("text")))
    return fit(fetch(toxic), fetch(any_ids), prior)


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] | None = None) -> DataFrame:
    """Each row of ``docs`` with ``held_out, score, predicted``, from its whole text. Null and empty texts get the bias's score.

    Input columns named like an output are replaced; repeated rows score alike; an empty table gives an empty result.
    """
    words, weights, bias = model
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(({int(k): float(w) for k, w in zip(words, weights, strict=True)}, float(bias)))  # words of the sample

    @F.pandas_udf("double")
    def judge(texts: pd.Series) -> pd.Series:
        weigh, base = sent.value
        known: dict[str, float] = {}
        out = []
        for t in texts:
            total = base
            if len(known) > 400_000:
                known.clear()
            for w in word_set(t):
                x = known.get(w)
                if x is None:
                    x = known[w] = weigh.get(zlib.crc32(w.encode("utf-8", "replace")), 0.0)
                total += x
            out.append(total)
        return pd.Series(1 / (1 + np.exp(-np.clip(np.round(out, 9), -40, 40))))

    rows = docs.select(packed(docs, OUTPUT, keep), held_out(docs[f"`{id_col}`"]).alias("held_out"), judge(docs[f"`{text_col}`"]).alias("score"))
    return rows.select(*unpacked(rows), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, train(docs, table(spark, sf_dir, "labels")), keep=("doc_id",)).select("doc_id", *OUTPUT)

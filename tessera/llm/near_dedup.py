"""Near-duplicate detection: improved consistent weighted sampling over TF-IDF word shingles, banded and verified.

1. Document frequencies of five-word shingles are counted over all documents in a table of hashed slots of fixed size. What
   other shingles add to a slot is a constant share of the documents at any corpus size; it is subtracted, and a shingle in
   less than ``RARE`` of the documents has the full inverse frequency, so that a pair weighs alike in small and large corpora.
2. Each document becomes a weighted set (term count times a damped inverse document frequency) and 30 consistent samples
   of it (Ioffe's scheme, its random triples read from a table). Documents with equal sets collapse into one class.
3. Ten bands of three samples key the buckets. In a small bucket all pairs are weighed by the share of equal samples and an
   upper bound from the total weights; pairs that can reach the threshold are verified by exact weighted Jaccard similarity.
4. Each member of large buckets is dealt, by the hash of its set, into one block of its largest bucket and one of its least.
   Blocks are compared exactly, all sets with all by matrix products, and so are a few hubs of each block again, until one block is left.
5. Components of the links come from label propagation with pointer jumping. Members outside their bucket's main component
   are then compared exactly with every member of their large buckets that is in another component, block by block, and
   linked: no pair of a large bucket is left uncompared across components, and no block depends on how rows were dealt.

Nothing that grows with the documents is collected: the driver sees the slot table (fixed size) and counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import ROW, checkpoint, give_back, join_unique, packed, settled, small_batches, table, unpacked

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS_A_BAND = 10, 3
SAMPLES = BANDS * ROWS_A_BAND
#: Slots of the document-frequency table, and how they are dealt out for summing.
SLOTS, CHUNK, DEALS = 1 << 20, 1 << 14, 64
#: Weight of a shingle: 1 + DAMP * idf, with idf scaled to 0..1: 0 for a shingle of every document, 1 from a share of RARE of
#: them down. With the whole idf a group of thousands of copies would make its own shingles so light that one changed word
#: outweighed a paragraph; so the idf is damped.
DAMP, RARE = 0.25, 1 / 512
#: Buckets up to SMALL have all their pairs weighed; larger ones are dealt into blocks of about BLOCK sets, of which HUBS meet
#: those of other blocks; DEAL is the number of sets outside main components that meet a block at once.
SMALL, BLOCK, HUBS, DEAL = 64, 256, 4, 512
#: Columns of a matrix product.
WIDTH = 4096
#: Least number of equal samples of a pair that goes on: at similarity 0.8 fewer than 15 of 30 come about 2 times in 100,000.
LEAST_EQUAL = SAMPLES // 2
TABLE = 1 << 16
#: Links whose components are found by broadcast, at most: about 40 MB in a hash table.
BROADCAST_LINKS = 500_000
OUTPUT = ("class_id", "class_size", "kept")


def shingles(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of all five-word shingles, repeats included; one of all words if fewer; none for an empty text.

    Words are separated by ASCII white space.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").split()
    n = len(parts)
    if not n:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxh3_64_intdigest, parts), np.uint64, n)
    k = min(WORDS, n)
    h = np.full(n - k + 1, k, np.uint64)
    for j in range(k):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += w[j : n - k + 1 + j]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h.sort()
    return h


def frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """(documents by slot of their shingles, documents), over all rows. The table has ``SLOTS`` entries at any input size."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, docs = np.zeros(SLOTS, np.int64), 0
        for b in batches:
            for t in b["text"]:
                h = shingles(t)
                if len(h):
                    slot = (h >> np.uint64(44)).astype(np.int64)  # sorted, as h is
                    total[slot[np.append(True, slot[1:] != slot[:-1])]] += 1
                    docs += 1
        for k in range(0, SLOTS, CHUNK):
            part = total[k : k + CHUNK]
            at = np.flatnonzero(part)
            if len(at):
                yield pd.DataFrame({"chunk": [k // CHUNK], "deal": [int(docs + at[0]) % DEALS], "at": [at.astype("<u2").tobytes()], "n": [part[at].astype("<u4").tobytes()]})
        if docs:
            yield pd.DataFrame({"chunk": [-1], "deal": [docs % DEALS], "at": [b"\0\0"], "n": [np.array([docs], "<u4").tobytes()]})
        give_back()

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Sums the rows of each chunk and deal as they stream by, one sum in memory at a time."""
        total, key = np.zeros(CHUNK, np.int64), None

        def done() -> pd.DataFrame:
            at = np.flatnonzero(total)
            return pd.DataFrame({"chunk": [key[0]], "deal": [0], "at": [at.astype("<u2").tobytes()], "n": [total[at].astype("<i8").tobytes()]})

        for b in batches:
            for chunk, deal, at, n in zip(b["chunk"], b["deal"], b["at"], b["n"], strict=True):
                if key != (chunk, deal):
                    if key is not None:
                        yield done()
                    key = (chunk, deal)
                    total[:] = 0
                total[np.frombuffer(at, "<u2")] += np.frombuffer(n, "<u4" if 2 * len(at) == len(n) else "<i8")  # 4 bytes a count from a task, 8 once summed
        if key is not None:
            yield done()

    schema = "chunk int, deal int, at binary, n binary"
    parts = texts.select("text").mapInPandas(count, schema)
    for by in (("chunk", "deal"), ("chunk",)):
        parts = parts.repartition(*by).sortWithinPartitions(*by).mapInPandas(merge, schema)
    total, docs = np.zeros(SLOTS, np.int64), 0
    for r in parts.collect():  # a row a chunk: at most SLOTS * 10 bytes
        n = np.frombuffer(r["n"], "<i8")
        if r["chunk"] < 0:
            docs = int(n.sum())
        else:
            total[r["chunk"] * CHUNK + np.frombuffer(r["at"], "<u2").astype(np.int64)] = n
    return total, docs


def slot_weights(total: np.ndarray, docs: int, damp: float = DAMP) -> np.ndarray:
    """The weight of one occurrence of each slot's shingles, from the documents that hold them."""
    own = np.maximum(1.0, total - total.sum() / len(total))  # without the mean of what foreign shingles add
    idf = np.log(np.maximum(own / max(1, docs), RARE)) / np.log(RARE)
    return (1 + damp * np.clip(idf, 0, 1)).astype(np.float32)


class Sampler:
    """Improved consistent weighted sampling of many weighted sets at once."""

    def __init__(self, seed: int = 11) -> None:
        g = np.random.Generator(np.random.PCG64(seed))
        self.r = g.gamma(2.0, 1.0, TABLE).astype(np.float32)
        self.log_c = np.log(g.gamma(2.0, 1.0, TABLE)).astype(np.float32)
        self.beta = g.random(TABLE, np.float32)
        self.odd = g.integers(1 << 62, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def __call__(self, h: np.ndarray, log_w: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """sets x samples: a 64-bit value of each sample (element and quantised weight). ``begin``: where each set starts."""
        out = np.empty((len(begin), SAMPLES), np.uint64)
        sizes = np.diff(np.append(begin, len(h)))
        for i, odd in enumerate(self.odd):
            at = (h * odd) >> np.uint64(48)
            r, beta = self.r[at], self.beta[at]
            t = np.floor(log_w / r + beta)
            a = self.log_c[at] - r * (t - beta + 1)
            low = np.minimum.reduceat(a, begin)
            hit = np.flatnonzero(a == np.repeat(low, sizes))
            first = hit[np.searchsorted(hit, begin)]
            z = h[first] * (odd ^ np.uint64(0x5851F42D4C957F2D)) + t[first].astype(np.int64).astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
            out[:, i] = z ^ (z >> np.uint64(31))
        return out


def sketched(texts: DataFrame, weights) -> DataFrame:
    """(rid, id, key, cls, w, sig, bands, set) of every row of (rid, id, key, text).

    ``set`` holds the upper 32 bits of all shingle hashes, sorted, repeats kept; ``cls`` is its digest, ``w`` its weight.
    An empty text has no samples and a class of its own.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sampler, weigh = Sampler(), weights.value
        for b in batches:
            for begin_row in range(0, len(b), 64):
                part = b.iloc[begin_row : begin_row + 64]
                sets = [shingles(t) for t in part["text"]]
                full = [i for i, h in enumerate(sets) if len(h)]
                sig, bands, total = [None] * len(sets), [None] * len(sets), np.zeros(len(sets))
                if full:
                    sizes = np.array([len(sets[i]) for i in full])
                    flat = np.concatenate([sets[i] for i in full])
                    starts = np.cumsum(sizes) - sizes
                    new = np.ones(len(flat), bool)
                    new[1:] = flat[1:] != flat[:-1]
                    new[starts] = True
                    at = np.flatnonzero(new)
                    tf = np.diff(np.append(at, len(flat)))
                    h = flat[at]
                    w = tf * weigh[(h >> np.uint64(44)).astype(np.int64)]
                    begin = np.searchsorted(at, starts)
                    total[full] = np.add.reduceat(w.astype(np.float64), begin)
                    got = sampler(h, np.log(w).astype(np.float32), begin)
                    short = (got >> np.uint64(16)).astype("<u2")
                    keys = np.full((len(full), BANDS), 0, np.uint64)
                    for j in range(ROWS_A_BAND):
                        keys = (keys + got[:, j::ROWS_A_BAND]) * np.uint64(0x9FB21C651E98DF25)
                        keys ^= keys >> np.uint64(28)
                    keys += np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    keys = keys.astype(np.int64)
                    for i, k in enumerate(full):
                        sig[k], bands[k] = short[i].tobytes(), keys[i]
                packs = [(h >> np.uint64(32)).astype("<u4").tobytes() for h in sets]
                cls = [blake2b(p, digest_size=16).digest() if p else b"empty %d" % r for p, r in zip(packs, part["rid"], strict=True)]
                yield pd.DataFrame({"rid": part["rid"].values, "id": part["id"].values, "key": part["key"].values, "cls": cls, "w": total, "sig": sig, "bands": bands, "set": packs})
        give_back()

    return texts.mapInPandas(work, "rid long, id string, key long, cls binary, w double, sig binary, bands array<long>, set binary")


def whole_runs(batches: Iterator[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of sorted batches again, cut only where the columns ``by`` change; runs are of bounded size here."""
    held = None
    for b in batches:
        b = b if held is None else pd.concat([held, b], ignore_index=True)
        if not len(b):
            continue
        last = np.ones(len(b), bool)
        for c in by:
            last &= (b[c] == b[c].iloc[-1]).values
        cut = int(np.argmax(last))
        held = b.iloc[cut:]
        if cut:
            yield b.iloc[:cut]
    if held is not None and len(held):
        yield held


def small_pairs(rows: DataFrame, threshold: float) -> DataFrame:
    """(a, b) of pairs in small buckets that may reach the threshold, weighed for all rows at one distance at once."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in whole_runs(batches, ["key"]):
            key, rid, w = b["key"].values, b["rid"].values, b["w"].values
            sig = np.frombuffer(b"".join(b["sig"]), "<u2").reshape(-1, SAMPLES)
            for d in range(1, len(b)):
                i = np.flatnonzero(key[d:] == key[:-d])
                if not len(i):
                    break
                j = i + d
                good = np.minimum(w[i], w[j]) >= threshold * np.maximum(w[i], w[j]) * (1 - 1e-6)
                i, j = i[good], j[good]
                equal = (sig[i] == sig[j]).sum(axis=1) >= LEAST_EQUAL
                i, j = rid[i[equal]], rid[j[equal]]
                if len(i):
                    yield pd.DataFrame({"a": np.minimum(i, j), "b": np.maximum(i, j)})

    return rows.repartition("key").sortWithinPartitions("key").select("key", "rid", "w", "sig").mapInPandas(work, "a long, b long")


def shared_weights(xs: list[bytes], ys: list[bytes], weigh: np.ndarray) -> np.ndarray:
    """xs x ys: the weight that two packed sets share, repeats included. Only shingles on both sides make columns."""

    def keyed(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        token = np.frombuffer(b"".join(parts), "<u4").astype(np.uint64)
        row = np.repeat(np.arange(len(parts)), [len(p) // 4 for p in parts])
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (row[1:] != row[:-1])
        at = np.flatnonzero(new)
        nth = np.arange(len(token)) - np.repeat(at, np.diff(np.append(at, len(token))))
        return token << np.uint64(32) | nth.astype(np.uint64), row

    sides = [keyed(xs), keyed(ys)]
    vocabulary = np.intersect1d(sides[0][0], sides[1][0])
    value = weigh[(vocabulary >> np.uint64(44)).astype(np.int64)].astype(np.float64)
    placed = []
    for key, row in sides:
        at = np.searchsorted(vocabulary, key)
        good = (at < len(vocabulary)) & (vocabulary[np.minimum(at, len(vocabulary) - 1)] == key) if len(vocabulary) else np.zeros(len(key), bool)
        order = np.argsort(at[good], kind="stable")
        placed.append((at[good][order], row[good][order]))
    out = np.zeros((len(xs), len(ys)))
    for k in range(0, len(vocabulary), WIDTH):
        sheets = []
        for (at, row), n in zip(placed, out.shape, strict=True):
            i, j = np.searchsorted(at, [k, k + WIDTH])
            sheet = np.zeros((n, min(WIDTH, len(vocabulary) - k)))
            sheet[row[i:j], at[i:j] - k] = 1.0
            sheets.append(sheet)
        out += (sheets[0] * value[k : k + WIDTH]) @ sheets[1].T
    return out


def linked(x: pd.DataFrame, y: pd.DataFrame, weigh: np.ndarray, threshold: float) -> np.ndarray:
    """x x y: whether two sets reach the threshold, exactly."""
    shared = shared_weights(list(x["set"]), list(y["set"]), weigh)
    return shared >= threshold * (x["w"].values[:, None] + y["w"].values[None, :] - shared) * (1 - 1e-6)


def ties(b: pd.DataFrame, weigh: np.ndarray, threshold: float) -> pd.DataFrame:
    """(a, b): each row of a block with the first row of its component in the block, fewer ties than rows."""
    near, rid = linked(b, b, weigh, threshold), b["rid"].values
    first = np.full(len(b), -1)
    for i in range(len(b)):
        if first[i] < 0:
            reached, edge = np.zeros(len(b), bool), np.array([i])
            while len(edge):
                reached[edge] = True
                edge = np.flatnonzero(near[edge].any(axis=0) & ~reached)
            first[reached] = i
    other = np.flatnonzero(first != np.arange(len(b)))
    i, j = rid[other], rid[first[other]]
    return pd.DataFrame({"a": np.minimum(i, j), "b": np.maximum(i, j)})


def block_ties(rows: DataFrame, sets: DataFrame, weights, threshold: float) -> DataFrame:
    """(a, b) of texts that hang together within blocks of a bucket: (key, rid, cls, mass, m) with ``m`` the rows of the key."""
    out = rows.sparkSession.createDataFrame([], "a long, b long")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for many in whole_runs(batches, ["key", "block"]):
            for _, b in many.groupby(["key", "block"], sort=False):
                yield ties(b, weights.value, threshold)
        give_back()

    while True:
        most = rows.agg(F.max("m")).first()[0]
        if most is None:
            return out
        dealt = rows.withColumn("block", F.pmod(F.xxhash64("cls", "key"), F.ceil(F.col("m") / BLOCK).cast("long")))
        whole = dealt.select("key", "block", "rid").join(sets, "rid")
        ordered = whole.repartition("key", "block").sortWithinPartitions("key", "block", "rid")
        found, _ = settled(ordered.select("key", "block", "rid", "w", "set").mapInPandas(work, "a long, b long"))
        out = out.unionByName(found)
        if most <= BLOCK:
            return out
        rank = F.row_number().over(Window.partitionBy("key", "block").orderBy(F.desc("mass"), "cls"))  # about BLOCK rows each
        hubs = dealt.where(F.col("m") > BLOCK).withColumn("rank", rank).where(F.col("rank") <= HUBS)
        rows, _ = settled(hubs.withColumn("m", F.ceil(F.col("m") / BLOCK) * HUBS).select("key", "rid", "cls", "mass", "m"))


def verified(pairs: DataFrame, sets: DataFrame, weights, threshold: float) -> DataFrame:
    """(a, b) of the pairs whose weighted Jaccard similarity reaches the threshold. ``sets``: (rid, w, set)."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weigh = weights.value

        def counted(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            token = np.frombuffer(b"".join(parts), "<u4").astype(np.uint64)
            pair = np.repeat(np.arange(len(parts), dtype=np.uint64), [len(p) // 4 for p in parts])
            return np.unique(pair << np.uint64(32) | token, return_counts=True)

        for b in batches:
            for k in range(0, len(b), 256):
                part = b.iloc[k : k + 256]
                (x, n), (y, m) = counted(list(part["set_a"])), counted(list(part["set_b"]))
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = y[at] == x
                worth = weigh[(x[both] >> np.uint64(12) & np.uint64(SLOTS - 1)).astype(np.int64)] * np.minimum(n[both], m[at[both]])
                shared = np.bincount((x[both] >> np.uint64(32)).astype(np.int64), weights=worth, minlength=len(part))
                good = shared >= threshold * (part["w_a"].values + part["w_b"].values - shared) * (1 - 1e-6)
                yield part.loc[good, ["a", "b"]]
        give_back()

    of = lambda side: sets.select(F.col("rid").alias(side), F.col("w").alias(f"w_{side}"), F.col("set").alias(f"set_{side}"))
    return pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "w_a", "w_b", "set_a", "set_b").mapInPandas(work, "a long, b long")


def components(edges: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(rid, comp): the least rid of each node's component, for nodes with an edge or in ``labels`` (components so far).

    Up to ``BROADCAST_LINKS`` links (two longs each) the labels go to the links by broadcast; beyond it both are shuffled.
    """
    both = edges.select("a", "b").union(edges.select("b", "a"))
    if labels is not None:  # a component so far is linked through its label's node
        own = labels.where("rid <> comp")
        both = both.union(own.select("rid", "comp")).union(own.select("comp", "rid"))
    both, links = settled(both.distinct().toDF("rid", "to"))
    near = F.broadcast if links <= BROADCAST_LINKS else lambda df: df
    at = both.select("rid").distinct()
    if labels is not None:
        at = at.union(labels.select("rid")).distinct()
    at, _ = settled(at.withColumn("comp", F.col("rid")))
    while True:
        low = both.join(near(at.select(F.col("rid").alias("to"), "comp")), "to").groupBy("rid").agg(F.min("comp").alias("low"))
        step = at.join(near(low), "rid", "left").select("rid", F.col("comp").alias("was"), F.least("comp", F.coalesce("low", "comp")).alias("comp"))
        step, _ = settled(step)
        up = step.select(F.col("rid").alias("comp"), F.col("comp").alias("up"))
        step, _ = settled(step.join(near(up), "comp", "left").select("rid", "was", F.least("comp", F.coalesce("up", "comp")).alias("comp")))
        at = step.select("rid", "comp")
        if step.where("was <> comp").isEmpty():
            return at


def outsider_links(rows: DataFrame, sets: DataFrame, labels: DataFrame, weights, threshold: float) -> DataFrame:
    """(a, b) of links across components in large buckets: (key, rid, cls, m), a row a text and bucket.

    Each text outside the main component of one of its buckets is dealt, by the hash of its set, to the others of its largest
    bucket; a deal of about ``DEAL`` meets all members of all buckets that its texts lie in, each once, in blocks. A text is
    tied once to each component that it is linked with in a block.
    """
    comp = F.coalesce("comp", "rid").alias("comp")
    own, _ = settled(rows.join(labels, "rid", "left").select("key", "rid", "cls", "m", comp))
    sizes = own.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"), F.min("cls").alias("least"))
    main = sizes.groupBy("key").agg(F.max_by("comp", F.struct("n", "least")).alias("main"), F.count(F.lit(1)).alias("parts"), F.sum("n").alias("members"))
    out = join_unique(own, main.where("parts > 1"), "key", F.col("members"), max(1, rows.count())).where("comp <> main")
    out, _ = settled(out.select("key", "rid", "cls", "m", "comp"))
    home = out.groupBy("rid").agg(F.max_by("key", F.struct("m", "key")).alias("home"), F.first("cls").alias("cls"), F.first("comp").alias("comp"))
    many = home.groupBy("home").agg(F.count(F.lit(1)).alias("n"))
    asked, _ = settled(home.join(many, "home").select("rid", "comp", F.xxhash64("home", F.pmod(F.xxhash64(F.lit(3), "cls"), F.ceil(F.col("n") / DEAL).cast("long"))).alias("deal")))
    wants = out.select("key", "rid").join(asked.select("rid", "deal"), "rid").select("key", "deal").distinct()
    met, _ = settled(own.select("key", "rid", "cls", "comp").join(wants, "key").groupBy("deal", "rid").agg(F.first("cls").alias("cls"), F.first("comp").alias("comp")))
    blocks = met.groupBy("deal").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("blocks"), F.count(F.lit(1)).alias("members"))
    y = join_unique(met, blocks, "deal", F.col("members"), max(1, met.count()))
    y = y.select("deal", F.pmod(F.xxhash64("cls"), "blocks").alias("block"), F.lit(1).alias("side"), "rid", "comp")
    x = asked.join(blocks, "deal").select("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("side"), "rid", "comp")
    whole = y.unionByName(x).join(sets, "rid").select("deal", "block", "side", "rid", "comp", "w", "set")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for many in whole_runs(batches, ["deal", "block"]):
            for _, b in many.groupby(["deal", "block"], sort=False):
                x, y = b[b["side"] == 0], b[b["side"] == 1]
                if len(x) and len(y):
                    near = linked(x, y, weights.value, threshold) & (x["comp"].values[:, None] != y["comp"].values[None, :])
                    i, j = np.nonzero(near)
                    found = pd.DataFrame({"x": x["rid"].values[i], "y": y["rid"].values[j], "comp": y["comp"].values[j]}).drop_duplicates(["x", "comp"])
                    yield pd.DataFrame({"a": np.minimum(found["x"], found["y"]), "b": np.maximum(found["x"], found["y"])})
        give_back()

    return whole.repartition("deal", "block").sortWithinPartitions("deal", "block", "side", "rid").mapInPandas(work, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, key, class_id, class_size, kept), one row a row of ``docs``; ``key`` is the row's content (id and text) hashed.

    Rows whose texts are linked by weighted Jaccard similarity of at least ``threshold`` over five-word shingles, directly or
    through others, share a class: ``class_id`` is its smallest id (null last) and exactly one row of it is ``kept``. Texts
    under five words are one shingle; a text without words (or null) is alone in its class. Repeated rows are copies like any
    others; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    id_type = dict(docs.dtypes)[id_col]
    ident, text = docs[f"`{id_col}`"], docs[f"`{text_col}`"]
    texts = docs.select(F.monotonically_increasing_id().alias("rid"), ident.cast("string").alias("id"), F.xxhash64(ident, text).alias("key"), text.alias("text"))
    weights = spark.sparkContext.broadcast(slot_weights(*frequencies(texts)))
    every = checkpoint(sketched(texts, weights))

    name = F.col("id").cast(id_type)
    first = F.min(F.struct(name.isNull().alias("none"), name.alias("id"), F.col("rid").alias("rid")))
    groups = every.groupBy("cls").agg(first.alias("best"), F.count(F.lit(1)).alias("copies"), F.first("w").alias("w"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    groups, n = settled(groups.withColumn("rid", F.col("best.rid")))

    banded = groups.where("bands is not null").select("rid", F.explode("bands").alias("key"))
    sizes = banded.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    buckets, _ = settled(join_unique(banded, sizes, "key", F.col("m"), max(1, n)))
    mass = buckets.groupBy("rid").agg(F.sum("m").alias("mass"))
    members, _ = settled(groups.select("rid", "cls", "w", "sig").join(mass, "rid"))  # only texts that share a bucket
    small = buckets.where(F.col("m") <= SMALL).join(members, "rid")
    large, in_large = settled(buckets.where(F.col("m") > SMALL).join(members.select("rid", "cls", "mass"), "rid"))

    pairs, _ = settled(small_pairs(small, threshold).distinct())
    sets, _ = settled(some_sets(every, members), 5000)
    edges, _ = settled(verified(pairs, sets, weights, threshold))
    if in_large:
        order = F.struct("m", "key")
        ends = F.array_distinct(F.array(F.max_by("key", order), F.min_by("key", order)))
        chosen = large.groupBy("rid").agg(ends.alias("ends"), F.first("cls").alias("cls"), F.first("mass").alias("mass"))
        chosen, _ = settled(chosen.select("rid", "cls", "mass", F.explode("ends").alias("key")))
        dealt = chosen.groupBy("key").agg(F.count(F.lit(1)).alias("m"))
        edges = edges.unionByName(block_ties(join_unique(chosen, dealt, "key", F.col("m"), in_large), sets, weights, threshold))
    labels = components(edges)
    if in_large:
        more, found = settled(outsider_links(large, sets, labels, weights, threshold))
        if found:
            labels = components(more, labels)

    at = groups.select("cls", "rid", "best", "copies").join(labels, "rid", "left").withColumn("comp", F.coalesce("comp", "rid"))
    heads = at.groupBy("comp").agg(F.min("best").alias("head"), F.sum("copies").alias("class_size"), F.count(F.lit(1)).alias("texts"))
    at = join_unique(at.select("cls", "comp", "copies"), heads, "comp", F.col("texts"), max(1, n)).select("cls", "head", "class_size", "copies")
    out = join_unique(every.select("rid", "id", "key", "cls"), at, "cls", F.col("copies"), max(1, every.count()))
    return out.select(name.alias("id"), "key", F.col("head.id").alias("class_id"), "class_size", (F.col("head.rid") == F.col("rid")).alias("kept"))


def some_sets(every: DataFrame, members: DataFrame) -> DataFrame:
    """(rid, w, set) of the members. A Bloom filter of bounded size keeps the other rows' sets from being shuffled."""
    from .exact_dedup import filter_pages, hit, page_of, slots_for

    m = slots_for(members.count(), 1 << 27)
    slot = F.pmod(F.xxhash64("rid"), F.lit(m)).alias("slot")
    pages = filter_pages(members.select(slot))
    near = every.withColumn("slot", slot).join(F.broadcast(pages), page_of("slot") == F.col("page")).where(hit("slot", "words"))
    return near.select("rid", "w", "set").join(members.select("rid"), "rid")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` of which :func:`near_duplicates` keeps one a class, with all their columns.

    Rows are told apart by their content hash; of rows equal in id and text one stays.
    """
    judged = near_duplicates(docs, id_col, text_col, threshold)
    by_key = judged.groupBy("key").agg(F.max("kept").alias("stays"), F.count(F.lit(1)).alias("rows"))
    odd, _ = settled(by_key.where("not stays or rows > 1"))  # gone, or to be thinned to one row
    rows = docs.select(packed(docs), F.xxhash64(docs[f"`{id_col}`"], docs[f"`{text_col}`"]).alias("key"))
    told = join_unique(rows, odd, "key", F.col("rows"), max(1, judged.count()), "left")
    once = told.where("stays").dropDuplicates(["key"]).select(ROW)
    out = told.where("stays is null").select(ROW).unionByName(once)
    return out.select(*unpacked(out))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), *OUTPUT)

from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import near_dedup as N

from .conftest import words


def brute(rows, threshold=N.THRESHOLD):
    """Class of each row by comparing all pairs."""
    sets = [N.shingles(r["text"]) for r in rows]
    total = np.zeros(N.SLOTS, np.int64)
    for h in sets:
        total[np.unique(h >> np.uint64(44)).astype(int)] += 1
    weigh = N.slot_weights(total, sum(len(h) > 0 for h in sets))
    bags = []
    for h in sets:
        u, n = np.unique(h, return_counts=True)
        bags.append(dict(zip(u.tolist(), (n * weigh[(u >> np.uint64(44)).astype(int)]).tolist(), strict=True)))
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    links = 0
    for i, j in combinations(range(len(rows)), 2):
        a, b = bags[i], bags[j]
        if not a or not b:
            continue
        both = sum(min(w, b[k]) for k, w in a.items() if k in b)
        if both >= threshold * (sum(a.values()) + sum(b.values()) - both):
            links += 1
            up[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    return links, sorted(sorted(repr(rows[i]["doc_id"]) for i in g) for g in groups.values())


def classes(df):
    groups = {}
    for i, r in enumerate(df.collect()):
        alone = r["class_size"] == 1
        groups.setdefault((i,) if alone else (r["class_id"], r["class_size"]), []).append(r)
    return groups


def check(docs):
    links, want = brute(docs.collect())
    got = classes(N.near_duplicates(docs))
    assert sorted(sorted(repr(r["id"]) for r in g) for g in got.values()) == want
    for g in got.values():
        assert len(g) == g[0]["class_size"] and sum(r["kept"] for r in g) == 1
        ids = [r["id"] for r in g if r["id"] is not None]
        assert g[0]["class_id"] == (min(ids) if ids else None)
    return links


def test_odd_rows(odd_docs, no_docs):
    assert check(odd_docs) > 3
    assert N.near_duplicates(no_docs).count() == 0


def mutated(base, seed, n):
    g = np.random.default_rng(seed)
    w = base.split()
    for i in g.choice(len(w), n, replace=False):
        w[i] = words(int(g.integers(1 << 30)), 1)
    return " ".join(w)


def test_large_group_of_near_copies(spark):
    """One bucket of hundreds of texts, of which many are no link of one another, but all hang together or stand outside."""
    base = words(3, 150)
    rows = [(i, mutated(base, i, i % 14)) for i in range(420)] + [(1000 + i, words(5000 + i, 80)) for i in range(60)]
    assert check(spark.createDataFrame(rows, "doc_id long, text string")) > 2000


def test_outsiders_meet_every_member(spark):
    """A text outside the main component is weighed against all members of its buckets, whatever their number."""
    rows = []
    for i in range(700):  # a chain: each text shares a share of 0.85 with the next, so its ends have nothing in common
        rows.append((i, list(range(i * 15, i * 15 + 185))))
    rows.append((900, list(range(699 * 15 + 16, 699 * 15 + 201))))  # hangs on the chain's last text alone
    rows.append((901, list(range(100, 240)) + list(range(90_000, 90_045))))  # reaches no text
    data = [(r, bytes([r % 256, r // 256]), float(len(t)), np.array(sorted(t), "<u4").tobytes()) for r, t in rows]
    every = spark.createDataFrame(data, "rid long, cls binary, w double, set binary")
    labels = spark.createDataFrame([(i, 0) for i in range(700)], "rid long, comp long")
    weights = spark.sparkContext.broadcast(np.ones(N.SLOTS, np.float32))
    large = every.select(F.lit(7).cast("long").alias("key"), "rid", "cls", F.lit(len(rows)).cast("long").alias("m"))
    got = {(r["a"], r["b"]) for r in N.outsider_links(large, every.select("rid", "w", "set"), labels, weights, N.THRESHOLD).collect()}
    assert got == {(699, 900)}


def test_matrix_products_against_bags():
    g = np.random.default_rng(4)
    bags = [sorted(g.integers(0, 1 << 32, 40).tolist() * 2 + g.integers(0, 50, int(n)).tolist()) for n in (0, 5, 300, 3, 90)]
    bags += [sorted(bags[2][:200] + bags[4]), bags[0][:17]]
    weigh = g.random(N.SLOTS).astype(np.float32)
    packs = [np.array(x, "<u4").tobytes() for x in bags]
    want = [[sum(min(a.count(t), b.count(t)) * float(weigh[t >> 12]) for t in set(a)) for b in bags[3:]] for a in bags]
    width, N.WIDTH = N.WIDTH, 16
    try:
        assert np.allclose(N.shared_weights(packs, packs[3:], weigh), want)
    finally:
        N.WIDTH = width


def test_classes_do_not_depend_on_the_dealing(spark):
    """The same classes however the rows are dealt, with a hot bucket and a very long text among its members."""
    base = words(3, 150)
    rows = [(i, mutated(base, i, i % 15)) for i in range(330)] + [(900, base), (901, words(2, 30_000)), (902, words(2, 30_000) + " more"), (903, base + " " + base)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [sorted((r["id"], r["class_id"], r["class_size"], r["kept"]) for r in N.near_duplicates(docs.repartition(n)).collect()) for n in (1, 3, 11)]
    assert found[0] == found[1] == found[2]
    assert check(docs) > 1000 and [x[1] for x in found[0] if x[0] in (901, 902)] == [901, 901]


def test_weights_are_alike_at_every_size():
    """Foreign shingles fill all slots as the corpus grows; the weight of a shingle of a given share of it stays."""
    g = np.random.default_rng(1)
    for docs in (10_000, 1_000_000, 100_000_000):
        noise = g.poisson(300 * docs / N.SLOTS, N.SLOTS).astype(float)
        for share in (0.0, 0.01, 0.1, 0.5, 1.0):
            total = noise.copy()
            total[:100] += share * docs
            idf = min(1.0, np.log(max(share, N.RARE)) / np.log(N.RARE))
            assert np.allclose(N.slot_weights(total, docs)[:100], 1 + N.DAMP * idf, atol=0.02)


def test_near_copies_are_caught(spark):
    """Of texts with one to five changed words in a hundred and fifty, all that reach the threshold are found."""
    rows, pairs = [], []
    for i in range(300):
        base = words(10_000 + i, 150)
        rows += [(2 * i, base), (2 * i + 1, mutated(base, i, 1 + i % 5))]
        pairs.append((2 * i, 2 * i + 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    of = {r["id"]: r["class_id"] for r in N.near_duplicates(docs).collect()}
    caught = [of[a] == of[b] for a, b in pairs]
    assert sum(c for k, c in enumerate(caught) if k % 5 < 2) == 120 and sum(caught) >= 0.9 * sum(1 for i in range(300) if i % 5 < 3)


def test_shared_passages_are_no_copies(spark):
    passage = words(4, 60)
    rows = [(i, f"{words(100 + i, 60)} {passage} {words(900 + i, 60)}") for i in range(80)]
    assert check(spark.createDataFrame(rows, "doc_id long, text string")) == 0


def test_drop(odd_docs, no_docs):
    kept = N.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    judged = N.near_duplicates(odd_docs)
    assert kept.count() == judged.where("kept").count()
    assert kept.where("doc_id = 2").count() <= 1
    assert N.drop_near_duplicates(no_docs).count() == 0


def test_samples_are_consistent():
    """The share of equal samples estimates weighted Jaccard similarity."""
    g = np.random.default_rng(0)
    sampler, got = N.Sampler(), []
    for _ in range(60):
        h = np.unique(g.integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
        a, b = h[:250], h[25:275]
        s = [sampler(x, np.zeros(len(x), np.float32), np.array([0]))[0] for x in (a, b)]
        got.append((s[0] == s[1]).mean())
    assert abs(np.mean(got) - 225 / 275) < 0.03


def test_clashing_names_and_ties(spark):
    """Columns named like outputs give way in the classes and stay in the documents; of equal rows one is kept."""
    text = words(8, 40)
    rows = [(5, text, 1, "a", 0.5), (3, text, 2, "b", 0.5), (3, text, 3, "c", 0.5), (None, text, 4, "d", 0.5), (9, words(9, 40), 5, "e", 0.5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, class_size long, kept string, w double")
    got = [(r["id"], r["class_id"], r["class_size"], r["kept"]) for r in N.near_duplicates(df).collect()]
    assert sorted(got, key=str) == sorted([(5, 3, 4, False), (3, 3, 4, True), (3, 3, 4, False), (None, 3, 4, False), (9, 9, 1, True)], key=str)
    kept = N.drop_near_duplicates(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [3, 9]

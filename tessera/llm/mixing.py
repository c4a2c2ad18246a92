"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong to). A small flow network routes each
pattern's words to the quotas of its sources; every further repetition of a pattern costs more than the one before, so
the costs are convex and the flow spreads repetition thin. Each pattern's flow then becomes whole repetitions for all its
documents plus one more for those whose seeded hash lies below an exact cut, found from a histogram of the hash and one
ordered pass over the one bin that the cut falls in. The decision for a row is a function of its id, size and pattern alone.
"""

from __future__ import annotations

import heapq
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ROW, checkpoint, packed, table, unpacked

BINS = 4096
#: Patterns are solved on the driver; more than this is refused with an error, never cut.
MAX_PATTERNS = 200_000
OUTPUT = ("size", "source_size", "target", "taken", "copies")


def word_count(text: Column) -> Column:
    """Number of maximal runs of ``[^\\x20\\x09-\\x0D]`` (null: 0).

    All white space becomes spaces, with one before the text; a run starts at each other character after a space.
    """
    t = F.concat(F.lit(" "), F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     "))
    return F.regexp_count(t, F.lit(" [^ ]")).cast("long")


def quotas(sizes: list[tuple[object, int]], words: float, weights: tuple[float, ...], most: float) -> dict:
    """Target words of each source: ``words`` in all, shared by weight, none over ``most`` times its size.

    Sources are taken by code point, null last, with the weights repeating. What exceeds a source's limit is shared anew
    among the sources below theirs by weight, until none is above.
    """
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    limit = {s: most * n for s, n in order}
    left, target, full = words, {}, set()
    while True:
        free = [s for s, _ in order if s not in full]
        base = sum(weight[s] for s in free)
        target |= {s: left * weight[s] / base for s in free}
        over = [s for s in free if target[s] > limit[s]]
        if not over:
            return target
        for s in over:
            target[s] = limit[s]
            left -= limit[s]
            full.add(s)
        if len(full) == len(order):
            return target


def min_cost_flow(supply: list[float], demand: list[float], arcs: list[tuple[int, int]], repeats: int) -> list[dict[int, float]]:
    """Flow of each pattern to each source: as much demand as can be met, at least convex repetition cost.

    The k-th repetition of a pattern costs ``2k + 1`` a word. The network falls apart into sets of patterns and sources that
    hang together; each is solved by successive shortest paths with potentials, also that of a source alone.
    """
    flow: list[dict[int, float]] = [{} for _ in supply]
    up = list(range(len(supply) + len(demand)))

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for p, s in arcs:
        up[find(p)] = find(len(supply) + s)
    apart: dict[int, list[tuple[int, int]]] = {}
    for p, s in sorted(arcs):
        apart.setdefault(find(p), []).append((p, s))
    for own in apart.values():
        patterns, sources = (sorted(set(side)) for side in zip(*own, strict=True))
        to_p, to_s = ({x: i for i, x in enumerate(xs)} for xs in (patterns, sources))
        part = shortest_paths([supply[p] for p in patterns], [demand[s] for s in sources], [(to_p[p], to_s[s]) for p, s in own], repeats)
        for p, given in zip(patterns, part, strict=True):
            flow[p] = {sources[s]: x for s, x in given.items()}
    return flow


def shortest_paths(supply: list[float], demand: list[float], arcs: list[tuple[int, int]], repeats: int) -> list[dict[int, float]]:
    """:func:`min_cost_flow` of one connected network."""
    # nodes: 0 root, 1..P patterns, P+1..P+S sources, end
    n, m = len(supply), len(demand)
    flow: list[dict[int, float]] = [{} for _ in supply]
    graph: list[list[list]] = [[] for _ in range(n + m + 2)]

    def arc(u: int, v: int, cap: float, cost: float) -> None:
        graph[u].append([v, cap, cost, len(graph[v])])
        graph[v].append([u, 0.0, -cost, len(graph[u]) - 1])

    for p in range(n):
        for k in range(repeats):
            arc(0, 1 + p, supply[p], 2 * k + 1)
    for p, s in arcs:
        arc(1 + p, 1 + n + s, float("inf"), 0)
    for s in range(m):
        arc(1 + n + s, n + m + 1, demand[s], 0)
    pot = [0.0] * len(graph)
    while True:
        dist, back, heap = {0: 0.0}, {}, [(0.0, 0)]
        done = set()
        while heap:
            d, u = heapq.heappop(heap)
            if u in done:
                continue
            done.add(u)
            for i, (v, cap, cost, _) in enumerate(graph[u]):
                w = d + cost + pot[u] - pot[v]
                if cap > 1e-9 and v not in done and w < dist.get(v, float("inf")) - 1e-12:
                    dist[v], back[v] = w, (u, i)
                    heapq.heappush(heap, (w, v))
        end = n + m + 1
        if end not in done:
            break
        far = dist[end]
        for v in range(len(graph)):
            pot[v] += min(dist.get(v, far), far)
        push, v = float("inf"), end
        while v:
            u, i = back[v]
            push, v = min(push, graph[u][i][1]), u
        v = end
        while v:
            u, i = back[v]
            graph[u][i][1] -= push
            graph[v][graph[u][i][3]][1] += push
            v = u
    for p in range(n):
        for v, _, _, r in graph[1 + p]:
            if v > n and (f := graph[v][r][1]) > 0:
                flow[p][v - n - 1] = flow[p].get(v - n - 1, 0.0) + f
    return flow


def mix(docs: DataFrame, members: Column, size: Column, key: Column, share: float = 1.5, weights: tuple[float, ...] = (3, 1, 2), most: int = 2, seed: int = 17, keep: tuple[str, ...] | None = None) -> DataFrame:
    """Each row of ``docs`` with ``size``, ``source_size``, ``target``, ``taken`` and ``copies`` (taken is size times copies).

    ``members`` is the array of sources a row belongs to (a null element is a source of its own, an empty or null array
    none: such rows are never taken), ``size`` its words, ``key`` the value the seeded choice rests on. With several
    sources a row's ``source_size`` and ``target`` are the sums over them. Rows of size 0 take nothing. Rows with equal key
    and pattern are taken alike, so reruns agree however the rows are dealt. ``keep`` names the input columns to carry (default
    all); one named like an output is replaced. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    pattern = F.to_json(F.struct(F.array_sort(F.array_distinct(F.coalesce(members, F.array().cast("array<string>")))).alias("m")), {"ignoreNullFields": "false"})
    rows = docs.select(packed(docs, OUTPUT, keep), pattern.alias("__p"), F.coalesce(size, F.lit(0)).cast("long").alias("size"), F.xxhash64(F.lit(seed), key).alias("__h"))
    rows = rows.withColumn("__bin", F.pmod("__h", F.lit(BINS)).cast("int"))

    # Texts are read twice in all, for these narrow rows and for the result.
    narrow = checkpoint(rows.select("__p", "__bin", "__h", "size"))
    bins = narrow.groupBy("__p", "__bin").agg(F.sum("size").alias("n"))
    bins = bins.withColumn("upto", F.sum("n").over(Window.partitionBy("__p").orderBy("__bin")))
    totals = bins.groupBy("__p").agg(F.sum("n").alias("n"))
    found = [(r["__p"], r["n"]) for r in totals.limit(MAX_PATTERNS + 1).collect()]
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    found.sort()
    sets = [json.loads(p)["m"] for p, _ in found]
    names = sorted({s for m in sets for s in m}, key=lambda s: (s is None, s or ""))
    at = {s: i for i, s in enumerate(names)}
    amount = [0] * len(names)
    for (_, n), m in zip(found, sets, strict=True):
        for s in m:
            amount[at[s]] += n
    words = share * sum(n for (_, n), m in zip(found, sets, strict=True) if m)  # a document in several sources counts once
    target = quotas(list(zip(names, amount, strict=True)), words, weights, most) if names else {}
    demand = [target[s] for s in names]
    flow = min_cost_flow([float(n) for _, n in found], demand, [(p, at[s]) for p, m in enumerate(sets) for s in m], most)

    plan = []
    for (p, n), m, f in zip(found, sets, flow, strict=True):
        total = min(sum(f.values()), float(most * n))
        whole = int(total // n) if n else 0
        plan.append((p, sum(amount[at[s]] for s in m), float(sum(demand[at[s]] for s in m)), whole, float(total - whole * n)))
    schema = "__p string, source_size long, target double, whole int, rest double"
    plans = F.broadcast(spark.createDataFrame(plan, schema))  # at most MAX_PATTERNS rows

    edge = bins.join(plans, "__p").where("rest > 0 and upto - n < rest and upto >= rest").select("__p", "__bin", (F.col("rest") - F.col("upto") + F.col("n")).alias("room"))
    inside = narrow.join(F.broadcast(edge), ["__p", "__bin"]).groupBy("__p", "room", "__bin", "__h").agg(F.sum("size").alias("s"))
    order = Window.partitionBy("__p").orderBy("__h")
    inside = inside.withColumn("upto", F.sum("s").over(order)).where("upto - s / 2 <= room")
    cuts = edge.select("__p", "__bin").join(inside.groupBy("__p").agg(F.max("__h").alias("cut")), "__p", "left").withColumnRenamed("__bin", "edge")
    cut = spark.createDataFrame([tuple(r) for r in cuts.collect()], "__p string, edge int, cut long")  # a row a pattern

    out = rows.join(plans, "__p").join(F.broadcast(cut), "__p", "left")
    more = F.when(F.col("rest") <= 0, 0).when(F.col("edge").isNull(), 0).when(F.col("__bin") < F.col("edge"), 1).when((F.col("__bin") == F.col("edge")) & (F.col("__h") <= F.col("cut")), 1).otherwise(0)
    out = out.withColumn("copies", F.when(F.col("size") > 0, F.col("whole") + more).otherwise(0)).withColumn("taken", F.col("size") * F.col("copies"))
    return out.select(*unpacked(out), *OUTPUT)


def mix_by_source(docs: DataFrame, **how) -> DataFrame:
    """:func:`mix` of documents that each belong to the one source in ``source``."""
    return mix(docs, F.array(F.col("source").cast("string")), word_count(F.col("text")), F.col("doc_id"), **how)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words the mix takes of it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix_by_source(docs).select("doc_id", *OUTPUT)

"""Mixing overlapping sources to target weights by min-cost flow.

Documents are summed by membership pattern (the set of sources they belong to). Patterns send
words to the sources' quotas; sending a pattern's words once is free and every further pass costs
one more, so repetition is spread as convex costs ask. Documents then fill each pattern's flow
in a seeded order.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import WORD

WEIGHTS = (5, 2, 1)
SHARE = 1.5
PASSES = 2
SEED = 20
#: Slices of the seeded order of a pattern; no slice of a hot pattern is more than its share of one.
SLICES = 4096
#: Patterns the flow is solved for; a corpus with more needs coarser sources.
MAX_PATTERNS = 50_000


def source_targets(sizes: dict, weights=WEIGHTS, share: float = SHARE, passes: int = PASSES) -> dict:
    """Words wanted of each source: ``share`` of all words by repeating weights, ``passes`` sizes at most.

    Sources are taken by code point, null last; what a full source leaves is shared among the others.
    """
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, targets, open_names = share * sum(sizes.values()), {}, list(names)
    while open_names:
        left = total - sum(targets.values())
        unit = left / sum(weight[s] for s in open_names)
        full = [s for s in open_names if weight[s] * unit > passes * sizes[s]]
        if not full:
            return targets | {s: weight[s] * unit for s in open_names}
        targets |= {s: float(passes * sizes[s]) for s in full}
        open_names = [s for s in open_names if s not in targets]
    return targets


def min_cost_flow(capacity: dict, quota: dict, passes: int = PASSES) -> dict[tuple, int]:
    """Words from each pattern to each of its sources: quotas filled as far as possible at least cost.

    ``capacity``: words of each pattern (a tuple of sources) in one pass. Successive shortest paths;
    pass ``k`` of a pattern costs ``k``, counted from 0.
    """
    graph: dict = {}

    def edge(a, b, room, cost):
        there, back = [b, room, cost, None], [a, 0, -cost, None]
        there[3], back[3] = back, there
        graph.setdefault(a, []).append(there)
        graph.setdefault(b, []).append(back)
        return there

    routes = {}
    order = sorted(capacity, key=lambda p: tuple((s is None, s or "") for s in p))
    for number, pattern in enumerate(order):
        for k in range(passes):
            edge("from", ("pattern", number), capacity[pattern], k)
        for source in pattern:
            routes[pattern, source] = edge(("pattern", number), ("source", source), 1 << 62, 0)
    for source, room in quota.items():
        edge(("source", source), "to", room, 0)
    potential = dict.fromkeys(graph, 0)
    while "from" in graph:
        far, via, queue, tie = {"from": 0}, {}, [(0, 0, "from")], 0
        while queue:
            d, _, a = heapq.heappop(queue)
            if d > far[a]:
                continue
            for e in graph[a]:
                cost = d + e[2] + potential[a] - potential[e[0]]
                if e[1] > 0 and cost < far.get(e[0], float("inf")):
                    tie += 1
                    far[e[0]], via[e[0]] = cost, e
                    heapq.heappush(queue, (cost, tie, e[0]))
        if "to" not in far:
            break
        for node, d in far.items():
            potential[node] += d
        path, node = [], "to"
        while node != "from":
            path.append(via[node])
            node = via[node][3][0]
        amount = min(e[1] for e in path)
        for e in path:
            e[1] -= amount
            e[3][1] += amount
    return {pair: e[3][1] for pair, e in routes.items() if e[3][1]}


def mix(docs: DataFrame, sources: str = "source", weights=WEIGHTS, share: float = SHARE, passes: int = PASSES,
        seed: int = SEED) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies`` per row of ``docs``.

    ``sources`` is a column with one source or an array of them; a null source is a source, an empty
    array none. ``size`` counts words, null text has none. ``copies`` says which source each pass of
    the document fills, ``taken`` is its words over all passes. ``source_size`` and ``target`` are those
    of the document's first source. The document at which a pattern's flow ends gives only the words up to
    there, so the flow is met to the word. Repeated rows count each for themselves.
    """
    spark = docs.sparkSession
    is_array = dict(docs.dtypes)[sources].startswith("array")
    members = F.array_sort(F.array_distinct(F.coalesce(F.col(sources), F.array()))) if is_array else F.array(sources)
    text = F.coalesce("text", F.lit(""))
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), members.cast("array<string>").alias("pattern"),
                        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64("text").alias("raw"))
    sized = sized.withColumn("seeded", F.xxhash64("doc_id", "raw", F.lit(seed))).withColumn(
        "slice", F.pmod("seeded", F.lit(SLICES)).cast("int"))
    slices = sized.groupBy("pattern", "slice").agg(F.sum("size").alias("words"))
    patterns = slices.groupBy("pattern").agg(F.sum("words").alias("words"))
    found = patterns.limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    capacity = {tuple(r["pattern"]): r["words"] for r in found}
    sizes: dict = {}
    for pattern, n in capacity.items():
        for source in pattern:
            sizes[source] = sizes.get(source, 0) + n
    targets = source_targets(sizes, weights, share, passes)
    flow = min_cost_flow(capacity, {s: round(t) for s, t in targets.items()}, passes)
    rows = []
    for pattern, n in capacity.items():
        upto, ranges = 0, []
        for source in pattern:
            if words := flow.get((pattern, source), 0):
                upto += words
                ranges.append((source, upto))
        first = pattern[:1]
        rows.append((list(pattern), n, upto, ranges, sum(sizes[s] for s in first), float(sum(targets[s] for s in first))))
    plan = spark.createDataFrame(rows, "pattern array<string>, words long, flow long, ranges array<struct<source:string,"
                                       "upto:long>>, source_size long, target double")
    in_order = Window.partitionBy("pattern").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select("pattern", "slice", F.coalesce(F.sum("words").over(in_order), F.lit(0)).alias("offset"))
    offsets = offsets.join(F.broadcast(plan), "pattern")  # at most MAX_PATTERNS rows
    in_slice = (Window.partitionBy("pattern", "slice").orderBy("seeded", "doc_id", "raw")
                .rowsBetween(Window.unboundedPreceding, -1))
    placed = sized.withColumn("before", F.coalesce(F.sum("size").over(in_slice), F.lit(0))).join(
        offsets, ["pattern", "slice"])
    start = F.col("offset") + F.col("before")

    def copy(k):
        at = k * F.col("words") + start
        return F.struct(F.get(F.filter("ranges", lambda r: r["upto"] > at), F.lit(0))["source"].alias("source"),
                        F.greatest(F.lit(0), F.least("size", F.col("flow") - at)).alias("words"))

    copies = F.filter(F.array(*(copy(k) for k in range(passes))), lambda c: c["words"] > 0)
    return placed.withColumn("copies", copies).select(
        "doc_id", "size", "source_size", "target",
        F.aggregate("copies", F.lit(0).cast("long"), lambda n, c: n + c["words"]).alias("taken"), "copies")

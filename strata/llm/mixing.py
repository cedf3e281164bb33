"""Mixing overlapping sources to target sizes by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong to). Words
flow from patterns to source quotas; the first pass over a pattern's documents costs
little, every repetition costs more (convex), so the flow repeats as little as the quotas
allow. The graph has a node per pattern and source, not per document, and is solved on
the driver. Documents then fill the flow in a seeded order, laid out in two levels
(buckets of a pattern, documents of a bucket), so that no task holds a whole source.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import stored, whole_text

SEED = 20_240_601
#: Documents of a bucket, about; the bucket in which a flow ends is filled greedily.
BUCKET = 4096
#: Cost a word of the first, second, ... pass over a pattern.
PASS_COST = (1, 4, 16, 64)
#: Patterns above which the plan is joined by a shuffle instead of a broadcast.
BROADCAST_PATTERNS = 100_000


def word_count(text: Column) -> Column:
    """Number of runs without ASCII white space."""
    parts = F.split(text, r"[\x20\x09-\x0D]+")
    edge = F.when(F.element_at(parts, 1) == "", 1).otherwise(0) + F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
    return (F.size(parts) - edge).cast("long")


def capped_targets(sizes: list[int], weights: list[float], share: float, most: float) -> list[float]:
    """``share`` times all sizes dealt by weight; above ``most`` times its size a target stops there and the rest is dealt anew."""
    left, free, out = float(share * sum(sizes)), [i for i, s in enumerate(sizes) if s > 0], [0.0] * len(sizes)
    while free:
        whole = sum(weights[i] for i in free)
        for i in free:
            out[i] = left * weights[i] / whole
        over = [i for i in free if out[i] > most * sizes[i]]
        if not over:
            break
        for i in over:
            out[i] = float(most * sizes[i])
            left -= out[i]
        free = [i for i in free if i not in set(over)]
        left = max(left, 0.0)
    return out


def min_cost_flow(capacity: list[int], members: list[list[int]], quotas: list[int], passes: int) -> list[dict[int, int]]:
    """Words from each pattern to each of its sources: quotas filled as far as possible, at least cost.

    Sources that no chain of patterns links have flows of their own, so many sources with
    documents of one source each take a step each.
    """
    root = list(range(len(quotas)))

    def find(s: int) -> int:
        while root[s] != s:
            root[s] = root[root[s]]
            s = root[s]
        return s

    for sources in members:
        for s in sources[1:]:
            root[find(s)] = find(sources[0])
    parts: dict[int, tuple[list[int], list[int]]] = {}
    for s in range(len(quotas)):
        parts.setdefault(find(s), ([], []))[1].append(s)
    for p, sources in enumerate(members):
        if sources:
            parts[find(sources[0])][0].append(p)
    flows: list[dict[int, int]] = [{} for _ in capacity]
    for patterns, sources in parts.values():
        at = {s: i for i, s in enumerate(sources)}
        found = _linked_flow([capacity[p] for p in patterns], [[at[s] for s in members[p]] for p in patterns], [quotas[s] for s in sources], passes)
        for p, flow in zip(patterns, found, strict=True):
            flows[p] = {sources[i]: words for i, words in flow.items()}
    return flows


def _linked_flow(capacity: list[int], members: list[list[int]], quotas: list[int], passes: int) -> list[dict[int, int]]:
    """The flow of linked sources.

    Successive shortest paths over (start, patterns, sources, end); a pattern has an arc
    from the start for each pass, dearer from pass to pass.
    """
    n, m = len(capacity), len(quotas)
    start, end, arcs, out = n + m, n + m + 1, [], [[] for _ in range(n + m + 2)]

    def arc(a: int, b: int, cap: int, cost: int) -> None:
        out[a].append(len(arcs))
        arcs.append([b, cap, cost])
        out[b].append(len(arcs))
        arcs.append([a, 0, -cost])

    for p in range(n):
        for k in range(passes):
            arc(start, p, capacity[p], PASS_COST[min(k, len(PASS_COST) - 1)] * 4 ** max(0, k - len(PASS_COST) + 1))
        for s in members[p]:
            arc(p, n + s, passes * capacity[p], 0)
    for s in range(m):
        arc(n + s, end, quotas[s], 0)
    while True:
        dist, via, queue, queued = {start: 0}, {}, deque([start]), {start}
        while queue:
            a = queue.popleft()
            queued.discard(a)
            for i in out[a]:
                b, cap, cost = arcs[i]
                if cap > 0 and dist[a] + cost < dist.get(b, math.inf):
                    dist[b], via[b] = dist[a] + cost, i
                    if b not in queued:
                        queue.append(b)
                        queued.add(b)
        if end not in dist:
            break
        path, b = [], end
        while b != start:
            path.append(via[b])
            b = arcs[via[b] ^ 1][0]
        push = min(arcs[i][1] for i in path)
        for i in path:
            arcs[i][1] -= push
            arcs[i ^ 1][1] += push
    flows: list[dict[int, int]] = [{} for _ in range(n)]
    for p in range(n):
        for i in out[p]:
            b = arcs[i][0]
            if n <= b < n + m and i % 2 == 0 and arcs[i ^ 1][1]:
                flows[p][b - n] = arcs[i ^ 1][1]
    return flows


def fill(kinds: pd.DataFrame) -> pd.DataFrame:
    """How many documents of each kind (same id and size, ``n`` of them) of the bucket in which a flow ends
    get one more copy, in seeded order, so that they sum up near ``rest``."""
    kinds = kinds.sort_values(["seeded", "size"], kind="stable")
    rest, sizes, counts, take = int(kinds["rest"].iloc[0]), kinds["size"].tolist(), kinds["n"].tolist(), []
    for size, n in zip(sizes, counts, strict=True):
        take.append(min(n, max(0, rest) // size) if size > 0 else 0)
        rest -= size * take[-1]
    left = [(abs(rest - s), i) for i, s in enumerate(sizes) if take[i] < counts[i] and s > 0]
    if left and min(left)[0] < rest:  # one more that overshoots by less than what is missing
        take[min(left)[1]] += 1
    return kinds[["key", "seeded", "size", "n"]].assign(take=take)


def _extra_copies(ends: DataFrame) -> DataFrame:
    """(row, extra) of the rows of ``ends``. Rows of one id and size count as one kind, so a hot id is a few
    kinds; where only some of a kind are taken, they are numbered by input partition and within it."""
    kind = ["key", "seeded", "size"]
    kinds = ends.groupBy(*kind, "rest").agg(F.count(F.lit(1)).alias("n"))
    filled = stored(kinds.groupBy("key").applyInPandas(fill, "key string, seeded long, size long, n long, take long"), "mix-filled")
    whole = ends.join(filled.where("take = 0 or take = n"), kind).select("row", (F.col("take") > 0).cast("int").alias("extra"))
    some = ends.join(filled.where("take > 0 and take < n"), kind).withColumn("part", F.shiftright("row", 33))
    upto = Window.partitionBy(*kind).orderBy("part")
    before = some.groupBy(*kind, "part").agg(F.count(F.lit(1)).alias("here")).withColumn("before", F.sum("here").over(upto) - F.col("here")).drop("here")
    number = F.row_number().over(Window.partitionBy(*kind, "part").orderBy("row"))
    some = some.withColumn("number", number).join(before, [*kind, "part"])
    return whole.unionByName(some.select("row", (F.col("before") + F.col("number") <= F.col("take")).cast("int").alias("extra")))


def mix(documents: DataFrame, quotas: Iterable[tuple[str | None, float]], passes: int = 2, seed: int = SEED) -> DataFrame:
    """Add ``copies`` (0 to ``passes``) and ``routed`` (words of a document by source) to stored documents.

    ``documents`` has row (unique), sources (array of its memberships, null being a source
    too), size. Each document of a pattern gets the passes that its pattern's flow makes
    in full; the rest of the flow goes to a seeded selection.
    """
    spark = documents.sparkSession
    names = [s for s, _ in quotas]
    at = {s: i for i, s in enumerate(names)}
    found = documents.groupBy("sources").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("docs")).collect()  # a row a pattern
    members = [[at[s] for s in r["sources"] if s in at] for r in found]
    flows = min_cost_flow([int(r["size"]) for r in found], members, [round(q) for _, q in quotas], passes)
    plan = []
    for r, flow in zip(found, flows, strict=True):
        size, whole = int(r["size"]), sum(flow.values())
        full = min(passes, whole // size) if size else 0
        shares = {names[s]: w / whole for s, w in flow.items()} if whole else {}
        plan.append((r["sources"], full, whole - full * size, max(1, math.ceil(r["docs"] / BUCKET)), list(shares.items())))
    plan = spark.createDataFrame(plan, "sources array<string>, full int, rest long, buckets int, shares array<struct<source:string,share:double>>")
    if len(found) <= BROADCAST_PATTERNS:
        plan = F.broadcast(plan)
    # Join on text of the pattern: arrays that hold nulls are not equal to themselves.
    key = F.to_json(F.struct("sources"))
    seeded = F.xxhash64(F.lit(seed), F.col("doc_id"))
    unit = F.shiftrightunsigned(seeded, 11) / F.lit(float(1 << 53))
    laid = documents.withColumn("key", key).join(plan.withColumn("key", key).drop("sources"), "key")
    laid = laid.withColumn("seeded", seeded).withColumn("bucket", F.least(F.floor(unit * F.col("buckets")), F.col("buckets") - 1).cast("int"))
    order = Window.partitionBy("key").orderBy("bucket")
    upto = F.sum("words").over(order)
    buckets = laid.groupBy("key", "bucket", "rest").agg(F.sum("size").alias("words")).select("key", "bucket", "words", (upto - F.col("words")).alias("before"))
    laid = laid.join(buckets, ["key", "bucket"])
    inside = (F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest"))
    ends = laid.where(inside).select("key", "row", "seeded", "size", (F.col("rest") - F.col("before")).alias("rest"))
    filled = _extra_copies(stored(ends, "mix-ends"))
    whole = F.when(F.col("before") + F.col("words") <= F.col("rest"), 1).otherwise(0)
    copies = F.col("full") + F.coalesce("extra", whole)
    routed = F.transform("shares", lambda s: F.struct(s["source"].alias("source"), (s["share"] * copies * F.col("size")).alias("words")))
    return laid.join(filled, "row", "left").withColumn("copies", copies.cast("long")).withColumn("routed", routed).drop("key", "full", "rest", "buckets", "shares", "seeded", "bucket", "words", "before", "extra")


def mixed_documents(documents: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, passes: int = 2, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, source of every document row.

    Sources by code point, null last, weigh ``weights`` in turn and share ``share`` times
    all words; a target stops at ``passes`` times its source's words and the excess is
    dealt anew. A null or empty text has size 0 and is never taken. Repeated rows are rows
    of their own. The same rows give the same mix, however they are partitioned, but for
    which of several rows with the same doc_id and size is taken. Reads doc_id, text and source.
    """
    docs = stored(documents.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.col("source").cast("string").alias("source"), word_count(whole_text()).alias("size"),
    ), "mix-sizes")
    found = docs.groupBy("source").agg(F.sum("size").alias("size")).orderBy(F.col("source").asc_nulls_last()).collect()  # a row a source
    sizes = [int(r["size"]) for r in found]
    targets = capped_targets(sizes, [weights[i % len(weights)] for i in range(len(found))], share, passes)
    names = [r["source"] for r in found]
    goals = docs.sparkSession.createDataFrame(list(zip(names, sizes, targets, strict=True)), "name string, source_size long, target double")
    mixed = mix(docs.withColumn("sources", F.array("source")), list(zip(names, targets, strict=True)), passes, seed)
    if len(found) <= BROADCAST_PATTERNS:
        goals = F.broadcast(goals)
    return mixed.join(goals, F.col("source").eqNullSafe(F.col("name"))).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "source"
    )



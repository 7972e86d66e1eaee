"""Mix overlapping sources to target weights by min-cost flow.

Documents are added up by membership pattern, the set of sources they belong to.  A
network leads tokens from patterns to the sources they belong to: a pattern
gives its size once for every repetition, at a cost that rises with each part of a repetition
(convex), and a source takes its quota.  A least-cost largest flow fills the quotas while
repeating as little and as evenly as it can.  As costs lie on the arcs into patterns only, it
comes from largest flows with one cost level after the other opened.  Patterns that share no
source, directly or through others, do not meet: each connected part of the network is solved by itself.

The flow of a pattern is then laid over its documents in seeded order, repeated end to end: a source takes an
interval of that line.  A document at an interval's end is taken in part, so quotas are met to the word.

Defined results: a NULL source is a source, the last one; a document without any source is taken by none.
NULL and blank texts have size 0 and are taken by none.  Repeated rows count as often as they occur; documents
are ordered by the hash of seed and id, then id, then size, so runs agree; rows that tie in all of these are alike.
A document longer than its source's target is taken in part.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicewright.llm.common import WORD, saved
from slicewright.llm.components import components
from slicewright.llm.ordering import numbered

#: Parts of a repetition that have a cost of their own.
PARTS = 4


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(source: Column) -> Column:
    """Text that orders sources by code point, NULL last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def targets(sources: DataFrame, total: int, weights: Sequence[float], share: float, most: int) -> DataFrame:
    """``sources`` (key, place, source_size) with the ``target`` words of each.

    A target stops at ``most`` times its source's size; what is above goes to the others by weight, until
    none is above.  A round asks for two sums, whatever the number of sources.
    """
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("place") % len(weights) + 1).cast("int"))
    now = saved(sources.withColumn("weight", weight).withColumn("target", F.lit(None).cast("double")), "targets")
    while True:
        spent, open_weight = now.agg(F.sum("target"), F.sum(F.when(F.col("target").isNull(), F.col("weight")))).first()
        left = share * total - (spent or 0.0)
        if not open_weight:
            return now
        part = F.lit(left) * F.col("weight") / F.lit(open_weight)
        limit = (most * F.col("source_size")).cast("double")
        if now.where(F.col("target").isNull() & (part > limit)).isEmpty():
            return now.withColumn("target", F.coalesce("target", part))
        now = saved(now.withColumn("target", F.coalesce("target", F.when(part > limit, limit))), "targets")


class _Network:
    """Largest flow by shortest augmenting layers; capacities may be raised between calls."""

    def __init__(self) -> None:
        self.arcs: dict[object, list[list]] = defaultdict(list)

    def arc(self, a: object, b: object, capacity: int) -> list:
        ahead, back = [b, capacity, None], [a, 0, None]
        ahead[2], back[2] = back, ahead
        self.arcs[a].append(ahead)
        self.arcs[b].append(back)
        return ahead

    def fill(self, source: object, sink: object) -> None:
        while True:
            depth, queue = {source: 0}, deque([source])
            while queue:
                at = queue.popleft()
                for to, room, _ in self.arcs[at]:
                    if room and to not in depth:
                        depth[to] = depth[at] + 1
                        queue.append(to)
            if sink not in depth:
                return
            tried = dict.fromkeys(self.arcs, 0)
            while self._augment(source, sink, depth, tried):
                pass

    def _augment(self, source: object, sink: object, depth: dict, tried: dict) -> bool:
        path: list[list] = []
        at = source
        while at != sink:
            arcs = self.arcs[at]
            while tried[at] < len(arcs) and not (arcs[tried[at]][1] and depth.get(arcs[tried[at]][0]) == depth[at] + 1):
                tried[at] += 1
            if tried[at] < len(arcs):
                path.append(arcs[tried[at]])
                at = path[-1][0]
            elif path:
                at = path.pop()[2][0]  # a dead end
                tried[at] += 1
            else:
                return False
        room = min(x[1] for x in path)
        for x in path:
            x[1] -= room
            x[2][1] += room
        return True


def least_cost_flow(sizes: dict[int, int], members: dict[int, Sequence[int]], quotas: dict[int, int], most: int) -> dict[tuple[int, int], int]:
    """Words that flow from each pattern to each of its sources."""
    network = _Network()
    supply = {p: network.arc("in", ("p", p), 0) for p in sorted(sizes)}
    carried = {(p, s): network.arc(("p", p), ("s", s), sum(quotas.values())) for p in sorted(sizes) for s in sorted(members[p])}
    for s in sorted(quotas):
        network.arc(("s", s), "out", quotas[s])
    for level in range(PARTS * most):
        for p, arc in supply.items():
            arc[1] += sizes[p] * (level + 1) // PARTS - sizes[p] * level // PARTS
        network.fill("in", "out")
    return {key: arc[2][1] for key, arc in carried.items()}


_FLOW = "pattern_id long, place long, words long"


def _solve(most: int):
    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        members = rows.groupby("pattern_id")["place"].apply(list).to_dict()
        sizes = {int(p): int(n) for p, n in zip(rows["pattern_id"], rows["size"])}
        quotas = {int(s): int(q) for s, q in zip(rows["place"], rows["quota"])}
        flow = least_cost_flow(sizes, members, quotas, most)
        return pd.DataFrame([(p, s, w) for (p, s), w in flow.items()], columns=["pattern_id", "place", "words"])

    return solve


def _flows(patterns: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """Every pattern with its size and the intervals of its line that sources take."""
    arcs = patterns.select("pattern", "pattern_id", "size", F.explode("members").alias("key")).join(sources, "key")
    quota = F.floor(F.col("target") + 0.5).cast("long")
    arcs = saved(arcs.select("pattern", "pattern_id", "size", "key", "place", quota.alias("quota")), "arcs")
    parts = components(arcs.select((2 * F.col("pattern_id")).alias("a"), (2 * F.col("place") + 1).alias("b")))
    in_part = arcs.join(parts.withColumnRenamed("id", "_id"), F.col("_id") == 2 * F.col("pattern_id"))
    solved = saved(in_part.select("comp", "pattern_id", "size", "place", "quota").groupBy("comp").applyInPandas(_solve(most), _FLOW), "flows")
    taken = arcs.join(solved, ["pattern_id", "place"]).groupBy("pattern", "size").agg(
        F.array_sort(F.collect_list(F.struct("place", "key", "words"))).alias("flows")
    )  # one entry for each source of the pattern
    ends = F.transform("flows", lambda f, i: F.struct(
        f["key"].alias("key"), f["words"].alias("words"),
        F.aggregate(F.slice(F.col("flows"), F.lit(1), i), F.lit(0).cast("long"), lambda a, x: a + x["words"]).alias("start"),
    ))
    return saved(taken.select("pattern", F.col("size").alias("line"), ends.alias("flows")), "lines")


def _overlap(flow: Column, most: int) -> Column:
    """Words of a document's repetitions that lie in the interval of a source."""
    total = F.lit(0).cast("long")
    for r in range(most):
        start = F.col("before") + r * F.col("line")
        inside = F.least(start + F.col("size"), flow["start"] + flow["words"]) - F.greatest(start, flow["start"])
        total = total + F.greatest(F.lit(0).cast("long"), inside)
    return total


def mix(
    docs: DataFrame, size: Column, members: Column, *, id_col: str = "doc_id",
    weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: str = "mix",
) -> tuple[DataFrame, DataFrame]:
    """What is taken of every document, and the sources.

    ``members`` is the array of source names of a document.  Sources, by code point and NULL last, have the
    ``weights`` in turn and share ``share`` times all sizes.  Documents: ``id``, ``size``, ``parts`` (array of ``source``,
    ``taken``) and ``taken``.  Sources: ``source``, ``source_size``, ``target``.
    """
    keys = F.array_sort(F.array_distinct(F.transform(F.coalesce(members, F.array().cast("array<string>")), _key)))
    rows = saved(docs.select(F.col(id_col).alias("id"), size.alias("size"), keys.alias("members")), "sizes")
    rows = rows.withColumn("pattern", F.to_json("members"))
    sums = saved(rows.groupBy("pattern", "members").agg(F.sum("size").alias("size")), "patterns")
    total = sums.agg(F.sum("size")).first()[0] or 0
    by_source = sums.select(F.explode("members").alias("key"), "size").groupBy("key").agg(F.sum("size").alias("source_size"))
    sources = saved(targets(numbered(saved(by_source, "sources"), [], [F.col("key").asc()]), total, weights, share, most), "sources")
    patterns = saved(numbered(sums, [], [F.col("pattern").asc()]).withColumnRenamed("place", "pattern_id"), "patterns")
    lines = _flows(patterns, sources, most)

    turn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    order = [F.col("turn").asc(), F.col("id").asc_nulls_first(), F.col("size").asc()]
    placed = numbered(rows.select("id", "size", "pattern", turn.alias("turn")), ["pattern"], order, size="size")
    parts = F.transform("flows", lambda f: F.struct(_name(f["key"]).alias("source"), _overlap(f, most).alias("taken")))
    taken = placed.join(lines, "pattern", "left").withColumn("parts", F.coalesce(parts, F.array().cast("array<struct<source:string,taken:bigint>>")))
    total_taken = F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["taken"])
    return (
        taken.select("id", "size", "parts", total_taken.alias("taken")),
        sources.select(_name(F.col("key")).alias("source"), "source_size", "target"),
    )


def _name(key: Column) -> Column:
    return F.when(key != "1", F.substring(key, F.lit(2), F.length(key)))

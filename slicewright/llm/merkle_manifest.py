"""A Merkle manifest of a dataset, with a proof for every row.

Every row is a leaf, the SHA-256 of its fields.  The leaves of a group, by
id, are the bottom of a binary tree (the last node of an odd level goes up
alone), whose top is the group's subroot; the subroots, by group, are the bottom
of one more tree, whose top is the root.

Trees are built ten levels at a time, from blocks of 1,024 neighbours.  Proofs come
by pointer jumping: each node holds its segment, the siblings on the way to an
ancestor.  A self-join with the segments of those ancestors doubles the distance,
until every leaf reaches the root: as many joins as the logarithm of the height.
A segment at distance 2^j is only asked for at levels that are multiples of it, so
no others are kept.  Every join is by tree and ancestor, which at most 2^j leaves share.

Defined results: NULL fields are hashed as ``-``; rows without an id come first in
their group, rows without a group form the first one.  Rows of one id are ordered by
leaf, so repeated rows (equal leaves) have proofs that can be swapped.  A single row is its own subroot
and, where it is the only one, the root, with an empty proof.  An empty table gives no rows.
Texts are hashed whole; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicewright.llm.common import saved
from slicewright.llm.ordering import numbered

#: Levels built at once; a block holds two to this power nodes.
LEVELS = 10
#: Segments whose number is bounded by rows / 2^stride are broadcast up to so many bytes.
BROADCAST_BYTES = 32 << 20
#: From this distance on, that bound is looked at.
FAR = 16

_NODE = "tree string, n long, level int, pos long, digest binary, side string, sibling binary"


def leaf(fields: Sequence[Column]) -> Column:
    """Digest of a row: every field as its length in bytes, a colon and its text, or ``-`` for NULL."""

    def coded(field: Column) -> Column:
        text = field.cast("string")
        whole = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        return F.when(text.isNull(), F.lit("-")).otherwise(whole)

    return F.unhex(F.sha2(F.concat(*(coded(f) for f in fields)).cast("binary"), 256))


def _parent(*children: bytes) -> bytes:
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def _climb(base: int):
    """Nodes of the next levels above blocks of neighbours at level ``base``, one row each."""

    def climb(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for block in batch.to_pylist():
                members = sorted((m["pos"], m["digest"]) for m in block["members"])
                first, digests = members[0][0], [d for _, d in members]
                height, level = (block["n"] - 1).bit_length(), base
                while level < min(height, base + LEVELS):
                    for i, digest in enumerate(digests):
                        side = "L" if i % 2 else "R" if i + 1 < len(digests) else "-"
                        sibling = b"" if side == "-" else digests[i ^ 1]
                        out.append((block["tree"], block["n"], level, first + i, digest, side, sibling))
                    digests = [_parent(*digests[i : i + 2]) for i in range(0, len(digests), 2)]
                    first, level = first >> 1, level + 1
                out.append((block["tree"], block["n"], level, first, digests[0], None, None))
            columns = list(zip(*out)) or [[]] * 7
            types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.string(), pa.binary()]
            names = ["tree", "n", "level", "pos", "digest", "side", "sibling"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return climb


def _build(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (tree, n, pos, digest): every node with its sibling, and the top of every tree."""
    nodes, tops, base, current = [], [], 0, leaves
    while True:
        member = F.struct("pos", "digest")
        blocks = current.groupBy("tree", "n", F.shiftright("pos", LEVELS).alias("block")).agg(F.collect_list(member).alias("members"))
        climbed = saved(blocks.select("tree", "n", "members").mapInArrow(_climb(base), _NODE), "nodes")
        nodes.append(climbed.where("side IS NOT NULL").select("tree", "level", "pos", F.col("side").alias("sides"), F.col("sibling").alias("siblings")))
        base += LEVELS
        # n nodes are left alone at the top when 2^level >= n
        reached = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("level")) >= F.col("n")
        ends = climbed.where("side IS NULL")
        tops.append(ends.where(reached).select("tree", "digest"))
        current = ends.where(~reached).select("tree", "n", "pos", "digest")
        if current.isEmpty():
            return _all(nodes), _all(tops)


def _all(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionAll(t)
    return out


def _jump(held: DataFrame, segments: DataFrame, stride: int, rows: int) -> DataFrame:
    """``held`` with the segment of the ancestor ``stride`` levels further up appended, where there is one."""
    further = segments.where(F.col("level") % (2 * stride) == stride).select(
        F.col("tree").alias("_tree"), F.col("level").alias("_level"), F.col("pos").alias("_pos"),
        F.col("sides").alias("_sides"), F.col("siblings").alias("_siblings"),
    )
    if stride >= FAR and (rows >> stride) * (33 * stride + 64) <= BROADCAST_BYTES:
        further = F.broadcast(further)  # one row for each 2^stride leaves, and less above them
    else:
        further = further.hint("merge")  # the same plan whatever the size
    here = (F.col("tree") == F.col("_tree")) & (F.col("level") + stride == F.col("_level"))
    same = here & (F.shiftright("pos", stride) == F.col("_pos"))
    joined = held.join(further, same, "left")
    return joined.select(
        *(c for c in held.columns if c not in ("sides", "siblings")),
        F.concat("sides", F.coalesce("_sides", F.lit(""))).alias("sides"),
        F.concat("siblings", F.coalesce("_siblings", F.lit(b""))).alias("siblings"),
    )


def prove(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Proof of every leaf (tree, n, pos, digest) towards the top of its tree, and the tops.

    A proof has ``sides``, a letter per level (L, R: where the sibling stands; ``-``: none), and ``siblings``,
    their digests one after the other.  The leaves keep their other columns.
    """
    nodes, tops = _build(leaves.select("tree", "n", "pos", "digest"))
    sizes = leaves.agg(F.max("n"), F.count("*")).first()
    height, rows = max((sizes[0] or 1) - 1, 0).bit_length(), sizes[1]
    bottom = nodes.where("level = 0").select(*(F.col(c).alias(f"_{c}") for c in ("tree", "pos", "sides", "siblings")))
    own = (F.col("tree") == F.col("_tree")) & (F.col("pos") == F.col("_pos"))
    proofs = leaves.withColumn("level", F.lit(0)).join(bottom.hint("merge"), own, "left").select(
        *leaves.columns, F.lit(0).alias("level"),
        F.coalesce("_sides", F.lit("")).alias("sides"), F.coalesce("_siblings", F.lit(b"")).alias("siblings"),
    )
    segments, stride = nodes.where("level > 0"), 1
    while stride < height:
        proofs = _jump(proofs, segments, stride, rows)
        kept = segments.where(F.col("level") % (2 * stride) == 0)
        segments = saved(_jump(kept, segments, stride, rows), "segments")
        stride *= 2
    return proofs.drop("level"), tops


def folded(digest: Column, sides: Column, siblings: Column) -> Column:
    """What a leaf and the siblings of its proof come to at the root; all digests as hexadecimal text."""

    def step(at, i):
        side, sibling = F.substring(sides, i, F.lit(1)), F.substring(siblings, at["next"], F.lit(64))
        both = F.when(side == "L", F.concat(sibling, at["digest"])).when(side == "R", F.concat(at["digest"], sibling))
        up = F.sha2(F.coalesce(both, at["digest"]).cast("binary"), 256)
        return F.struct(up.alias("digest"), (at["next"] + F.when(side == "-", 0).otherwise(64)).alias("next"))

    start = F.struct(digest.alias("digest"), F.lit(1).alias("next"))
    climbed = F.aggregate(F.sequence(F.lit(1), F.length(sides)), start, step)["digest"]
    return F.when(F.length(sides) == 0, digest).otherwise(climbed)


def manifest(docs: DataFrame, fields: Mapping[str, Column], *, group: str, order: str, changed: Mapping[str, Column] | None = None) -> DataFrame:
    """``id``, ``leaf``, ``subroot``, ``root``, ``sides`` and ``proof`` (the siblings) of every row; digests as hexadecimal text.

    ``fields`` are the hashed columns of ``docs``, in order; ``group`` and ``order`` name the column that parts the trees
    and the one that orders their leaves.  ``changed`` replaces fields as if the rows had been altered afterwards:
    ``changed_leaf`` is the leaf they then have.
    """
    altered = {**fields, **(changed or {})}
    tree = F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    hashed = docs.select(
        F.col(order).alias("id"), tree.alias("tree"), leaf(list(fields.values())).alias("digest"),
        *([leaf(list(altered.values())).alias("changed")] if changed else []),
    )
    if changed:  # most rows are not altered: kept once
        hashed = hashed.withColumn("changed", F.when(F.col("changed") != F.col("digest"), F.col("changed")))
    ordered = numbered(saved(hashed, "leaves"), ["tree"], [F.col("id").asc_nulls_first(), F.col("digest").asc()])
    placed = saved(ordered.withColumnRenamed("place", "pos"), "places")
    counts = saved(placed.groupBy("tree").agg(F.count("*").alias("n")), "counts")
    proofs, subroots = prove(placed.join(counts, "tree"))
    subroots = saved(subroots, "subroots")

    above = numbered(subroots, [], [F.col("tree").asc()])
    upper, root = prove(
        above.select(F.lit("").alias("tree"), F.col("tree").alias("member"), F.lit(subroots.count()).cast("long").alias("n"),
                     F.col("place").alias("pos"), "digest")
    )
    upper = saved(
        upper.select(
            F.col("member").alias("tree"), F.lower(F.hex("digest")).alias("subroot"),
            F.col("sides").alias("_sides"), F.col("siblings").alias("_siblings"),
        ),
        "upper",
    )
    tops = root.agg(F.lower(F.hex(F.max("digest"))).alias("root"))  # one row
    return proofs.join(upper, "tree").crossJoin(F.broadcast(tops)).select(
        "id",
        F.lower(F.hex("digest")).alias("leaf"),
        *([F.lower(F.hex(F.coalesce("changed", "digest"))).alias("changed_leaf")] if changed else []),
        "subroot",
        "root",
        F.concat("sides", "_sides").alias("sides"),
        F.lower(F.hex(F.concat("siblings", "_siblings"))).alias("proof"),
    )

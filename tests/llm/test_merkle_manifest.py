import hashlib
import random
import zlib
from collections import Counter

import pytest
from helpers import awkward, docs
from pyspark.sql import functions as F

from slicewright.llm import merkle_manifest

NAMES = ("doc_id", "source", "lang", "n_chars", "text")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def coded(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    """Top of a tree and, for each leaf, the siblings on its way with their side."""
    ways, spans = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, over = [], []
        for i in range(0, len(nodes), 2):
            pair = nodes[i : i + 2]
            for k, members in enumerate(spans[i : i + 2]):
                for m in members:
                    ways[m].append(None if len(pair) == 1 else ("RL"[k], pair[1 - k]))
            up.append(h(*pair))
            over.append(sum(spans[i : i + 2], []))
        nodes, spans = up, over
    return nodes[0], ways


def fold(leaf, way):
    for step in way:
        leaf = h(leaf) if step is None else h(step[1], leaf) if step[0] == "L" else h(leaf, step[1])
    return leaf


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, h(*(coded(r[n]) for n in NAMES)), r))
    ordered = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in ordered}
    root, above = tree([trees[g][0] for g in ordered])
    out = []
    for g, over in zip(ordered, above):
        for (_, _, leaf, r), way in zip(sorted(groups[g], key=lambda x: x[:3]), trees[g][1]):
            d, n = r["doc_id"], r["n_chars"]
            bad = d is not None and n is not None and zlib.crc32(str(d).encode()) % 7 == 0
            changed = h(*(coded(n + 1 if bad and c == "n_chars" else r[c]) for c in NAMES))
            assert fold(leaf, way + over) == root
            out.append((d, leaf, trees[g][0], root, h(*(s[1] for s in way + over if s)), fold(changed, way + over)))
    return out


def run(df):
    more = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    out = merkle_manifest.manifest(df, {n: F.col(n) for n in NAMES}, group="lang", order="doc_id", changed={"n_chars": more})
    end = merkle_manifest.folded(F.col("changed_leaf"), F.col("sides"), F.col("proof"))
    return [tuple(r) for r in out.select("id", "leaf", "subroot", "root", F.sha2("proof", 256), end).collect()]


@pytest.mark.parametrize("levels", [10, 2, 1])
def test_proofs_equal_a_plain_tree(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle_manifest, "LEVELS", levels)
    rng = random.Random(levels)
    rows = [(i, f"text {i}", rng.choice(["en", "de", None, "fr", "日本"]), rng.choice(["s", None])) for i in range(137)]
    rows += [(d, t, "en", "s") for d, t in awkward()] + [(500, "alone", "xx", "s")]
    df = docs(spark, rows)
    want = plain([r.asDict() for r in df.collect()])
    got = run(df)
    assert Counter(got) == Counter(want)
    assert any(r[5] != r[3] for r in got) and any(r[5] == r[3] for r in got)


def test_large_group_takes_several_passes(spark):
    rows = [(i * 3, f"t{i}", "en" if i % 3 else "de") for i in range(2600)]
    df = docs(spark, rows)
    assert Counter(run(df)) == Counter(plain([r.asDict() for r in df.collect()]))


def test_broadcast_segments_change_nothing(spark, monkeypatch):
    df = docs(spark, [(i, f"t{i}") for i in range(100)])
    full = run(df)
    monkeypatch.setattr(merkle_manifest, "FAR", 1)
    assert Counter(run(df)) == Counter(full)


def test_one_row_and_none(spark):
    (only,) = run(docs(spark, [(7, "a")]))
    assert only[1] == only[2] == only[3] and only[4] == h()
    assert run(docs(spark, [(7, "a")]).limit(0)) == []

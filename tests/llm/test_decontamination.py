import random
from collections import Counter

import numpy as np
import pytest
from helpers import awkward, docs, prose

from slicewright.llm import decontamination as dc


def brute(rows, items):
    out = {}
    for k, t in items:
        words = dc.WORD.findall((t or "").lower())
        own = Counter(dc.shingles(words))
        for d, text in rows:
            text = dc.WORD.findall((text or "").lower())
            for i in range(len(text) - len(words) + 1 if words else 0):
                s = dc.similarity(Counter(dc.shingles(text[i : i + len(words)])), own)
                if s >= dc.SIMILARITY and s > out.get((d, k), (0,))[0]:
                    out[d, k] = (s, i, len(words))
    return out


def test_windows_like_items(spark):
    rng = random.Random(1)
    items = [(i, prose(rng, rng.randrange(15, 60), 3000)) for i in range(30)] + [(50, None), (51, ""), (52, "Two words"), (53, "!!")]
    rows = awkward()[:12]
    for i, (_, t) in enumerate(items[:30]):
        w = t.split()
        if i % 3 == 1:
            w = w[1:]
        if i % 3 == 2:
            w[-1] = "changed"
        rows.append((100 + i, prose(rng, 50, 3000) + ". " + " ".join(w).upper() + ", " + prose(rng, 50, 3000)))
    rows += [(300, prose(rng, 500, 3000)), (301, "two, words"), (302, items[0][1] + " " + items[0][1])]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = dc.contaminated(docs(spark, rows), table).collect()
    want = brute(rows, items)
    assert {(r.doc_id, r.item_id): (r.similarity, r.first_word, r.n_words) for r in got} == want
    assert len(want) > 25 and not any(d == 300 for d, _ in want)
    assert dc.contaminated(docs(spark, []), table).collect() == []
    assert dc.contaminated(docs(spark, rows), table.limit(0)).collect() == []


def test_cut_items_that_are_whole_documents(spark):
    rng = random.Random(5)
    items = [(i, prose(rng, rng.randrange(20, 60), 3000)) for i in range(30)] + [(50, "one two three four five six"), (51, "a b c")]
    rows = [(500, "one two three four five"), (501, "one two three four"), (502, "a b")]
    for i, t in items[:30]:
        w = t.split()
        rows += [(100 + i, " ".join(w[:-1])), (200 + i, " ".join(w[2:])), (300 + i, " ".join(w[1:-2])), (400 + i, " ".join(w[: len(w) // 2]))]
    want = brute(rows, items)
    for k, t in items:
        words = dc.WORD.findall(t)
        for d, text in rows:
            own = dc.WORD.findall(text)
            s = dc.similarity(Counter(dc.shingles(own)), Counter(dc.shingles(words)))
            if len(own) < len(words) and s >= dc.SIMILARITY:
                want[d, k] = (s, 0, len(own))
    got = dc.contaminated(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): (r.similarity, r.first_word, r.n_words) for r in got} == want
    assert all((100 + i, i) in want and (400 + i, i) not in want for i in range(30))


def test_items_in_blocks(spark, monkeypatch):
    items = [(i, prose(random.Random(i), 20, 500)) for i in range(40)]
    rows = [(i, "x " + t) for i, t in items]
    monkeypatch.setattr(dc, "BLOCK_WORDS", 100)
    got = dc.contaminated(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(i, i) for i, _ in items}


@pytest.mark.parametrize("cost", [4, 0])
@pytest.mark.parametrize("pairs", [1 << 22, 300])
def test_blocks_find_all_within_the_radius(monkeypatch, cost, pairs):
    monkeypatch.setattr(dc, "LOOKUP_COST", cost)  # 0: look changes up, however few items
    monkeypatch.setattr(dc, "PAIRS", pairs)
    rng = np.random.default_rng(0)
    items = rng.integers(0, 2**63, 60).astype(np.uint64)
    items[50:] = items[:10]  # items alike
    probes = items[rng.integers(0, 60, 100)]
    for _ in range(20):
        probes = probes ^ (np.uint64(1) << rng.integers(0, 64, 100).astype(np.uint64))
    for radius in (0, 3, 16, 23):
        at, item = dc.Blocks(items, radius).near(probes)
        near = np.bitwise_count(probes[:, None] ^ items[None, :]) <= radius
        assert set(zip(at.tolist(), item.tolist())) == set(zip(*map(list, np.nonzero(near))))


def test_recall_of_the_radius(spark):
    """Over the test documents, the fingerprints lose no window that verification accepts."""
    folder = "/root/testdata/sf0.01"
    texts, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    got, all_of_them = (
        {(r.doc_id, r.item_id) for r in dc.contaminated(texts, items, radius=radius).select("doc_id", "item_id").collect()}
        for radius in (dc.RADIUS, 64)
    )
    assert got <= all_of_them and len(got) >= 0.99 * len(all_of_them)

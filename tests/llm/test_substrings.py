import random
from collections import Counter

import pyarrow as pa
import pyarrow.compute
import pytest
from helpers import awkward, digest, docs, prose, without_repeats

from slicewright.llm import suffix_refinement, super_kmers, window_exchange

SMALL = {"block_bytes": 4_000, "bucket_bytes": 2_000}


@pytest.mark.parametrize("options", [{}, SMALL, {**SMALL, "hot_blocks": 2}])
def test_repeated_bytes(spark, options):
    rows = awkward()
    got = suffix_refinement.remove_repeated_bytes(docs(spark, rows), **options).collect()
    want = []
    for d, u, gone in without_repeats(rows, 50, lambda t: t):
        kept = bytes(b for b, g in zip(u, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        want.append((d, len(u), sum(gone), spans, digest(kept)))
    assert sorted(((*r[:4], digest(bytes(r.kept))) for r in got), key=str) == sorted(want, key=str)
    assert any(w[2] for w in want)


@pytest.mark.parametrize("options", [{}, SMALL, {**SMALL, "hot_blocks": 2}])
def test_repeated_words(spark, options):
    rows = awkward(1)
    got = super_kmers.remove_repeated_words(docs(spark, rows), **options).collect()
    want = []
    for d, u, gone in without_repeats(rows, 50, bytes.split):
        want.append((d, len(u), sum(gone), digest(b" ".join(w for w, g in zip(u, gone) if not g))))
    assert sorted(((*r[:3], digest(r.kept.encode())) for r in got), key=str) == sorted(want, key=str)
    assert any(w[2] for w in want)


@pytest.mark.parametrize("run", [suffix_refinement.remove_repeated_bytes, super_kmers.remove_repeated_words])
def test_a_short_line_in_many_documents_is_split(spark, monkeypatch, run):
    rng = random.Random(6)
    line = prose(rng, 5 if run is suffix_refinement.remove_repeated_bytes else 20, 10**6)
    rows = [(i, prose(rng, 60, 10**6) + " " + line + " " + prose(rng, 60, 10**6)) for i in range(200)]
    rows += [(300, rows[7][1]), (301, rows[8][1])]
    units = super_kmers.WORDS if run is super_kmers.remove_repeated_words else suffix_refinement.BYTES
    full = run(docs(spark, rows)).collect()
    sizes = {**SMALL, "block_bytes": 40_000}
    assert sorted(run(docs(spark, rows), **sizes, hot_runs=50).collect()) == sorted(full)
    assert {r.doc_id for r in full if r.n_removed} == {300, 301}
    # the line's minimisers, and no others, are hot
    blocks = [pa.table({"id": [d for d, _ in p], "text": [t for _, t in p], "block": [k] * len(p)}) for k, p in enumerate((rows[:101], rows[101:]))]
    sent = pa.concat_tables([window_exchange._distinct_minimisers(units, b, 1) for b in blocks])
    told = window_exchange._shared_minimisers(sent, window_exchange.HOT_BLOCKS, 50)
    hot = set().union(*(window_exchange.keys_from(h).tolist() for h in told["hot"].to_pylist()))
    held = Counter(k for _, t in rows[:200] for k in set(window_exchange.runs(units, units.split(t.encode()))[2].tolist()))
    assert hot and hot == {k for k, n in held.items() if n > 50}
    # copies are one run, however many
    copies = pa.table({"id": list(range(99)), "text": [rows[0][1]] * 99, "block": [0] * 99})
    _, n = window_exchange._distinct_runs(units, copies)
    assert n.max() == 1


def travelling(units, rows, n_blocks, buckets=3):
    """How many distinct runs the blocks send."""
    parts = [rows[k::n_blocks] for k in range(n_blocks)]
    blocks = [pa.table({"id": [d for d, _ in p], "text": [t for _, t in p], "block": [k] * len(p)}) for k, p in enumerate(parts)]
    sent = pa.concat_tables([window_exchange._distinct_minimisers(units, b, buckets) for b in blocks])
    told = [window_exchange._shared_minimisers(sent.filter(pa.compute.equal(sent["bucket"], b)), 4_096, 4_096) for b in range(buckets)]
    told = pa.concat_tables(told)
    sent = [window_exchange._pack(units, b, told.filter(pa.compute.equal(told["block"], k)), buckets) for k, b in enumerate(blocks)]
    return sum(pa.compute.sum(x["n"]).as_py() or 0 for x in sent)


def test_a_short_phrase_that_many_documents_hold_does_not_travel():
    rng = random.Random(8)
    text = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    phrases = [text(24) for _ in range(30)]
    rows = [(i, "".join(text(60) + p for p in phrases) + text(60)) for i in range(20)]
    # phrases are in runs of every document, their sides differ: but for a chance of 1 in 127 a pair, none can repeat
    held = Counter(k for _, t in rows for k in set(window_exchange.runs(suffix_refinement.BYTES, t.encode())[2].tolist()))
    assert sum(n for n in held.values() if n > 1) > 250
    sent = travelling(suffix_refinement.BYTES, rows, 4)
    assert sent < 100
    assert travelling(suffix_refinement.BYTES, [*rows, (400, rows[3][1])], 4) > sent + 200


def test_windows_that_repeat_among_many_that_nearly_do(spark):
    rng = random.Random(9)
    few = lambda n: "".join(rng.choices("ab", k=n))
    spell = few(200)
    rows = [(i, few(rng.randrange(120)) + spell[a : a + n] + few(rng.randrange(120))) for i, (a, n) in enumerate((a % 100, 40 + a % 20) for a in range(60))]
    rows += [(100 + i, spell[a : a + 50]) for i, a in enumerate((0, 0, 50, 150))]  # as long as one window
    rows += [(200 + i, "ab" * 40 + c * 70 + "ab" * 40) for i, c in enumerate("aabab")]
    long = prose(rng, 12_000, 10**6)[:70_000]
    at = window_exchange.STRETCH - 30
    rows += [(300, long), (301, few(90) + long[at : at + 60] + few(90)), (302, long[:50] + few(9)), (303, few(9) + long[-50:]), (None, long[-60:])]
    rows += [(304, long[at + 49 : at + 99]), (305, "x" + long[1_000:1_049] + "x")]
    want = []
    for d, u, gone in without_repeats(rows, 50, lambda t: t):
        want.append((d, len(u), sum(gone), digest(bytes(b for b, g in zip(u, gone) if not g))))
    for options in ({}, SMALL, {**SMALL, "hot_runs": 5}):
        got = suffix_refinement.remove_repeated_bytes(docs(spark, rows), **options).collect()
        assert sorted(((*r[:3], digest(bytes(r.kept))) for r in got), key=str) == sorted(want, key=str)


def test_nothing_to_do(spark):
    for run in (suffix_refinement.remove_repeated_bytes, super_kmers.remove_repeated_words):
        assert run(docs(spark, [])).collect() == []
        assert [r.n_removed for r in run(docs(spark, [(1, None)])).collect()] == [0]


def test_refinement_is_exact_when_scrambles_collide(monkeypatch):
    import numpy as np

    monkeypatch.setattr(suffix_refinement, "mixed", lambda x: x & np.uint64(1))
    first, second = np.array([1, 3, 1, 3], np.uint64), np.array([2, 2, 2, 4], np.uint64)
    bucket, alone = suffix_refinement.refined(first, second)
    assert bucket[0] == bucket[2] and len(set(bucket.tolist())) == 3
    assert alone.tolist() == [False, True, False, True]

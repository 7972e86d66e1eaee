import random

import numpy as np
from helpers import Groups, awkward, docs, prose

from slicewright.llm import prob_minhash as pm
from slicewright.llm.components import components


def brute(rows):
    groups, sets = Groups(), {}
    for d, t in rows:
        words = pm.words_of(t)
        groups.find(d)
        if words and d is not None:
            sets[d, t] = pm.shingle_weights(words)
    keys = sorted(sets, key=str)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if pm.probability_jaccard(sets[a], sets[b]) >= pm.SIMILARITY:
                groups.union(a[0], b[0])
    return {d: groups.find(d) for d, _ in rows if d is not None}


def found(df):
    return {r.doc_id: r.class_id for r in df.collect() if r.doc_id is not None}


def edited(rng, words, n):
    out = list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = f"e{rng.randrange(10**6)}"
    return " ".join(out)


def test_classes(spark):
    rng = random.Random(2)
    rows = awkward() + [(500, "one two"), (501, "one two"), (502, "One  TWO"), (503, "one")]
    base = prose(rng, 150, 10**6).split()
    rows += [(100 + i, edited(rng, base, i % 9)) for i in range(60)]
    got = pm.classes(docs(spark, rows))
    assert got.count() == len(rows)
    assert found(got) == brute(rows)
    assert found(pm.classes(docs(spark, rows), chunk=8)) == brute(rows)  # the dense group in pairs of chunks
    assert pm.classes(docs(spark, [])).collect() == []
    assert {r.class_id for r in pm.classes(docs(spark, [(None, "a b"), (4, None)])).collect()} == {None, 4}


def test_texts_of_one_id_keep_their_links(spark):
    rng = random.Random(9)
    one, two, three = (prose(rng, 120, 10**6) for _ in range(3))
    rows = [(7, one), (7, two), (7, None), (3, two + " end"), (9, one + " end"), (12, three), (13, three + " end"), (None, one)]
    got = pm.classes(docs(spark, rows))
    assert found(got) == brute(rows) == {7: 3, 3: 3, 9: 3, 12: 12, 13: 12}
    assert sorted(str(r.class_id) for r in got.collect()) == ["12", "12", "3", "3", "3", "3", "3", "None"]
    kept = pm.first_of_each_class(docs(spark, rows)).collect()
    assert sorted((str(r.doc_id), str(r.text)[:8]) for r in kept) == sorted(
        [("3", two[:8]), ("7", one[:8]), ("7", "None"), ("12", three[:8]), ("None", one[:8])]
    )


def test_registers_estimate_probability_jaccard():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 2**63, 400).astype(np.uint64))
    b = np.unique(np.concatenate([a[:300], rng.integers(0, 2**63, 50).astype(np.uint64)]))
    x, y = (a, rng.integers(1, 5, len(a))), (b, rng.integers(1, 5, len(b)))
    p, q = (dict(zip(s.tolist(), (w / w.sum()).tolist())) for s, w in (x, y))
    want = sum(
        1 / sum(max(p.get(j, 0) / p[i], q.get(j, 0) / q[i]) for j in p.keys() | q.keys()) for i in p.keys() & q.keys()
    )
    assert abs(pm.probability_jaccard(x, y) - want) < 1e-12
    s = pm.signatures([x, y], 8192)
    assert abs((s[0] == s[1]).mean() - want) < 0.02
    one = (a, np.ones(len(a))), (b, np.ones(len(b)))
    assert abs(pm.probability_jaccard(*one) - len(np.intersect1d(a, b)) / len(np.union1d(a, b))) < 1e-12


def test_first_shared_band_is_that_of_the_whole_keys():
    import pyarrow as pa

    a = np.arange(pm.REGISTERS, dtype=np.uint64).reshape(1, -1) << np.uint64(8)
    b = a + np.uint64(1 << 40)  # all bytes of the sketches agree
    b[:, 5 * pm.ROWS : 6 * pm.ROWS] = a[:, 5 * pm.ROWS : 6 * pm.ROWS]
    b[:, 9 * pm.ROWS : 10 * pm.ROWS] = a[:, 9 * pm.ROWS : 10 * pm.ROWS]
    both = np.concatenate([a, b])
    for band, want in ((5, [(0, 1)]), (9, [])):
        unit = {"id": [7, 8], "comp": [7, 8], "chunk": [0, 0], "band": [band] * 2, "ci": [0, 0], "cj": [0, 0]}
        unit = pa.table(unit | {"sketch": [r.tobytes() for r in both.astype(np.uint8)], "bands": pm.band_keys(both).tolist()})
        _, _, left, right = pm._maybe(unit)
        assert list(zip(left.tolist(), right.tolist())) == want


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)]
    groups = Groups()
    for a, b in links:
        groups.union(a, b)
    got = {r.id: r.comp for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: groups.find(x) for a, b in links if a != b for x in (a, b)}

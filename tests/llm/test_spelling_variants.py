import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from helpers import awkward, docs

from slicewright.llm import spelling_variants

UPPER = str.maketrans(spelling_variants.UPPER, spelling_variants.LOWER)


def plain_words(rows):
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = run.translate(UPPER)
            mark = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if mark % 97 == 0:
                w = w[: mark % len(w)] + w[mark % len(w) + 1 :]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(n):
    out, form = {}, {}
    for w in n:
        near = [v for v in n if one_edit(w, v)]
        best = min(near, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
        out[w] = len(near)
    rows = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n[w], out[w], n[form[w]] if form[w] else None))
    return sorted(rows, key=str)


def vocabulary(rng, letters="abé", length=(5, 8), words=220):
    found = {"".join(rng.choice(letters) for _ in range(rng.randint(*length))) for _ in range(words)}
    return {w: int(3 * 2 ** rng.uniform(0, 6)) for w in sorted(found)}


@pytest.mark.parametrize("block", [spelling_variants.BLOCK, 5, 1])
def test_near_words_equal_all_pairs(spark, block):
    # a third of the words share a prefix, one of them has very many neighbours
    rng = random.Random(block)
    n = vocabulary(rng) | {"aaaa" + w: c for w, c in vocabulary(rng, words=110).items()}
    n |= {"kkkkkkkk"[:i] + x + "kkkkkkkk"[i + 1 :]: 3 for i in range(8) for x in "abcde"} | {"kkkkkkkk": 50, "k" * 300: 9, "k" * 301: 4}
    words = spark.createDataFrame(sorted(n.items()), "word string, n long")
    got = spelling_variants.grouped_variants(words, block=block)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_variants(n)


def test_small_batches_change_nothing(monkeypatch):
    n = vocabulary(random.Random(8))
    rows = [
        {"word": w, "n": n[w], "m": m, "by_prefix": p, "key": w[: m // 2] if p else w[len(w) - (m - m // 2) :], "i": 0, "j": 0, "second": False}
        for w in n for m in (len(w), len(w) + 1) for p in (True, False)
    ]
    rows.sort(key=lambda r: (r["m"], r["by_prefix"], r["key"]))
    total = {}
    for words, cells in ((16_384, 4_000_000), (10, 4_000_000), (100, 50)):
        monkeypatch.setattr(spelling_variants, "BATCH_WORDS", words)
        monkeypatch.setattr(spelling_variants, "BATCH_CELLS", cells)
        parts = list(spelling_variants._tiles(iter([pa.RecordBatch.from_pylist(rows)])))
        near = Counter()
        for r in pa.Table.from_batches(parts).to_pylist():
            near[r["word"]] += r["near"]
        total[words, cells] = near
    assert len(set(map(str, (sorted(t.items()) for t in total.values())))) == 1
    assert dict(near) == {w: c for w in n if (c := sum(one_edit(w, v) for v in n))}


def test_words_of_documents(spark):
    rng = random.Random(5)
    pool = list(vocabulary(rng, "abcÀé×ü", words=150)) + ["Straße", "STRASSE", "ab", "x" * 3000]
    rows = [(i, " ".join(rng.choice(pool).capitalize() for _ in range(60)) + "\n1a2b" + "_Wörter-wörter") for i in range(150)]
    rows += awkward() + [(None, "wörter Wörter WÖRTER")]
    df = docs(spark, rows).withColumnsRenamed({"id": "word", "spans": "n"})
    words = spelling_variants.counted_words(df)
    want = plain_words(rows)
    assert {r.word: r.n for r in words.collect()} == want
    got = spelling_variants.grouped_variants(words)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_variants(want)
    assert any(r.form for r in got.collect())


def test_empty_table(spark):
    words = spelling_variants.counted_words(docs(spark, [(1, "")]).limit(0))
    assert spelling_variants.grouped_variants(words).collect() == []
    lonely = spark.createDataFrame([("hello", 3)], "word string, n long")
    assert [tuple(r) for r in spelling_variants.grouped_variants(lonely).collect()] == [("hello", None, "hello", 3, 0, None)]

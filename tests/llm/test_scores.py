"""Outliers, lattice scores, toxicity and language."""

import math
import random
import zlib
from collections import Counter
from types import SimpleNamespace

import public_tokenizers
import pyarrow as pa
from helpers import awkward, counts, docs, prose
from pyspark.sql import functions as F

from slicewright.llm import common, lattice_scoring, rank_profiles, robust_outliers, toxicity
from slicewright.llm.common import fold

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_base_counts_and_rejections(spark):
    rng = random.Random(1)
    rows = awkward() + [(None, "a b a b a b"), (60, "x\nx\n \ny\nx"), (61, "a b c a b c"), (62, "#*$ <b> | & %"), (63, None, None, None)]
    clean = [(1000 + i, prose(rng, rng.randrange(60, 400), 10**5)) for i in range(300)]
    odd = [(2000 + i, " ".join(w + "%%%" for w in prose(rng, 100, 10**5).split())) for i in range(9)]
    got = robust_outliers.judge(docs(spark, rows + clean + odd)).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(rows + clean + odd)
    for row in rows + clean + odd:
        if row[0] is not None:
            r, want = by_id[row[0]], counts(row[1])
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, row[0]
            assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
            assert not (r.base_failed and r.kept)
    assert all(by_id[d].kept for d, _ in clean) and not any(by_id[d].kept for d, _ in odd)
    assert robust_outliers.judge(docs(spark, [])).collect() == []


def test_small_sources_are_judged_by_their_whole_language(spark):
    rng = random.Random(2)
    text = lambda mark="": " ".join(w + mark for w in prose(rng, rng.randrange(80, 300), 10**5).split())
    rows = [(i, text(), "aa", "large") for i in range(150)] + [(i, text("#" * 3), "bb", "large") for i in range(200, 350)]
    rows += [(400, text("%%%"), "aa", "small"), (401, text(), "aa", "small"), (402, text("###"), "bb", "small"), (403, text(), "bb", "small")]
    rows += [(404, text("%" * 40), "cc", "alone"), (405, text(), "cc", "alone"), (406, text("%" * 40), None, None)]
    got = {r.doc_id: r.kept for r in robust_outliers.judge(docs(spark, rows)).collect()}
    assert [got[d] for d in (400, 401, 402, 403)] == [False, True, True, False]
    assert [got[d] for d in (404, 405, 406)] == [False, True, False]


def test_groups_of_moderate_size_have_their_own_estimate(spark):
    rng = random.Random(3)
    text = lambda mark="": " ".join(w + mark for w in prose(rng, rng.randrange(80, 300), 10**5).split())
    rows = [(i, text(), "aa", "plain") for i in range(300)] + [(i, text("###"), "aa", "marked") for i in range(300, 360)]
    got = {r.doc_id: r.kept for r in robust_outliers.judge(docs(spark, rows)).collect()}
    assert all(got[d] for d in range(300, 360))


def test_concentration_finds_the_narrow_share(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    good = rng.multivariate_normal([1, 2, 3, 4, 5], np.diag([1, 2, 1, 1, 1]) + 0.3, 800)
    bad = rng.normal(9, 0.5, (150, 5))
    rows = [("g", *map(float, x)) for x in np.vstack([good, bad])]
    df = spark.createDataFrame(rows, ["g", *robust_outliers.STATS]).cache()
    est = robust_outliers._start(df)
    for _ in range(robust_outliers.STEPS):
        est = robust_outliers._concentrated(robust_outliers._with_distance(df, est))
    far = np.array([r.d2 for r in robust_outliers._with_distance(df, est).select("d2").collect()]) / robust_outliers.CONSISTENCY
    r = est.first()
    assert np.allclose([r[f"m_{i}"] for i in range(5)], [1, 2, 3, 4, 5], atol=0.3)
    assert (far[800:] > robust_outliers.CUT).all() and (far[:800] > robust_outliers.CUT).mean() < 0.01


def test_a_groups_rows_are_not_dealt_to_one_task_and_estimates_take_few_files(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randrange(60, 200), 10**5), f"l{i % 6}", "s") for i in range(240)]
    real, kept = robust_outliers.saved, []

    def saved(df, label):
        by_group = df._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin [g")
        kept.append((label, by_group, out := real(df, label)))
        return out

    monkeypatch.setattr(robust_outliers, "saved", saved)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert robust_outliers.judge(docs(spark, rows)).count() == 240
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    estimates = [(by_group, out) for label, by_group, out in kept if label == "outlier-estimates"]
    assert len(estimates) == 1 + robust_outliers.STEPS
    assert all(out.count() == 6 and len(out.inputFiles()) == 1 for _, out in estimates)
    # the one join left in the first plan is of two tables with a row for each group
    assert estimates[0][0] <= 1


def spellings(word, weights, byte_weights):
    """Sum over all segmentations, written out."""
    if not word:
        return 1.0
    total = sum(w * spellings(word[len(p) :], weights, byte_weights) for p, w in weights.items() if word.startswith(p))
    if word[0] not in weights:
        total += math.prod(byte_weights[b] for b in word[0].encode()) * spellings(word[1:], weights, byte_weights)
    return total


def test_lattice_sums_all_segmentations():
    weights = {"a": 0.2, "b": 0.1, "ab": 0.15, "ba": 0.05, "aba": 0.1, "▁": 0.1, "▁a": 0.2}
    byte_weights = [0.001 + i * 1e-6 for i in range(256)]
    lattice = lattice_scoring.Lattice(weights, byte_weights)
    for word in ("▁", "▁abab", "▁aabbaba", "▁é", "▁aéb日a"):
        assert math.isclose(math.exp(lattice.score(word)), spellings(word, weights, byte_weights), rel_tol=1e-9)
    used = {}
    lattice.expect("▁abab", 2, used)
    assert math.isclose(sum(len(p) * n for p, n in used.items()), 2 * 5)  # every character is spelled once
    assert math.isfinite(lattice.score("▁" + "ab" * 20_000))


def test_base_score(spark):
    rows = awkward() + [(i, prose(random.Random(i), 30)) for i in range(100, 140)]
    learning = F.coalesce(fold(F.col("doc_id")) != 1, F.lit(True))
    got = lattice_scoring.score_documents(docs(spark, rows), MODEL, learning).collect()
    own = [(d, [*(t or "").encode().lower().split(), None]) for d, t in rows]
    train = Counter(w for d, ws in own if d is None or zlib.crc32(str(d).encode()) % 5 != 1 for w in ws)
    n, v = sum(train.values()), len(train)
    want = Counter()
    for d, ws in own:
        base = sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        want[d, len(ws), sum(train[w] > 0 for w in ws), n, round(base, 6)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert lattice_scoring.score_documents(docs(spark, []), MODEL, learning).collect() == []


def test_toxicity(spark):
    rng = random.Random(3)
    rows, marks = [], []
    for i in range(400):
        bad = i % 4 == 0
        words = prose(rng, 40).split()
        if bad:
            words[rng.randrange(40)] = rng.choice(["vileword", "VILEWORD!", "nastyman", "nastymen"])
        rows.append((i, " ".join(words)))
        marks.append((i, int(bad)))
    rows += [(900, None), (901, ""), (902, "you v1leword"), (None, "vileword")]
    marks += [(903, 1), (904, None), (None, 1), (0, 1), (0, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    got = toxicity.score(docs(spark, rows), labels, fold(F.col("doc_id")) != 0).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    held = [(r.score >= 0.5, r.doc_id % 4 == 0) for r in got if r.doc_id and r.doc_id < 400 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum(a == b for a, b in held) / len(held) > 0.97
    none = toxicity.score(docs(spark, rows), labels.limit(0), fold(F.col("doc_id")) != 0)
    assert {r.score for r in none.collect()} == {0.5}
    assert toxicity.score(docs(spark, []), labels, F.lit(True)).collect() == []


def test_toxicity_does_not_depend_on_the_order_of_rows(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, 60) + (" vile you scum" * rng.randrange(1, 4) if rng.random() < (0.9 if i % 3 == 0 else 0.1) else "")) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int")
    turned = docs(spark, rows[::-1]).repartition(7, F.xxhash64("text"))
    one, two = (
        {r.doc_id: r.score for r in toxicity.score(d, some, F.lit(True)).collect()}
        for d, some in ((docs(spark, rows).coalesce(1), labels), (turned, labels.repartition(5, F.hash("doc_id"))))
    )
    assert one == two and len(set(one.values())) > 2


def test_memories_of_a_worker_last_a_stage(monkeypatch):
    stage, forgotten = [None], []
    context = lambda: stage[0] is not None and SimpleNamespace(stageId=lambda: stage[0]) or None
    monkeypatch.setattr(common, "TaskContext", SimpleNamespace(get=context))
    monkeypatch.setattr(common, "_forgets", [lambda: forgotten.append(stage[0])])
    monkeypatch.setattr(common, "_stage", None)
    batch = pa.RecordBatch.from_arrays([pa.array(["a", None])], names=["text"])
    for stage[0] in (None, 3, 3, 4, None, 4, 6):
        assert list(common.small_slices([batch], "text")) == [batch]
    assert forgotten == [4, 6]


def test_lexicon_counts_all_labelled_rows(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, prose(rng, 30) + (" vileword" if i % 4 == 0 else "") + (" rareslur" if i in range(0, 320, 40) else "")) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    learned, real = [], toxicity.learn_lexicon
    monkeypatch.setattr(toxicity, "learn_lexicon", lambda known: learned.append(real(known)) or learned[-1])
    toxicity.score(docs(spark, rows), labels, F.lit(True), sample=40)
    want = Counter(s for i, t in rows if i % 4 == 0 for s in {s for w in set(t.split()) for s in toxicity.stems(w)})
    other = Counter(s for i, t in rows if i % 4 for s in {s for w in set(t.split()) for s in toxicity.stems(w)})
    odds = {s: (n / 100) / ((other[s] + 0.5) / 300) for s, n in want.items() if n >= toxicity.ROWS}
    odds = {s: math.log(o) for s, o in odds.items() if o >= toxicity.ODDS}
    assert learned[0].keys() == odds.keys() and "rareslur" in odds
    assert all(math.isclose(learned[0][s], o) for s, o in odds.items())


def test_language(spark):
    rng = random.Random(4)
    vowels = {"aa": "aeiou", "bb": "yäöüw", "cc": "кислот"}
    word = lambda lang: "".join(rng.choice("bdfgklm") + rng.choice(vowels[lang]) for _ in range(3))
    rows = [(i, " ".join(word(x) for _ in range(30)), x) for i, x in enumerate(["aa", "bb", "cc"] * 40)]
    odd = [(900, None, "aa"), (901, "12 !?", "bb"), (902, "", None), (903, "日" * 5, None), (None, word("aa"), "aa"), (904, "x" * 300_000, None)]
    df = docs(spark, rows + odd)
    profiles = rank_profiles.learn(df.where(fold(F.col("doc_id")) != 0))
    assert {r.lang for r in profiles.select("lang").distinct().collect()} == {"aa", "bb", "cc"}
    got = {r.doc_id: r for r in rank_profiles.predict(df, profiles).collect()}
    assert sum(got[d].lang_pred == x for d, _, x in rows) == len(rows)
    assert {got[d].lang_pred for d in (900, 901, 902)} == {"und"} and got[904].lang_pred in vowels
    assert all(0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in rank_profiles.predict(df, profiles.limit(0)).collect()} == {"und"}
    # counts and places against plain counting
    text = "Ab ab abc"
    want = Counter(g for w in (" ab ", " ab ", " abc ") for n in (1, 2, 3) for g in (w[i : i + n] for i in range(len(w) - n + 1)) if g.strip() and (n < 3 or g[1] != " "))
    codes, n = rank_profiles.grams(rank_profiles.Letters()(text))
    spell = lambda c: "".join(chr(c >> s & 0x1FFFFF) for s in (42, 21, 0) if c >> s & 0x1FFFFF)
    assert {spell(c): k for c, k in zip(codes.tolist(), n.tolist())} == dict(want)

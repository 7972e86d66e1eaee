"""The pipeline stage by stage, and the registered queries over the smallest tables."""

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from helpers import base_spans, counts, prose
from oracle import compare, duck
from pyspark.sql import functions as F
from test_decontamination import brute as leaks
from test_near_duplicates import brute as near

import __spark_entry__ as entry
import corpus_pipeline
from slicewright.llm.common import fold
from slicewright.llm.decontamination import WORD, shingles

SF_DIR = "/root/testdata/sf0.001"
#: Accuracy on held-out rows needs more of them.
LARGER = "/root/testdata/sf0.1"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, spans string"


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Documents with a known fate, in a folder like the test tables'."""
    rng = random.Random(1)
    items = [(i, prose(rng, 30, 5000)) for i in range(8)]
    texts = {i: prose(rng, 90, 5000) for i in range(300)}
    toxic = [i for i in texts if i % 5 == 0]
    for i in toxic:
        texts[i] += " you awfulword " + prose(rng, 5)
    for i in (1, 2, 3):
        texts[300 + i] = texts[i]
        texts[310 + i] = texts[i] + " end"
        texts[320 + i] = prose(rng, 40) + " " + items[i][1] + ". " + prose(rng, 40)
        texts[330 + i] = prose(rng, 40) + f" mail me{i}@example.com or 10.0.0.{i} " + prose(rng, 20)
    rows = [(i, t, "en", "s", len(t), "extra") for i, t in texts.items()]
    rows += [(400, None, None, None, None, None), (401, "", "en", "s", 0, None), (None, prose(rng, 60), "en", "s", 0, None)]
    folder = str(tmp_path_factory.mktemp("small"))
    marks = [(i, 1, int(i in toxic)) for i in texts]
    for name, data, schema in (
        ("documents", rows, COLUMNS),
        ("labels", marks, "doc_id long, quality int, toxic int"),
        ("benchmark", items, "item_id long, text string"),
    ):
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder, {r[0]: r[1] for r in rows}, set(toxic), items


def test_stages_do_what_they_say(spark, small):
    folder, texts, toxic, items = small
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()} if "text" in docs.columns else {}
        docs = stage(spark, docs, folder).cache()
        rows = docs.collect()
        assert len({r.doc_id for r in rows}) == len(rows)
        kept.append((before, {r.doc_id: r for r in rows}))
    (_, clean), (seen2, alone), (seen3, fair), (seen4, private), (seen5, coded) = kept
    assert set(texts) - set(clean) == toxic  # these and no others
    classes = near(list(seen2.items()))
    assert set(alone) == {d for d in seen2 if d is None or classes[d] == d}
    found = {d for d, _ in leaks(list(seen3.items()), items)}
    assert found == {321, 322, 323} and set(fair) == set(seen3) - found
    assert set(private) == set(seen4)
    for d, r in private.items():
        spans = base_spans(seen4[d])
        assert (r.text == seen4[d]) == (not spans)
        assert not base_spans(r.text) and r.n_chars == (None if r.text is None else len(r.text))
    assert {d for d, r in private.items() if r.text != seen4[d]} == {331, 332, 333}
    for d, r in coded.items():
        assert r.decoded == (seen5[d] or "")
        assert r.ids[:4] == b"\1\0\0\0" and r.ids[-4:] == b"\2\0\0\0"
    assert list(private.values())[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars", "spans"}
    again = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, folder).collect()}
    assert again == {d: r.ids for d, r in coded.items()}


def test_stages_on_empty_documents(spark, small):
    docs = spark.read.parquet(f"{small[0]}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small[0])
        assert docs.collect() == []


def test_rows_without_an_id_are_dropped_too(spark, small):
    folder, texts, _, items = small
    rng = random.Random(7)
    toxic, leak, fine = texts[0], prose(rng, 40) + " " + items[0][1] + ". " + prose(rng, 40), prose(rng, 60)
    rows = [(None, t, "en", "s", 0, None) for t in (toxic, leak, fine, None)]
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id IS NOT NULL").unionAll(spark.createDataFrame(rows, COLUMNS))
    left = lambda df: {r.text for r in df.where("doc_id IS NULL").collect()}
    assert left(corpus_pipeline.drop_toxic(spark, docs, folder)) == {leak, fine, None}
    assert left(corpus_pipeline.drop_contaminated(spark, docs, folder)) == {toxic, fine, None}


def test_rows_that_repeat_an_id_are_judged_one_by_one(spark, small):
    folder, texts, _, items = small
    rng = random.Random(8)
    toxic, leak = texts[0], prose(rng, 40) + " " + items[0][1] + ". " + prose(rng, 40)
    fine, other, base = (prose(rng, 60, 10**6) for _ in range(3))
    rows = [(900, t) for t in (toxic, leak, fine, other, fine)] + [(901, base + " more"), (901, fine), (902, base), (902, other), (903, None)]
    clash = "doc_id long, text string, lang string, source string, n_chars long, spans string, _key string, _again int, score double, _digest string"
    full = [(d, t, "en", "s", 0, None, f"k{i}", i, 2.0, "d") for i, (d, t) in enumerate(rows)]
    more = spark.createDataFrame(full, clash)
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 300").unionByName(more, allowMissingColumns=True)
    left = lambda df: sorted((r._again, r._key, r.score) for r in df.where("doc_id >= 900").collect())
    want = lambda *gone: [(i, f"k{i}", 2.0) for i in range(len(rows)) if i not in gone]
    assert left(corpus_pipeline.drop_toxic(spark, docs, folder)) == want(0)
    assert left(corpus_pipeline.drop_contaminated(spark, docs, folder)) == want(1)
    # the second ``fine`` of 900 and those of larger ids go, of ``base`` the smaller id stays; the toxic one copies document 0
    kept = left(corpus_pipeline.drop_near_duplicates(spark, docs, folder))
    assert [k for k in kept if k[0] not in (2, 4)] == want(0, 2, 4, 6, 7, 8)
    assert len([k for k in kept if k[0] in (2, 4)]) == 1
    assert corpus_pipeline.drop_near_duplicates(spark, docs, folder).columns == docs.columns


def test_every_operator_is_registered():
    names = list(entry.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", ["op5_suffix_dedup", "op9_super_kmers", "op11_mix", "op12_spelling", "op13_merkle"])
def test_against_sql(spark, name):
    assert compare(spark, duck(SF_DIR), SF_DIR, entry.queries()[name], entry.oracle_sql()[name]) is None


@pytest.fixture(scope="module")
def corpus():
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF_DIR}/documents.parquet'").fetchall()


def test_whole_tables(spark, corpus):
    run = lambda name: {r.doc_id: r for r in entry.queries()[name](spark, SF_DIR).collect()}
    one, two, six, eight, ten = (run(n) for n in ("op1_robust_outliers", "op2_pii", "op6_language", "op8_sentencepiece", "op10_near_duplicates"))
    from sentencepiece import SentencePieceProcessor

    lib = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    names = ["email", "ip", "card", "phone"]
    classes = near([(d, t) for d, t, _ in corpus])
    for d, text, lang in corpus:
        r = one[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(text)
        spans = base_spans(text)
        assert two[d].base_sha256 == sha(",".join(f"{names[k]}:{a}:{z}" for a, k, z in spans).encode())
        ids = lib.encode(text, add_bos=True, add_eos=True)
        assert (eight[d].n_tokens, eight[d].ids_sha256) == (len(ids), sha(np.array(ids, "<u4").tobytes()))
        assert eight[d].decoded_sha256 == sha(lib.decode(ids).encode())
        assert ten[d].class_id == classes[d]
    held = [six[d].lang_pred == lang for d, _, lang in corpus if six[d].held_out]
    assert sum(held) / len(held) > 0.95
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF_DIR}/benchmark.parquet'").fetchall()
    got = Counter((r.doc_id, r.item_id) for r in entry.queries()["op7_decontamination"](spark, SF_DIR).collect())
    parts = {x for _, i in items for x in shingles(WORD.findall(i.lower()))}
    suspects = [(d, t) for d, t, _ in corpus if parts & set(shingles(WORD.findall(t.lower())))]
    assert set(leaks(suspects, items)) == set(got) and max(got.values()) == 1


def test_held_out_toxicity(spark):
    got = entry.queries()["op4_toxicity"](spark, LARGER)
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    held = got.where("held_out").join(labels, "doc_id").select((F.col("predicted") == F.col("toxic")).cast("int").alias("ok"))
    assert held.agg(F.avg("ok")).first()[0] > 0.95
    assert got.where(F.col("held_out") != (fold(F.col("doc_id")) == 0)).isEmpty()

import random
import re

from helpers import base_spans, docs
from pyspark.sql import functions as F

from slicewright.llm import pii

PIECES = [
    "a@b.co", "x.y%z@mail-1.example.com.", "a@b.c@d.e", "@", "a@b", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1",
    "0001.02.3.255", "999999999999.1.1.1", "4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1112", "1 2 3", "12  34",
    "+1 (555) 123-4567", "+49 30 1234567890123456", "+1", "++12 345 678 901", "ü", "日本", "\n", " ", "(", "+", ".", "-", "0" * 25,
    "5500-0000-0000-0004 ", "word", "token = \"a8f0c1d2e3b4a5968778695a4b3c2d1e\"", "bob (at) example (dot) com",
    "call 555-123-4567 now", "ssn 123-45-6789",
]


def texts():
    rng = random.Random(1)
    return ["".join(rng.choice(PIECES) + rng.choice(["", " "]) for _ in range(rng.randrange(12))) for _ in range(600)]


def test_base_spans_are_the_plain_patterns(spark):
    rows = list(enumerate([*texts(), "", None, "a" * 100_000, "1." * 20_000, "9" * 50_000, "a@" + "b." * 20_000]))
    got = pii.find_spans(docs(spark, rows).select("doc_id", "text")).collect()
    assert len(got) == len(rows)
    want = {d: base_spans(t) for d, t in rows}
    for r in got:
        assert [tuple(s) for s in r.base] == want[r.doc_id], rows[r.doc_id]
        assert {tuple(s) for s in r.base} <= {tuple(s) for s in r.spans}


def test_weak_supervision_adds_what_labelers_agree_on(spark):
    rng = random.Random(2)
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    rows = [(i, f'some words here token = "{key()}" and more') for i in range(60)]
    rows += [(100 + i, f"page chapter-one-of-the-book-{i % 10} from 1990 2001 and nothing else") for i in range(60)]
    got = {r.doc_id: r.spans for r in pii.find_spans(docs(spark, rows).select("doc_id", "text")).collect()}
    for d, text in rows[:60]:
        at = re.search("[0-9a-f]{40}", text)
        assert (at.start(), pii.KINDS.index("secret"), at.end()) in [tuple(s) for s in got[d]]
    assert all(got[d] == [] for d, _ in rows[60:])


def test_reliabilities_follow_the_better_labelers():
    patterns = [((1, 0, 1, 1, 1), 500), ((-1, 0, -1, -1, 1), 400), ((1, 0, 1, 1, -1), 50), ((-1, 0, -1, -1, -1), 500)]
    truth = pii.reliabilities(patterns)
    assert truth[1, 0, 1, 1, -1] > 0.9 and truth[-1, 0, -1, -1, 1] < 0.1


def test_redaction_and_empty_table(spark):
    rows = docs(spark, [(1, "é mail a@b.co, ip 1.2.3.4"), (2, None), (3, "clean")]).select("doc_id", "text")
    out = pii.find_spans(rows).withColumn("clean", pii.redacted("text", "spans"))
    assert {r.doc_id: r.clean for r in out.collect()} == {1: "é mail [email], ip [ip]", 2: None, 3: "clean"}
    overlap = spark.sql("SELECT 'abcdefgh' AS t, array(named_struct('start',1,'kind',0,'end',4), named_struct('start',2,'kind',1,'end',6)) AS s")
    assert overlap.select(pii.redacted("t", "s").alias("r")).first().r == "a[email]gh"
    assert pii.find_spans(rows.limit(0)).collect() == []
    assert rows.select(pii.count_of("ip", F.array().cast("array<struct<start:int,kind:int,end:int>>")).alias("n")).first().n == 0

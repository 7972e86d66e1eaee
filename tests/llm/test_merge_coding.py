import random

import numpy as np
import public_tokenizers
import pytest
from helpers import awkward, docs
from hypothesis import given, settings
from hypothesis import strategies as st

from slicewright.llm.merge_coding import LONG, MergeCoder, encode_decode

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def coder():
    return MergeCoder(MODEL)


def check(coder, texts):
    ids, decoded = coder.encode_batch(texts)
    want = coder.library.encode(texts, add_bos=True, add_eos=True)
    assert [np.frombuffer(i, "<u4").tolist() for i in ids] == want
    assert decoded == [coder.library.decode(i) for i in want]


def test_like_the_library(coder):
    rng = random.Random(3)
    letters = " ▁ ab\n\t  thé 日😀e<s>0x4"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(2000)]
    check(coder, texts + ["", " ", "   ", "▁", "<s></s>", "a" * (LONG * 40), " the" * 3000, "\0"])


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=80))
def test_any_text(coder, text):
    check(coder, [text])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31_999)), max_size=12))
def test_any_ids(coder, ids):
    assert coder.decode(ids) == coder.library.decode(ids)


def test_short_and_long_agendas_agree(coder):
    rng = random.Random(5)
    for _ in range(300):
        text = "▁" + "".join(rng.choice("thersionab") for _ in range(rng.randrange(1, 30)))
        assert coder._merge_short(text) == coder._merge_long(text)


def test_a_difference_fails(coder, monkeypatch):
    own = MergeCoder(MODEL)
    monkeypatch.setattr(own, "merge", lambda text: [5])
    with pytest.raises(AssertionError, match="differ"):
        own.encode_batch(["hello world"])


def test_forgetting_changes_nothing(coder, monkeypatch):
    monkeypatch.setattr("slicewright.llm.merge_coding.MEMORY", 10)
    own = MergeCoder(MODEL)
    for _ in range(3):
        check(own, ["one two three four five six seven", "seven eight nine ten eleven twelve thirteen"])


def test_operator(spark):
    rows = awkward()
    got = encode_decode(docs(spark, rows), MODEL).collect()
    assert sorted((r.doc_id, r.decoded) for r in got if r.doc_id) == sorted((d, t or "") for d, t in rows if d)
    assert encode_decode(docs(spark, []), MODEL).collect() == []

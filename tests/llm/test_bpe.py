"""BPE coding against the tokenizers library on whole texts."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from segmetrics.llm.bpe import Codec, encode_decode
from segmetrics.llm.queries import QUERIES, TOKENIZER

SMALL = "/root/testdata/sf0.001"
ODD = ["", " ", "  a  b ", "x\n\nA\n \n b", "!'s #'ll ''re a's", "é à  ü", " é　x", "<|endoftext|> a<|endoftext|>b", "a" * 5000,
       "日本語 text 🙂🙂 !?", "tab\tend\r\n\r\n", "0123456789" * 30, "\x00\x01 \x7f", "i'm I'VE '", "x\x85\x85y", "naïve café l'été"]


@pytest.fixture(scope="module")
def codec():
    return Codec(open(TOKENIZER, encoding="utf-8").read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


def same(codec, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    packed = codec.encode(text)
    assert np.frombuffer(packed, "<u4").tolist() == ids, text[:200]
    assert codec.decode(packed) == library.decode(ids, skip_special_tokens=False)


def test_odd_texts(codec, library):
    for t in ODD:
        same(codec, library, t)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'’sltvedmré!#-.,0a1 　AZß"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text(codec, library, text):
    same(codec, library, text)


def test_cache_starts_anew(library, monkeypatch):
    import segmetrics.llm.bpe as m

    monkeypatch.setattr(m, "CACHE_ENTRIES", 5)
    c = m.Codec(open(TOKENIZER, encoding="utf-8").read())
    for _ in range(3):
        same(c, library, "one two three four five six seven eight nine ten")


def test_query_whole_table(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for r in docs:
        e = library.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id] = (len(e), hashlib.sha256(np.asarray(e, "<u4").tobytes()).hexdigest(),
                          hashlib.sha256(library.decode(e, skip_special_tokens=False).encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op3_bpe"](spark, SMALL).collect()}
    assert got == want


def test_nulls_repeats_extra_columns_empty_table(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, "", "y"), (2, "a b", None), (2, "a b", None)], "doc_id long, text string, ids string")
    rows = encode_decode(df, TOKENIZER).collect()
    assert sorted((r.doc_id or 0, len(r.ids), r.decoded) for r in rows) == [(0, 0, ""), (1, 0, ""), (2, 8, "a b"), (2, 8, "a b")]
    assert encode_decode(df.limit(0), TOKENIZER).count() == 0

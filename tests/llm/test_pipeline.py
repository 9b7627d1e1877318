"""The pipeline's stages against plain Python, each on what its predecessor kept."""

import hashlib
import re

import numpy as np
from test_dedup_join import brute_components, brute_hits, brute_lines
from tokenizers import Tokenizer

import corpus_pipeline as P
from segmetrics.llm.queries import TOKENIZER

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "near_duplicates", "decontamination", "bpe"]
    library = Tokenizer.from_file(TOKENIZER)
    for i, (_, stage) in enumerate(P.STAGES):
        docs = P.stored(stage(spark, docs, SMALL))
        if i == 0:
            rows = [(d, t) for d, t in rows if re.search(r"[^\W\d_]", t or "")]
        elif i == 1:
            rows = sorted((d, t) for d, t, *_ in brute_lines(rows))
        elif i == 2:
            rows = [(d, t) for (d, t), (e, _, c) in zip(rows, brute_components(rows)) if c == e]
        elif i == 3:
            bad = {d for d, *_, c in brute_hits(rows, bench) if c}
            rows = [(d, t) for d, t in rows if d not in bad]
        if i < 4:
            assert docs.columns == P.COLUMNS
            assert sorted((r.doc_id, r.text) for r in docs.collect()) == rows
    ids = {d: np.asarray(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for d, t in rows}
    got = {r.doc_id: r for r in docs.collect()}
    assert {d: (bytes(r.ids), r.n_tokens, r.ids_sha256, r.decoded_sha256) for d, r in got.items()} == {
        d: (x, len(x) // 4, hashlib.sha256(x).hexdigest(), hashlib.sha256(dict(rows)[d].encode()).hexdigest()) for d, x in ids.items()}
    assert 0 < len(got) < 200


def test_odd_rows(spark, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "123 456", "en", "s", 7), (4, "the cat and the dog " * 9000, "en", "s", 1),
            (5, "one small text of the day", "en", None, 2), (5, "one small text of the day", "en", None, 2), (None, "no id for this one here", None, "s", 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, extra string, ids string"
    base = str(tmp_path)
    spark.createDataFrame([(*r, "x", "y") for r in rows], schema).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(1, None), (2, "!!")], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    assert sorted(r.doc_id or 0 for r in P.run(spark, base).collect()) == [0, 4, 5]
    other = str(tmp_path / "none")
    spark.createDataFrame([], schema).write.parquet(f"{other}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{other}/benchmark.parquet")
    assert P.run(spark, other).count() == 0


def test_repeated_ids_lose_only_copies(spark):
    """An id that stands for a copy of document 1 and for a text of its own; equal rows; two near copies under one id."""
    one, own, other = ("the cat and the dog went to the river on a sunny day of may " * 2 + x for x in ("a b", "c d", "e f"))
    own = "a text of its own that nobody else in this table has written down before " + own[-3:]
    near = " ".join(f"w{i}" for i in range(60))
    rows = [(1, one), (5, one), (5, own), (8, "equal rows of one id that stand in the table twice"), (8, "equal rows of one id that stand in the table twice"),
            (9, near), (9, near + " more"), (None, one), (None, "no id but a text that is its own here"), (-3, other + " far apart"), (11, None), (12, "")]
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id, r.text) for r in P.near_duplicates(spark, df, "").collect()), key=str)
    kept9 = [t for i, t in got if i == 9]
    assert len(kept9) == 1 and kept9[0] in (near, near + " more")
    linked = {d: c for d, _, c in brute_components([(-3, other + " far apart"), (1, one)])}
    want = [(5, own), (8, rows[3][1]), (None, rows[8][1]), (-3, other + " far apart"), (11, None), (12, "")] + ([(1, one)] if linked[1] == 1 else [])
    assert sorted(((i, t) for i, t in got if i != 9), key=str) == sorted(want, key=str)


def test_texts_without_a_language_go(spark):
    """The network has its say: a long text whose bytes look like no language is rejected; clean and short texts stay."""
    import random
    g = random.Random(2)
    words = {"aa": ["alba", "sol", "mar"], "bb": ["xyk", "qwz", "jvv"], "cc": ["öäü", "ßñé", "çøå"]}
    rows = [(i, " ".join(g.choices(words[x], k=60)), x) for i, x in enumerate(["aa", "bb", "cc"] * 40)]
    rows += [(1000, "12 34", "aa"), (1001, None, "aa")]
    df = spark.createDataFrame([(i, t, x, "s", 1) for i, t, x in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in P.language_id(spark, df, "").collect()}
    assert kept == set(range(120))
    many = [(i, " ".join(g.choices([f"{chr(97 + k)}{chr(98 + k)}{chr(97 + k)}"], k=40)), f"l{k}") for i, k in ((i, i % 24) for i in range(240))]
    mixed = " ".join(f"{chr(97 + k)}{chr(98 + k)}{chr(97 + k)}" for k in range(24) for _ in range(4))      # a bit of each language
    df = spark.createDataFrame([(i, t, x, "s", 1) for i, t, x in many] + [(900, mixed, None, "s", 1), (901, mixed[:40], None, "s", 1)], df.schema)
    kept = {r.doc_id for r in P.language_id(spark, df, "").collect()}
    assert 900 not in kept and 901 in kept and len(kept) >= 236

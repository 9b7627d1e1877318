"""Spelling variants against brute force: index, searches, whole table, chains, odd rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from segmetrics.llm import spelling as S
from segmetrics.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def edits(w, letters):
    cuts = [(w[:i], w[i:]) for i in range(len(w) + 1)]
    return ({a + b[1:] for a, b in cuts if b} | {a + c + b[1:] for a, b in cuts if b for c in letters} | {a + c + b for a, b in cuts for c in letters}) - {w}


def brute(rows, least_n=5, drop=199):
    """rows: (id, text); {word: (form, root, n, n_near, form_n)}."""
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            if h % drop == 0:
                low = low[:h % len(low)] + low[h % len(low) + 1:]
            counts[low] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 6 and k >= least_n}
    letters = {c for w in n for c in w}
    near = {w: [x for x in edits(w, letters) if x in n] for w in n}
    best = {w: min(xs, key=lambda x: (-n[x], x)) for w, xs in near.items() if xs}
    form = {w: b for w, b in best.items() if n[b] >= 5 * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w
    return {w: (form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n}


def rows_of(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abé", min_size=1, max_size=9), min_size=1, max_size=40, unique=True))
def test_searches_find_each_near_pair_once(words):
    ask, near = S.near_words(words, words + words, np.repeat([0, 1], len(words)))
    got = Counter((words[i % len(words)], words[j]) for i, j in zip(ask, near))
    assert got == Counter({(w, x): 1 for w in words for x in edits(w, "abé") if x in set(words)})


def test_index_counts_and_intervals():
    g = np.random.default_rng(2)
    text = np.append(g.integers(1, 6, 700), S.END)
    f, r = S.Index(text, 6), S.Index(np.append(text[:-1][::-1], S.END), 6)
    assert [tuple(text[i:]) for i in f.suffix] == sorted(tuple(text[i:]) for i in range(len(text)))
    c, i = g.integers(0, 6, 300), g.integers(0, 702, 300)
    assert list(f.ranks(c, i)) == [(f.last[:k] == x).sum() for x, k in zip(c, i)] and list(f.smaller(c, i)) == [(f.last[:k] < x).sum() for x, k in zip(c, i)]
    one = lambda x: np.array([x])
    lo, rlo, size = one(0), one(0), one(701)
    pattern = []
    for right, x in [(0, text[50]), (1, text[51]), (0, text[49]), (1, text[52])]:
        pattern = [*pattern, x] if right else [x, *pattern]
        if right:
            lo = lo + S.shift(r, one(x), rlo, size)
            rlo, size = S.extend(r, one(x), rlo, size)
        else:
            rlo = rlo + S.shift(f, one(x), lo, size)
            lo, size = S.extend(f, one(x), lo, size)
        hits = [k for k in range(701) if list(text[k:k + len(pattern)]) == pattern]
        assert sorted(f.suffix[lo[0]:lo[0] + size[0]]) == hits
        assert sorted(700 - len(pattern) - k for k in r.suffix[rlo[0]:rlo[0] + size[0]]) == hits


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = brute(rows)
    got = rows_of(QUERIES["op13_spelling_variants"](spark, SMALL))
    assert got == want and sum(x[3] for x in want.values()) > 100


def test_crowded_halves_and_chains(spark):
    g = random.Random(4)
    words = {"abcabc" + "".join(g.choice("xyz") for _ in range(g.randint(0, 4))) for _ in range(120)}
    words |= {"".join(g.choice("xyz") for _ in range(4)) + "cbacba" for _ in range(60)}
    rows = [(i, " ".join(g.choices(sorted(words), k=200))) for i in range(15)]
    chain = ["wintermorgen", "wintermorgan", "wintermorgaan", "wintermorgaans", "wantermorgaans"]
    rows += [(100 + k, f"{w.capitalize()}, " * 5 ** (k + 1)) for k, w in enumerate(chain)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert want["wintermorgen"][1] == "wantermorgaans"
    for symbols in (150, 3000, S.SYMBOLS):                           # many blocks of one half; a few; one shard
        assert rows_of(S.group_variants(df, symbols=symbols)) == want


def test_odd_rows(spark):
    long = "x" * 3000
    rows = [(1, None), (2, ""), (3, "12 34 !"), (None, "Straßen straßen STRAßEN straßen straßen"), (4, "ÉCOLES " * 7 + "écoles " * 7), (5, f"{long} " * 6 + f"{long}y " * 40),
            (6, "twice seen words " * 9), (6, "twice seen words " * 9), (7, "×÷×÷×÷ " * 5 + "naïvely_naïvely " * 9)]
    df = spark.createDataFrame([(i, t, "a", 3) for i, t in rows], "doc_id long, text string, word string, n int")
    want = brute(rows)
    assert rows_of(S.group_variants(df)) == want and want[long][1] == long + "y"
    assert S.group_variants(df.limit(0)).count() == 0
    assert S.group_variants(df.filter("doc_id = 3")).count() == 0

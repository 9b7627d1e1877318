"""Quality rules: statistics against plain Python, covering on made-up labels, the list on the given table."""

import random
import re
from collections import Counter

import pytest

from segmetrics.llm import quality as Q
from segmetrics.llm.queries import QUERIES

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            inside |= set(range(i, i + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), n < 20 or 100 * len(inside) > 30 * n)


def base(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_whole_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    got = QUERIES["op12_quality_rules"](spark, MIDDLE).collect()
    assert {r.doc_id: base(r) for r in got} == {d: brute(t) for d, t in docs.items()}
    assert all(r.kept == (not r.base_failed and r.rule is None) for r in got)
    good = [r for r in got if labels.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r for r in got if labels.get(r.doc_id) == 0 and not r.base_failed]
    assert sum(r.kept for r in good) >= 0.99 * len(good) and sum(not r.kept for r in bad) >= 0.8 * len(bad)


@pytest.fixture(scope="module")
def texts(spark):
    g = random.Random(8)
    rows = []
    for i in range(900):
        words = [g.choice("abcdefgh") * g.randint(2, 7) + g.choice("xyz") * g.randint(1, 4) for _ in range(g.randint(25, 60))]
        kind = g.choice(["plain"] * 4 + ["marks", "upper"])
        if kind == "marks":
            words = [w + "!?" for w in words]
        elif kind == "upper":
            words = [w.upper() for w in words]
        rows.append((i, " ".join(words), kind))
    return rows


def test_rules_are_learned_and_hold_on_other_rows(spark, texts):
    labels = spark.createDataFrame([(i, int(k == "plain")) for i, _, k in texts[:600]] + [(None, 0), (3, None), (99999, 0)], "doc_id long, quality int")
    docs = spark.createDataFrame([(i, t) for i, t, _ in texts], "doc_id long, text string")
    rules = Q.fit(docs, labels)
    assert 2 <= len(rules) <= 4 and all(r.bad >= Q.PRECISION * (r.bad + r.good) for r in rules)
    kind = {i: k for i, _, k in texts}
    for r in Q.judge(docs.filter("doc_id >= 600"), rules).collect():
        assert r.kept == (kind[r.doc_id] == "plain") and (r.rule is None) == r.kept
    assert Q.fit(docs, labels.limit(0)) == [] == Q.fit(docs.limit(0), labels)
    assert Q.fit(docs, labels.filter("quality = 1")) == []


def test_noise_makes_no_rule(spark, texts):
    g = random.Random(1)
    labels = spark.createDataFrame([(i, g.randint(0, 1)) for i, _, _ in texts], "doc_id long, quality int")
    docs = spark.createDataFrame([(i, t) for i, t, _ in texts], "doc_id long, text string")
    assert Q.fit(docs, labels) == []


def test_a_conjunction_is_grown_and_an_idle_condition_pruned(spark):
    g = random.Random(3)
    rows = [(i, g.random(), g.random(), g.random()) for i in range(3000)]
    bad = lambda r: r[1] >= 0.5 and r[2] < 0.4
    df = spark.createDataFrame([(bad(r), *r[1:]) for r in rows], "bad boolean, mean_word double, upper_share double, short_share double")
    df = df.selectExpr("bad", "named_struct('mean_word', mean_word, 'upper_share', upper_share, 'short_share', short_share) f")
    cuts = {n: [k / 20 for k in range(1, 20)] for n in ("mean_word", "upper_share", "short_share")}
    bins = ", ".join(f"named_struct('name', '{n}', 'bin', cast(floor(f.{n} * 20 + 1e-9) as int))" for n in cuts)
    df = df.selectExpr("*", f"array({bins}) bins")
    grown = Q._grow(df, cuts)
    assert set(grown.conditions) == {("mean_word", True, 0.5), ("upper_share", False, 0.4)}
    idle = Q.Rule((*grown.conditions, ("short_share", True, 0.3)))
    assert Q._prune(df, idle).conditions == grown.conditions
    assert Q._prune(df, Q.Rule((("short_share", True, 0.3),))) is None


def test_odd_rows(spark):
    texts = [None, "", " \n\t ", "one", "a b c d e f g h " * 2, "a b c d e f g h a b c d e f g h x" * 3, "same line\nsame line\n\n\nother\nsame line ", "  #   |x| <b>",
             " ".join(["w"] * 40), "x y z " * 30_000, "Ünï cödé " * 9 + "\x0b\x0c\r end", " ".join(f"w{i % 50}" for i in range(103))]
    df = spark.createDataFrame([(i, t, 1, "x", 2.0) for i, t in enumerate([*texts, texts[4]])], "doc_id long, text string, stats int, rule string, words double")
    rules = [Q.Rule((("marks_per_word", True, 0.5),))]
    got = {r.doc_id: r for r in Q.judge(df, rules).select("doc_id", "stats.*", "base_failed", "rule", "kept").collect()}
    assert {i: base(r) for i, r in got.items()} == {i: brute(t) for i, t in enumerate([*texts, texts[4]])}
    assert not any(r.kept for r in got.values() if r.base_failed)
    assert Q.judge(df.limit(0), rules).count() == 0

"""Line dedup, n-gram join and decontamination against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from segmetrics.llm import decontaminate, line_dedup, ngram_join
from segmetrics.llm.decontaminate import Automaton, find_contamination
from segmetrics.llm.line_dedup import PerfectHash, dedup_lines
from segmetrics.llm.ngram_join import components_of_block, link_documents
from segmetrics.llm.queries import QUERIES

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts(spark, sf=SMALL, name="documents", key="doc_id"):
    return [(r[key], r.text) for r in spark.read.parquet(f"{sf}/{name}.parquet").collect()]


# line dedup -----------------------------------------------------------------

def brute_lines(rows, min_chars=20, min_docs=3):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(AZ)
    docs = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                docs.setdefault(key(line), set()).add(-1 if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(docs.get(key(x), ())) < min_docs or max(docs[key(x)]) == (-1 if i is None else i)]
        out.append((i, "\n".join(keep), len(lines), len(lines) - len(keep)))
    return sorted(out, key=str)


LONG = "the very same long line of text"
ODD_LINES = [(1, None), (2, ""), (3, f"{LONG}\nx"), (4, f"  {LONG.upper()}\t\nother"), (5, f"a\n{LONG}\n{LONG}\nb"), (6, "short\n" * 3), (7, "\n\n"),
             (None, LONG), (5, f"{LONG} again"), (5, f"a\n{LONG}"), (8, "é" * 19 + "\n" + "é" * 20), (9, "é" * 19 + "\n" + "é" * 20),
             (10, "é" * 20 + "\n" + "é" * 19), (11, "long long text " * 5000)]


@pytest.mark.parametrize("probe_bytes", [1 << 20, 0])
def test_lines_odd(spark, probe_bytes):
    df = spark.createDataFrame([(i, t, "n", 7) for i, t in ODD_LINES], "doc_id long, text string, k string, n_lines int")
    got = dedup_lines(df, probe_bytes=probe_bytes, keep=["k"]).collect()
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got), key=str) == brute_lines(ODD_LINES)
    assert {r.k for r in got} == {"n"}
    assert dedup_lines(df.limit(0), probe_bytes=probe_bytes).count() == 0


@pytest.mark.parametrize("probe_bytes", [1 << 20, 0])
def test_lines_whole_table(spark, probe_bytes, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 7)
    rows = texts(spark)
    got = dedup_lines(spark.read.parquet(f"{SMALL}/documents.parquet"), probe_bytes=probe_bytes).collect()
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got), key=str) == brute_lines(rows)


def test_perfect_hash_is_minimal_and_perfect():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**64, 5000, dtype=np.uint64))
    h = PerfectHash.build(keys)
    assert sorted(h.index(keys).tolist()) == list(range(len(keys)))


# n-gram join ----------------------------------------------------------------

def shingles(t, size=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(AZ))
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def brute_components(rows, size=5):
    sets = [shingles(t, size) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    held = {}
    for i, s in enumerate(sets):
        for g in s:
            held.setdefault(g, []).append(i)
    near = {(a, b) for v in held.values() for k, a in enumerate(v) for b in v[k + 1:]} if len(rows) < 300 else {
        (a, b) for i, s in enumerate(sets) for g in s for a, b in [(held[g][0], i)] + [(x, i) for x in held[g] if x < i] if a < b}
    for a, b in near:
        n = len(sets[a] & sets[b])
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            up[top(a)] = top(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), d), d)
    return sorted((d, len(sets[i]), least[top(i)]) for i, (d, _) in enumerate(rows))


def linked(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in link_documents(df).collect())


def test_join_whole_table(spark):
    for sf in (SMALL, MIDDLE):
        rows = texts(spark, sf)
        got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in QUERIES["op1_ngram_join"](spark, sf).collect())
        assert got == brute_components(rows)
        assert any(d != c for d, _, c in got)


def near_copies(seed, groups, copies, words, edits):
    g = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    out, common = [], [g.choice(vocab) for _ in range(60)]
    for _ in range(groups):
        base = [g.choice(vocab) for _ in range(words)]
        for _ in range(copies):
            w = list(base)
            for _ in range(g.randint(0, edits)):
                w[g.randrange(len(w))] = g.choice(vocab)
            if g.random() < 0.4:
                w = w + common
            out.append(" ".join(w))
    g.shuffle(out)
    return [(i, t) for i, t in enumerate(out)]


@pytest.mark.parametrize("sizes", [(300, 64, 4 << 20), (4, 3, 2000)])
def test_join_near_copies(spark, monkeypatch, sizes):
    """Chains, groups of near copies and a common passage, with blocks, hot n-grams and chunks made small as well."""
    for name, v in zip(("BLOCK", "LOCAL_HOT", "CHUNK_BYTES"), sizes):
        monkeypatch.setattr(ngram_join, name, v)
    rows = near_copies(3, 12, 14, 70, 5)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert linked(df) == brute_components(rows)


def test_join_odd(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A  b"), (6, "a b c d e"), (7, "a b c d e"), (8, "a b c d e f"), (9, "x" * 50_000),
            (10, "one two three four five six seven eight nine ten " * 2000), (11, "one two three four five six seven eight nine ten " * 1500),
            (12, " "), (13, " "), (7, "a b c d e")]
    df = spark.createDataFrame([(i, t, i, "x") for i, t in rows], "doc_id long, text string, node long, n string")
    assert linked(df) == brute_components(rows)
    assert link_documents(df.limit(0)).count() == 0
    assert {r.component_id for r in link_documents(df.filter("doc_id < 4")).collect()} == {1, 2, 3}


def test_block_components():
    g = np.random.default_rng(2)
    base = g.integers(0, 2**63, 100, dtype=np.uint64)
    sets = [np.unique(np.concatenate((base[:100 - k], g.integers(0, 2**63, k, dtype=np.uint64)))) for k in (0, 5, 40, 8, 60)]
    from fractions import Fraction

    assert components_of_block(sets, np.array([len(s) for s in sets]), Fraction(4, 5)).tolist() == [0, 0, 2, 0, 4]


# decontamination --------------------------------------------------------------

def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(AZ))


def brute_hits(rows, items, window=13):
    wins = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - window + 1)) if w else ():
            wins.setdefault(tuple(w[k:k + window]), set()).add(str(i) if i is not None else "")
    lengths = {len(w) for w in wins}
    out = []
    for d, t in rows:
        w, hit, who = words(t), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if (g := tuple(w[k:k + n])) in wins:
                    hit.update(range(k, k + n))
                    who |= wins[g]
        out.append((d, len(w), len(hit), sorted(who), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def found(df, bench):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.items, r.contaminated) for r in find_contamination(df, bench).collect()), key=str)


def test_hits_whole_table(spark):
    for sf in (SMALL, MIDDLE):
        items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
        want = brute_hits(texts(spark, sf), items)
        got = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in QUERIES["op9_decontaminate"](spark, sf).collect()), key=str)
        assert got == sorted([(d, n, h, len(w), hashlib.sha256(",".join(w).encode()).hexdigest(), c) for d, n, h, w, c in want], key=str)
        assert any(c for *_, c in want)


def random_case(seed, short):
    g = random.Random(seed)
    w = lambda n: " ".join(g.choice("abcde") + g.choice(["", "", "1"]) for _ in range(n))
    items = [(i, w(g.choice([15, 20, 30] + ([2, 3, 5, 12, 13] if short else [])))) for i in range(12)]
    rows = []
    for d in range(60):
        t = w(g.randint(0, 60))
        for _ in range(g.randint(0, 3)):
            i = words(g.choice(items)[1])
            a = g.randrange(len(i))
            t += " " + " ".join(i[a:a + g.randint(1, 30)]).upper() + "; " + w(g.randint(0, 20))
        rows.append((d, t))
    return rows, items


@pytest.mark.parametrize("seed,short,shard", [(1, False, 10**6), (2, True, 10**6), (3, True, 40)])
def test_hits_random(spark, monkeypatch, seed, short, shard):
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard)
    monkeypatch.setattr(decontaminate, "PASS_WORDS", 2 * shard)
    monkeypatch.setattr(decontaminate, "CHUNK", 500)
    rows, items = random_case(seed, short)
    assert found(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")) == brute_hits(rows, items)


def test_automaton_longest_match():
    g = random.Random(5)
    for _ in range(50):
        items = [(str(i), [g.choice("abc").encode() for _ in range(g.randint(1, 14))]) for i in range(5)]
        a = Automaton(items, 4)
        t = [g.choice("abcd").encode() for _ in range(40)]
        subs = {tuple(w[i:j]) for _, w in items for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
        assert a.walk(t)[2] == max([0, *(j - i for i in range(40) for j in range(i + 1, min(40, i + 15) + 1) if tuple(t[i:j]) in subs)])


def test_hits_odd(spark):
    rows = [(1, None), (2, ""), (3, "one two"), (None, "Two"), (4, "x " * 30 + "two" + " x" * 19), (4, "x two"), (5, "!!"), (6, "é two é" * 3)]
    items = [(1, None), (2, "!"), (None, "TWO"), (3, "two"), (3, "two")]
    df, bench = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, spans int"), spark.createDataFrame(items, "item_id long, text string")
    assert found(df, bench) == brute_hits(rows, items)
    assert found(df, bench.limit(0)) == brute_hits(rows, []) and found(df.limit(0), bench) == []
    clean = {r.doc_id: r.clean for r in find_contamination(df.filter("doc_id in (3, 5)"), bench).collect()}
    assert clean == {3: "one ", 5: None}


def test_a_text_with_more_than_65535_ngrams_in_a_shard(spark):
    from fractions import Fraction

    from segmetrics.llm.ngram_join import _counted, _nodes, _sent

    words = " ".join(f"w{i}" for i in range(150_000))
    rows = spark.createDataFrame([(bytearray((words + f" end{i}").encode()),) for i in range(2)], "text binary").coalesce(1)
    nodes = _nodes(_counted(_sent(rows, 5, 1), 1), 1, Fraction(4, 5)).collect()
    assert sorted((r.n, r.u, len(r.grams) // 8) for r in nodes) == [(149_997, 1, 149_996)] * 2

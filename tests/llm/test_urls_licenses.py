"""URL filters and license scans against plain Python."""

import re

from segmetrics.llm.licenses import BASE_PHRASES, GATES, Signature, scan_licenses, signatures
from segmetrics.llm.queries import QUERIES
from segmetrics.llm.urls import BASE_RULES, PATTERNS, Pattern, filter_urls

SMALL = "/root/testdata/sf0.001"
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def judge(url, rules=BASE_RULES, patterns=PATTERNS):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group().translate(AZ)
        path = re.match(r"[^?#]*", re.sub(r"^[^/?#]*", "", rest)).group()
    fits = [(len(r), r, a) for a, r in rules
            for h, p in [(r[:r.index("/")], r[r.index("/"):])] if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    hit = next((p for p in patterns if re.search(p.regex, (url or "").translate(AZ))), None)
    return host, path, None, hit.action if hit else "allow"


def test_query_whole_table(spark):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in QUERIES["op2_url_filters"](spark, SMALL).collect()}
    assert got == {k: judge(u) for k, u in urls.items()}


def test_odd_urls(spark):
    urls = [None, "", "no scheme com/", "http://", "HTTP://EXAMPLE.COM/en/x", "http://WWW.Example.com/en/", "http://xexample.com/en/",
            "http://a.net/es/", "http://net/es/1", "http://a.net/ES/", "http://a.net?x=/es/", "http://a.com", "http://a.com/", "a://b://c.com/",
            "http://a.org/login", "http://a.org/x/login/?q", "http://a.org/xlogin", "http://a.org/?SessionId=3", "http://a.org/calendar/2020/1/2",
            "http://ads1.x.org/", "http://a.org/feed/", "http://com/", "http://a.com:80/en/", "http://a.net/fr/?share=1"] * 2
    df = spark.createDataFrame([(i, u, i) for i, u in enumerate(urls)], "page_id long, url string, host long")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in filter_urls(df).collect()}
    assert got == {i: judge(u) for i, u in enumerate(urls)}
    assert filter_urls(df.limit(0)).count() == 0
    only = [Pattern("x", "block", "zz", ["zz"])]
    assert {r.verdict for r in filter_urls(df, [], only).collect()} == {"allow"}
    assert {r.verdict for r in filter_urls(df, [], []).collect()} == {"allow"}


def phrases(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(AZ))
    at = [(i, label) for p, label in BASE_PHRASES for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    return (len(words), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({x for _, x in at})))


def test_license_query_whole_table(spark):
    for sf in (SMALL, "/root/testdata/sf0.01"):
        texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
        rows = QUERIES["op5_licenses"](spark, sf).collect()
        assert {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows} == {k: phrases(t) for k, t in texts.items()}
        assert any(r.n_base for r in rows)
        for r in rows:
            assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_license_odd_texts(spark):
    texts = [None, "", "MIT License", "x MIT\n-- license. mit license", "mitx license", "GNU General Public License v3.0 or later and the Apache License, Version 2.0",
             "cc by cc by-nc 4.0 CC-BY-SA 3.0", "émit license mité license", "SPDX-License-Identifier: MIT", "cc by" * 3, "gnu general public license " * 300,
             "İ mit license", "all rights reserved.", "cc by mit license", "\x00mit\x7flicense"] * 2
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, base string")
    rows = {r.doc_id: r for r in scan_licenses(df).collect()}
    for i, t in enumerate(texts):
        r, want = rows[i], phrases(t)
        n = sum(b.n for b in r.base or [])
        assert (r.n_words, n, r.first_word, r.last_word, ",".join(sorted(b.label for b in r.base or []))) == want, t
    labels = lambda i: {d.label for d in rows[i].detections or []}
    assert labels(5) == {"gpl-3", "apache-2.0"} and labels(8) == {"mit"} and "cc-by-nc-4.0" in labels(6) and labels(12) == {"proprietary"}
    assert scan_licenses(df.limit(0)).count() == 0


def test_signatures_hold_their_keyword_and_are_many():
    rules = signatures()
    assert len(rules) > 150
    for r in rules:
        re.compile(r.regex)


def spelled(tree, g):
    """A text that the parsed regex matches, lines wrapped at every white space."""
    out = ""
    for op, arg in tree:
        op = str(op)
        if op == "LITERAL":
            out += chr(arg)
        elif op == "IN":
            out += "\n" if str(arg[0][1]) == "CATEGORY_SPACE" else "a" if str(arg[0][0]) == "CATEGORY" else chr(arg[0][1])
        elif op in ("MAX_REPEAT", "MIN_REPEAT"):
            out += "".join(spelled(arg[2], g) for _ in range(g.randint(arg[0], max(arg[0], min(int(arg[1]), 1)))))
        elif op == "SUBPATTERN":
            out += spelled(arg[3], g)
        elif op == "BRANCH":
            out += spelled(g.choice(arg[1]), g)
        else:
            assert op in ("AT", "ASSERT", "ASSERT_NOT"), op
    return out


def test_wrapped_notices_pass_keyword_and_gate(spark):
    import random
    from re import _parser

    g, texts, wanted = random.Random(3), [], []
    for r in signatures():
        for _ in range(20):
            text = spelled(_parser.parse(r.regex), g)
            assert re.search(r.regex, text), (r.regex, text)
            assert r.keyword in re.sub(r"\s+", " ", text) and any(x in text for x in GATES), (r, text)
        texts.append(text)
        wanted.append(r)
    rows = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, r in enumerate(wanted):
        assert any(d.label == r.label or d.priority >= r.priority for d in rows[i].detections or []), texts[i]
    texts = ["All rights\nreserved", "Placed into the public\ndomain", "Permission to\nuse, copy, modify, and distribute this software for any\npurpose",
             "see https://creativecommons.org/publicdomain/zero/1.0/"]
    rows = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [[d.label for d in rows[i].detections or []] for i in range(4)] == [["proprietary"], ["public-domain"], ["isc"], ["cc0"]]
    own = scan_licenses(spark.createDataFrame([(1, "the beer\nware terms")], "doc_id long, text string"), [Signature("beer", r"beer\s+ware", "beer ware", 1, 0.5)])
    assert [d.label for d in own.first().detections] == ["beer"]


def scan(text):
    """Detections by plain Python: every rule on every text, every pair compared."""
    low = (text or "").translate(AZ)
    found = {(m.start(), m.end(), r.label, r.priority, r.score) for r in signatures() for m in re.finditer(r.regex, low)}
    return sorted(d for d in found if not any(
        e[0] <= d[0] and e[1] >= d[1] and (e[3] > d[3] or e[3] == d[3] and e[1] - e[0] > d[1] - d[0]) for e in found))


def test_detections_against_every_rule_and_pair(spark):
    import random
    from re import _parser

    g, rules, texts = random.Random(7), signatures(), [None, "", "access to cc", "licence", "GNU  GENERAL\tPUBLIC \n LICENSE v2"]
    for r in rules * 20:
        text = spelled(_parser.parse(r.regex), g)
        assert re.search(r.stem, text) and r.gate in text, (r, text)
    for _ in range(250):
        parts = [spelled(_parser.parse(g.choice(rules).regex), g) for _ in range(g.choice([1, 2, 3, 12]))]
        texts.append(g.choice([" ", "\n", ". ", " and  ", "\r\n\t", " é 😀 "]).join(parts * g.choice([1, 1, 2])))
    df = spark.createDataFrame(list(enumerate(texts)) * 2, "doc_id long, text string").repartition(4)
    rows = scan_licenses(df).collect()
    assert len(rows) == 2 * len(texts)
    for r in rows:
        t = texts[r.doc_id]
        assert [(d["at"], d.to, d.label, d.priority, d.score) for d in r.detections or []] == scan(t), t
        assert r.n_words == phrases(t)[0] and (r.first_word, r.last_word) == phrases(t)[2:4], t


def test_words_are_counted_without_a_list_of_them(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = scan_licenses(df).select("doc_id", "n_words")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan
    texts = ["a", " a", "a ", " - a1b, É;é\n", "..", "\x00", "", None, "a" * 50_000, ". " * 50_000, "a " * 50_000, "\x7fmit\x80x😀_y", "é"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.n_words for r in scan_licenses(df).collect()} == {i: phrases(t)[0] for i, t in enumerate(texts)}


def test_text_of_many_notices(spark):
    import time

    n = 20_000
    text = "mit license, GNU General Public License v3.0 or later; " * n
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    scan_licenses(df.limit(0)).collect()
    began = time.time()
    row = scan_licenses(df).selectExpr("n_words", "base", "first_word", "last_word", "size(detections) AS n", "detections[0] AS d", "element_at(detections, -1) AS e").first()
    took = time.time() - began
    each = len(text) // n
    assert (row.n_words, row.first_word, row.last_word, row.n) == (10 * n, 0, 10 * n - 8, 2 * n) and sorted((b.label, b.n) for b in row.base) == [("gpl", n), ("mit", n)]
    assert (row.d["at"], row.d.label, row.e["at"], row.e.to, row.e.label) == (0, "mit", (n - 1) * each + 13, n * each - 2, "gpl-3")
    assert took < 60, took

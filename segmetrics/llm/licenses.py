"""License scans: ordered signature rules behind a keyword prefilter.

Each signature is a regular expression with a keyword that every match holds, a
label and a priority. A text is tested only against the rules whose keyword it
holds (and whose stem it matches, which rules of one name share); detections that
lie inside a detection of higher priority (or inside a longer one of the same
priority) are dropped. Everything is a row-local SQL expression: no shuffle, no
grouping, no Python code on the executors. Work grows with a text's length, and
with its n detections as n log n.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmetrics.llm.common import ascii_lower

# Base phrases and their labels.
BASE_PHRASES = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]

# ASCII without letters and digits, one by one: Java keeps a table of single characters, but tries ranges in turn.
_OTHER = "".join(rf"\x{i:02X}" for i in range(128) if not chr(i).isalnum())
WORD = f"[^{_OTHER}]"
SEP = f"[{_OTHER}]+"


@dataclass
class Signature:
    label: str
    regex: str        # on the A-Z lower-cased text
    keyword: str      # literal text that every match holds, once each run of white space in it is one space
    priority: int
    score: float
    gate: str = ""    # word that every match holds; else the longest of the keyword
    stem: str = ""    # regex with a match in every match; rules of one stem are tried behind it


def _version(v: str) -> str:
    return r",?\s+(?:version\s+|v\.?\s*)?" + v.replace(".", r"\.") + (r"(?:\.0)?" if "." not in v else "") + r"(?![\d.]*\d)"


def signatures() -> list[Signature]:
    """The rules, from families of names, versions and forms of statement."""
    out: list[Signature] = []
    families = [       # label, name as a regular expression, keyword, versions
        ("apache", r"apache(?:\s+software)?\s+licen[cs]e", "apache", ["1.0", "1.1", "2.0"]),
        ("agpl", r"(?:gnu\s+)?affero\s+general\s+public\s+licen[cs]e", "affero", ["1", "3"]),
        ("lgpl", r"(?:gnu\s+)?(?:lesser|library)\s+general\s+public\s+licen[cs]e", "general public", ["2", "2.1", "3"]),
        ("gpl", r"gnu\s+general\s+public\s+licen[cs]e", "gnu general public", ["1", "2", "3"]),
        ("mpl", r"mozilla\s+public\s+licen[cs]e", "mozilla", ["1.0", "1.1", "2.0"]),
        ("epl", r"eclipse\s+public\s+licen[cs]e", "eclipse", ["1.0", "2.0"]),
        ("cddl", r"common\s+development\s+and\s+distribution\s+licen[cs]e", "common development", ["1.0", "1.1"]),
        ("cpl", r"common\s+public\s+licen[cs]e", "common public", ["1.0"]),
        ("eupl", r"european\s+union\s+public\s+licen[cs]e", "european union", ["1.0", "1.1", "1.2"]),
        ("gfdl", r"gnu\s+free\s+documentation\s+licen[cs]e", "free documentation", ["1.1", "1.2", "1.3"]),
        ("artistic", r"artistic\s+licen[cs]e", "artistic", ["1.0", "2.0"]),
        ("osl", r"open\s+software\s+licen[cs]e", "open software", ["1.0", "2.0", "2.1", "3.0"]),
        ("afl", r"academic\s+free\s+licen[cs]e", "academic free", ["1.1", "1.2", "2.0", "2.1", "3.0"]),
        ("bsl", r"boost\s+software\s+licen[cs]e", "boost", ["1.0"]),
        ("ms-pl", r"microsoft\s+public\s+licen[cs]e", "microsoft", []),
        ("php", r"php\s+licen[cs]e", "php", ["3.0", "3.01"]),
        ("python", r"python\s+software\s+foundation\s+licen[cs]e", "python", ["2"]),
        ("zlib", r"zlib(?:/libpng)?\s+licen[cs]e", "zlib", []),
        ("isc", r"isc\s+licen[cs]e", "isc", []),
        ("mit", r"(?:the\s+)?(?:mit|x11|expat)\s+licen[cs]e", "licen", []),
        ("bsd", r"bsd(?:[\s-]+style)?\s+licen[cs]e", "bsd", []),
        ("ofl", r"(?:sil\s+)?open\s+font\s+licen[cs]e", "open font", ["1.0", "1.1"]),
        ("unlicense", r"(?:the\s+)?unlicense", "unlicense", []),
        ("wtfpl", r"do\s+what\s+the\s+f\w*\s+you\s+want\s+to\s+public\s+licen[cs]e", "do what the", ["1", "2"]),
    ]
    for label, name, kw, versions in families:
        out.append(Signature(label, rf"\b{name}\b", kw, 10, 0.7, "licen", name))
        out.append(Signature(label, rf"\b(?:licensed|released|distributed|available|published)\s+under\s+(?:the\s+)?(?:terms\s+of\s+(?:the\s+)?)?{name}\b",
                             kw, 20, 0.9, "licen", name))
        for v in versions:
            out.append(Signature(f"{label}-{v}", rf"\b{name}{_version(v)}", kw, 30, 0.95, "licen", name))
            out.append(Signature(f"{label}-{v}", rf"\b{name}{_version(v)}\s+or\s+(?:\(at\s+your\s+option\)\s+)?(?:any\s+)?later", kw, 40, 0.95,
                                 "licen", name))
    for terms in ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd"):
        spelled = terms.replace("-", r"[\s-]+")
        out.append(Signature(f"cc-{terms}", rf"\bcc[\s-]+{spelled}\b(?!-)", "cc", 10 + 2 * len(terms), 0.8, "cc", r"cc[\s-]+by"))
        out.append(Signature(f"cc-{terms}", rf"creativecommons\.org/licenses/{terms}(?![\w-])", "creativecommons", 15 + 2 * len(terms), 0.95,
                             "creativecommons", r"creativecommons\.org/licenses/by"))
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            out.append(Signature(f"cc-{terms}-{v}", rf"\bcc[\s-]+{spelled}[\s-]+{v.replace('.', '[.]')}\b", "cc", 40 + 2 * len(terms), 0.95, "cc",
                                 r"cc[\s-]+by"))
    for tag in ("mit", "apache-2.0", "gpl-2.0", "gpl-3.0", "lgpl-2.1", "lgpl-3.0", "agpl-3.0", "mpl-2.0", "epl-2.0", "bsd-2-clause",
                "bsd-3-clause", "isc", "zlib", "cc0-1.0", "unlicense", "0bsd", "bsl-1.0", "artistic-2.0"):
        out.append(Signature(tag, rf"spdx-license-identifier:\s*{tag.replace('.', '[.]')}(?:-only|-or-later|\+)?(?![\w.-])", "spdx", 90, 1.0, "spdx",
                             "spdx-license-identifier:"))
    for n in ("2", "3", "4"):
        out.append(Signature(f"bsd-{n}-clause", rf"\bbsd[\s-]+{n}[\s-]+clause\b|\b{n}[\s-]+clause\s+bsd\b", "clause", 35, 0.95))
    for label, regex, kw in (
            ("mit", r"permission\s+is\s+hereby\s+granted,\s+free\s+of\s+charge,\s+to\s+any\s+person\s+obtaining\s+a\s+copy", "hereby granted"),
            ("isc", r"permission\s+to\s+use,\s+copy,\s+modify,\s+and(?:/or)?\s+distribute\s+this\s+software\s+for\s+any\s+purpose", "permission to use"),
            ("bsd", r"redistribution\s+and\s+use\s+in\s+source\s+and\s+binary\s+forms", "redistribution"),
            ("gpl", r"under\s+the\s+terms\s+of\s+the\s+gnu\s+general\s+public\s+licen[cs]e\s+as\s+published", "gnu general public"),
            ("cc0", r"\bcc0\b", "cc0"),
            ("cc0", r"creativecommons\.org/publicdomain/zero", "creativecommons"),
            ("public-domain", r"(?:released|placed|dedicated)\s+(?:in)?to\s+the\s+public\s+domain", "public domain"),
            ("proprietary", r"\ball\s+rights\s+reserved\b", "all rights reserved"),
            ("zlib", r"this\s+software\s+is\s+provided\s+'as-is',\s+without\s+any\s+express", "as-is")):
        out.append(Signature(label, regex, kw, 50, 0.9))
    return out


#: A text without any of these words (in any case) is tested against no signature and no phrase. They hold no white space: lines may be wrapped anywhere.
GATES = ("licen", "cc", "spdx", "hereby", "permission", "redistribution", "domain", "reserved", "as-is", "clause", "creativecommons")


def _phrase(phrase: str) -> str:
    return rf"(?={phrase[0]})(?<!{WORD})" + SEP.join(phrase.split()) + rf"(?!{WORD})"      # the letter first: it is the cheapest test


def _n_words(text: Column) -> Column:
    """Runs of WORD, without a list of them: each becomes one byte, with all that stands around it."""
    return F.when(text.rlike(WORD), F.octet_length(F.regexp_replace(text, f"(?:{SEP})?{WORD}+(?:{SEP})?", "a"))).otherwise(0).cast("long")


RULES = "array<struct<label:string,regex:string,priority:int,score:double>>"


def _rules(rules: list[Signature]) -> Column:
    """A literal once the plan is folded; made of columns, the rules take the driver seconds."""
    return F.from_json(F.lit(json.dumps([{"label": r.label, "regex": r.regex, "priority": r.priority, "score": r.score} for r in rules])), RULES)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.transform(F.array(value), body)[0]


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Running totals of an ``array<int>`` under ``join``, in log n rounds: each adds what stands 1, 2, 4, ... places before."""
    def rounds(v: Column) -> Column:
        steps = F.transform(F.sequence(F.lit(1), F.length(F.bin(F.greatest(F.size(v), F.lit(1)) - 1))), lambda k: F.pow(F.lit(2), k - 1).cast("int"))
        return F.aggregate(steps, v, lambda a, step: F.transform(a, lambda x, i: F.when(i >= step, join(x, F.get(a, i - step))).otherwise(x)))
    return _let(values, rounds)


def _starts(text: Column, regex: Column) -> Column:
    """``array<struct<at, to>>`` of all matches of a non-empty regex: lengths of what lies between and of what matches."""
    between = F.transform(F.split(text, regex, -1), lambda s: F.length(s))
    matches = F.transform(F.regexp_extract_all(text, regex, F.lit(0)), lambda s: F.length(s))

    def places(x: Column) -> Column:          # one length more lies between
        ends = _running(F.zip_with(x.b, x.m, lambda b, m: b + F.coalesce(m, F.lit(0))), lambda a, b: a + b)
        return F.filter(F.zip_with(ends, x.m, lambda e, m: F.struct((e - m).alias("at"), e.alias("to"))), lambda s: s["at"].isNotNull())
    return _let(F.struct(between.alias("b"), matches.alias("m")), places)


def _uncovered(found: Column) -> Column:
    """The distinct detections that lie inside none of higher priority and inside no longer one of the same, in page order.

    Sorted by start, longest and highest first, all that cover a detection stand before it: it is covered if one before
    it of its priority or above ends as late. Of detections alike in place and priority none covers the other.
    """
    order = ("at", "back", "down", "label", "score")          # back, down: end and priority, negative
    alike = lambda x, y: (x["at"] == y["at"]) & (x.back == y.back) & (x.down == y.down)
    rows = F.array_sort(F.transform(found, lambda d: F.struct(
        d["at"].alias("at"), (-d.to).alias("back"), (-d.priority).alias("down"), d.label.alias("label"), d.score.alias("score"))))

    def level(s: Column, first: Column, down: Column) -> Column:
        ends = _running(F.transform(s, lambda x: F.when(x.down <= down, -x.back).otherwise(-1)), F.greatest)
        return _let(F.struct(first.alias("first"), ends.alias("ends")), lambda y: F.filter(s, lambda x, i: (x.down == down) & (
            F.coalesce(F.get(y.ends, F.get(y.first, i) - 1), F.lit(-1)) < -x.back)))

    def levels(s: Column) -> Column:
        first = _running(F.transform(s, lambda x, i: F.when((i > 0) & alike(x, F.get(s, i - 1)), 0).otherwise(i)), F.greatest)
        downs = F.array_distinct(F.transform(s, lambda x: x.down))
        return _let(first, lambda f: F.flatten(F.transform(downs, lambda down: level(s, f, down))))
    distinct = _let(rows, lambda s: F.filter(s, lambda x, i: (i == 0) | ~F.equal_null(F.struct(*[x[c] for c in order]), F.get(s, i - 1))))
    return F.array_sort(F.transform(_let(distinct, levels), lambda x: F.struct(
        x["at"].alias("at"), (-x.back).alias("to"), x.label.alias("label"), (-x.down).alias("priority"), x.score.alias("score"))))


def _tried(rules: list[Signature]) -> Column:
    """``array`` of the rules whose gate, keyword and stem the text holds."""
    none = F.array().cast(RULES)
    tree: dict[str, dict[str, dict[str, list[Signature]]]] = {}
    for r in rules:
        tree.setdefault(r.gate or max(r.keyword.split(), key=len), {}).setdefault(r.keyword, {}).setdefault(r.stem, []).append(r)
    held = lambda test, parts: F.when(test, F.concat(*parts)).otherwise(none)
    return F.concat(none, *[held(F.contains("l", F.lit(gate)), [
        held(F.contains("sq", F.lit(k)), [
            held(F.col("l").rlike(stem), [_rules(rs)]) if stem else _rules(rs) for stem, rs in sorted(stems.items())])
        for k, stems in sorted(keywords.items())]) for gate, keywords in sorted(tree.items())])


def scan_licenses(df: DataFrame, rules: list[Signature] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, base, first_word, last_word, detections`` for each row.

    ``base``: ``array<struct<label, n>>`` of base phrases (places where their
    words stand consecutively); ``first_word`` and ``last_word``: smallest and
    largest start, in words; ``detections``: ``array<struct<label, priority,
    score, at, to>>`` of the signatures left after suppression, in page order.
    A null or empty text has no words and no detections; repeated rows are
    scanned alike; other columns are ignored.
    """
    gates = GATES if rules is None else sorted({*GATES, *(max(r.keyword.split(), key=len) for r in rules)})
    rules = signatures() if rules is None else rules
    text, l = F.col("text"), F.col("l")
    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("low", F.lower(text))
    gate = F.lit(False)
    for g in gates:
        gate = gate | F.contains("low", F.lit(g))
    a_to_z = F.when(F.octet_length(text) == F.length(text), F.col("low")).otherwise(ascii_lower(text))       # all ASCII: lower does the same
    rows = rows.select("doc_id", _n_words(text).alias("n_words"), F.when(gate, a_to_z).alias("l"))
    squeezed = F.regexp_replace("l", r"[\t\n\x0B\f\r]\s*| \s+", " ")          # a single space stays
    rows = rows.withColumn("sq", squeezed)
    found = F.flatten(F.transform(F.filter(_tried(rules), lambda r: F.rlike(l, r.regex)), lambda r: F.transform(
        _starts(l, r.regex), lambda s: F.struct(s.at.alias("at"), s.to.alias("to"), r.label.alias("label"), r.priority.alias("priority"),
                                                r.score.alias("score")))))
    rows = rows.withColumn("found", F.when(l.isNotNull(), found))
    phrases = [(p, label, _phrase(p)) for p, label in BASE_PHRASES]
    count = lambda p, x: F.when(F.contains(l, F.lit(p.split()[0])), F.regexp_count(l, F.lit(x))).otherwise(0).cast("long")
    base = F.filter(F.array(*[F.struct(F.lit(label).alias("label"), count(p, x).alias("n")) for p, label, x in phrases]), lambda b: b.n > 0)
    base = F.when(F.col("places").isNotNull(), base).otherwise(F.array().cast("array<struct<label:string,n:bigint>>"))
    any_phrase = f"(?=[{''.join(sorted({p[0] for p, *_ in phrases}))}])(?:{'|'.join(x for *_, x in phrases)})"
    before = lambda at: _n_words(F.substring(l, F.lit(1), at))
    places = _starts(l, F.lit(any_phrase))
    rows = rows.withColumn("places", F.when(l.rlike(any_phrase), places))
    rows = rows.withColumn("first_word", F.when(F.size("places") > 0, before(F.col("places")[0]["at"])))
    return rows.select(
        "doc_id", "n_words", F.when(l.isNotNull(), base).alias("base"),
        "first_word", F.when(F.size("places") > 1, before(F.element_at("places", -1)["at"])).otherwise(F.col("first_word")).alias("last_word"),
        F.when(F.size("found") > 1, _uncovered(F.col("found"))).otherwise(F.col("found")).alias("detections"))

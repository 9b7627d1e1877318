"""URL filters: pattern rules indexed by their rarest literal token.

Every rule names literal tokens that any matching URL must hold. The tokens are
counted over all URLs, each rule is filed under its rarest one, and a URL's own
tokens fetch the few rules that are then tested. Everything is a row-local
expression over one scan; the only aggregate is the token count, with at most
one row for each token of the rules.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmetrics.llm.common import ascii_lower

# The base rules (action, host/path).
BASE_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
              ("block", "net/es/"), ("block", "net/fr/")]
MAX_RULES = 20_000


@dataclass
class Pattern:
    """``regex`` runs on the ASCII-lower-cased URL; ``tokens`` are whole alphanumeric runs that every match needs."""

    name: str
    action: str
    regex: str
    tokens: list[str] = field(default_factory=list)


def _param(name: str) -> Pattern:
    return Pattern(f"param:{name}", "block", rf"[?&]{name}=", re.findall("[0-9a-z]+", name))


def _folder(name: str) -> Pattern:
    return Pattern(f"folder:{name}", "block", rf"://[^?#]*/{name}(/|[?#]|$)", re.findall("[0-9a-z]+", name))


PATTERNS = [
    *(_param(p) for p in ("sessionid", "phpsessid", "jsessionid", "replytocom", "add_to_cart", "share", "print")),
    *(_folder(p) for p in ("login", "signin", "signup", "register", "logout", "cart", "checkout", "basket", "wp-login.php",
                           "wp-admin", "cgi-bin", "admin", "search", "casino", "poker", "porn", "xxx")),
    Pattern("calendar", "block", r"/calendar/\d{4}/\d{1,2}/\d{1,2}", ["calendar"]),
    Pattern("feed", "block", r"/(feed|rss)/?(xml)?$", []),
    Pattern("ads", "block", r"://ads?\d*\.", []),
]


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)), F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def _tokens(url: Column) -> Column:
    return F.array_distinct(F.split(ascii_lower(F.coalesce(url, F.lit(""))), "[^0-9a-z]+"))


def filter_urls(df: DataFrame, rules: list[tuple[str, str]] = BASE_RULES, patterns: list[Pattern] = PATTERNS,
                id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, pattern, verdict`` for each row.

    The longest fitting base rule decides; without one, the first fitting
    pattern; without either the URL is allowed. A null URL or one without
    ``://`` has an empty host and path and fits no rule. Repeated rows are
    judged alike, other columns are ignored, an empty table gives no rows.
    """
    if len(rules) + len(patterns) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    url = F.col("url")
    rows = df.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    needed = {r: re.findall("[0-9a-z]+", r.lower()) for _, r in rules} | {p.name: p.tokens for p in patterns}
    wanted = sorted({t for ts in needed.values() for t in ts})
    count = {}
    if wanted:
        count = dict(rows.select(F.explode(F.array_intersect(_tokens(url), F.array(*map(F.lit, wanted)))).alias("t"))
                     .groupBy("t").count().collect())          # at most one row for each token of the rules

    def filed(entries: list[tuple[str, Column]]) -> Column:
        """The rules that the URL's tokens fetch; those without a token are always tested."""
        index: dict[str, list[Column]] = {}
        for name, entry in entries:
            key = min(needed[name], key=lambda t: (count.get(t, 0), t), default="")
            index.setdefault(key, []).append(entry)
        always = index.pop("", [])
        if not index:
            return F.array(*always)
        fetch = F.create_map(*[x for t, es in sorted(index.items()) for x in (F.lit(t), F.array(*es))])
        none = F.array().cast(f"array<{ENTRY}>")
        got = F.flatten(F.transform(F.filter(_tokens(url), lambda t: F.array_contains(F.array(*map(F.lit, sorted(index))), t)),
                                    lambda t: F.coalesce(F.try_element_at(fetch, t), none)))
        return F.concat(got, F.array(*always)) if always else got

    def entry(n: int, name: str, action: str, host: str, path: str, regex: str) -> Column:
        return F.struct(F.lit(n).alias("n"), F.lit(name).alias("name"), F.lit(action).alias("action"),
                        F.lit(host).alias("host"), F.lit(path).alias("path"), F.lit(regex).alias("regex"))

    base = [(r, entry(len(r), r, a, r[:r.index("/")].lower(), r[r.index("/"):], "")) for a, r in rules]
    more = [(p.name, entry(i, p.name, p.action, "", "", p.regex)) for i, p in enumerate(patterns)]
    empty = F.array().cast(f"array<{ENTRY}>")
    host, path = host_path(url)
    out = rows.select("page_id", "url", host.alias("host"), path.alias("path"),
                      (filed(base) if base else empty).alias("base"), (filed(more) if more else empty).alias("more"))
    h, p = F.col("host"), F.col("path")
    fits = F.filter("base", lambda r: ((h == r.host) | h.endswith(F.concat(F.lit("."), r.host))) & p.startswith(r.path))
    runs = F.filter("more", lambda r: F.rlike(ascii_lower(url), r.regex))
    out = out.select("page_id", "host", "path", F.array_max(fits).alias("best"), F.array_min(runs).alias("hit"))
    return out.select(
        "page_id", "host", "path", F.col("best.name").alias("rule"),
        F.when(F.col("best").isNull(), F.col("hit.name")).alias("pattern"),
        F.coalesce("best.action", "hit.action", F.lit("allow")).alias("verdict"))


ENTRY = "struct<n:int,name:string,action:string,host:string,path:string,regex:string>"

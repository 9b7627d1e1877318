"""HTML extraction by two-pass block rules.

A page is cut into text blocks. First pass: stop-word density, length and link
density decide about every block that no navigation, advert, form or the like
holds. An article is one more input: it lowers the bounds, so that what its
blocks can't show by themselves is ambiguous there and not boilerplate. Second
pass: ambiguous blocks inherit the label of their nearest decided neighbours,
first those of the articles, within their article, where it takes boilerplate on
both sides to make them so; then the others, at an edge from the only one.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmetrics.llm.common import parts, small_batches

# Element names and frequent words.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset",
         "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li",
         "main", "menu", "nav", "ol", "option", "p", "pre", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
DROP = {"head", "nav", "header", "footer", "aside", "form", "menu", "noscript", "template", "svg", "math", "canvas", "object", "audio", "video",
        "button", "select", "datalist", "dialog", "map", "applet"}
ROOT = {"html", "body", "main"}
LEAF = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "dt", "dd", "li", "option"}           # closed by the next one of their kind
DROP_NAMES = set("ad ads adv advert adverts advertisement advertising adsense adbox banner promo promotion sponsor sponsored sidebar nav navbar "
                 "navigation menu breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice notices popup modal overlay "
                 "newsletter subscribe subscription signup login comment comments commentlist disqus reply replies respond share sharing social "
                 "related recommended recommendations widget toolbar pagination pager skiplink toc hidden form search".split())
DROP_ROLES = set("navigation banner complementary contentinfo search form alert dialog menu menubar".split())
STOP_WORDS = [set(x.split()) for x in (              # one line for each language
    "the and of to in is that it for with as was on are by this be at or from have an not which you were but a he she they his her we",
    "der die das und in den von zu mit sich des auf ist im dem nicht ein eine als auch es an für er sie wir war aus bei einer",
    "le la les de des et un une en du que qui dans pour sur pas est au avec par il elle ce se ne plus à l d",
    "el la los las de y en que un una del se con por su para no es al lo como más a e o ha",
    "il lo la i gli le di e un una che in per con non è del della si da a al sono come più",
    "o a os as de e um uma que em do da no na para com não por se dos das ao mais é",
    "de het een en van in is dat op te met voor niet zijn aan er om ook als door maar bij",
    "och i att det som en på är av för med till den inte ett han de om var sig har",
    "i w na z do się że nie to o jak za od po przez dla jest a co ale był",
    "и в не на что с по как это он к но из у за от то же для о его")]

_OPEN = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_BARE = re.compile(r"[^<>\"']*")
_ATTR = re.compile(r"\"[^\"]*\"|'[^']*'|([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
NO_SAY = {"has", "no", "not", "non", "with", "without", "overflow"}      # has-sidebar, no-comments, overflow-hidden say nothing about the element


@dataclass
class Rules:
    short: int = 70                 # characters
    long: int = 200
    link_density: float = 0.33
    stop_low: float = 0.15
    stop_high: float = 0.30


@dataclass
class Block:
    text: str
    linked: int
    article: int                    # number of the article that holds it, 0 without one
    heading: bool = False
    dropped: bool = False           # a container of boilerplate holds it
    row: bool = False               # a link beside another link of its article


def _tag(page: str, at: int, dead: set[int], last: dict[str, int]):
    """``start, end, closing, name, attributes`` of the next tag; comments and declarations have an empty name; None after the last.

    ``dead``: opening quotes known to lead to no tag's end, ``last``: the last
    place of each quote; they keep the scan of a whole page linear.
    """
    while (at := page.find("<", at)) >= 0:
        if page.startswith(("<!", "<?"), at):
            close, skip = ("-->", 4) if page.startswith("<!--", at) else (">", 2)
            end = page.find(close, at + skip)
            return at, len(page) if end < 0 else end + len(close), False, "", ""
        if m := _OPEN.match(page, at):
            tried, end = [], _BARE.match(page, m.end()).end()
            while page[end:end + 1] in ("\"", "'") and end not in dead and end < last[page[end]]:
                tried.append(end)
                end = _BARE.match(page, page.index(page[end], end + 1) + 1).end()
            if page[end:end + 1] == ">":
                return at, end + 1, bool(m[1]), m[2].lower(), page[m.end():end]
            dead.update(tried)
        at += 1
    return None


NO, NAMED, SURE = 0, 1, 2


def _drops(name: str, attrs: str) -> int:
    """SURE where element, role or hiding make it boilerplate, NAMED where its class or id says so."""
    if name in DROP:
        return SURE
    if not attrs.strip() or name in ROOT:
        return NO
    named = NO
    for key, a, b, c in _ATTR.findall(attrs):
        key, value = key.lower(), (a or b or c).lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "role" and value in DROP_ROLES):
            return SURE
        if key in ("class", "id"):
            words = {w for x in value.split() if (ws := re.split("[^0-9a-z]+", x))[0] not in NO_SAY for w in ws}
            if not DROP_NAMES.isdisjoint(words) and (name != "article" or {"comment", "comments", "reply", "ad", "ads", "related"} & words):
                named = NAMED
    return named


def _released(above: list[int], found: list[tuple[int, bool, int]]) -> set[int]:
    """The named containers (0: none) that hold most of the page's text, while no article stands outside of them.

    ``above``: the next outer one of each; ``found``: container, in an article,
    and size of each block.
    """
    size, article = [0] * len(above), [False] * len(above)
    for c, inside, n in found:
        size[c] += n
        article[c] |= inside
    for c in range(len(above) - 1, 0, -1):
        size[above[c]] += size[c]
    free, clean = {0}, article[0]
    for c in range(1, len(above)):
        if above[c] in free and 2 * size[c] > size[0] and not clean:
            free.add(c)
            clean = article[c]
    return free


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order, with what their containers say."""
    out: list[Block] = []
    within: list[int] = []                             # of each block the innermost container whose name is boilerplate, 0 without one
    above = [0]
    stack: list[tuple[str, bool, int, int]] = []       # element, inside sure boilerplate, number of the article, named container
    opened: Counter = Counter()                        # elements on the stack
    articles = 0
    parts: list[str] = []
    links: list[str] = []
    in_link = 0

    def flush():
        nonlocal parts, links
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            _, drop, article, named = stack[-1] if stack else ("", False, 0, 0)
            linked = len(" ".join(html.unescape("".join(links)).split()))
            out.append(Block(text, linked, article, bool(stack) and stack[-1][0] in HEADINGS, drop))
            within.append(named)
        parts, links = [], []

    def push(piece: str):
        if piece:
            parts.append(piece)
            if in_link:
                links.append(piece)

    at, dead, last = 0, set(), {q: page.rfind(q) for q in "\"'"}
    while True:
        tag = _tag(page, at, dead, last)
        if not tag:
            push(page[at:])
            break
        start, end, closing, name, attrs = tag
        push(page[at:start])
        at = end
        if not name:
            continue
        if name in RAW and not closing:
            m = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = m.end() if m else len(page)
            continue
        if name == "a":
            in_link = 0 if closing else 1
        if name == "br":
            push(" ")
        drop = NO if closing or name in VOID else _drops(name, attrs)
        if name not in BLOCK and not drop and not (closing and opened[name]):
            continue                                   # an inline element without a say
        flush()
        if name in VOID:
            continue
        if closing:
            while opened[name]:
                opened[gone := stack.pop()[0]] -= 1
                if gone == name:
                    break
            continue
        while stack and stack[-1][0] in LEAF and (stack[-1][0] == name or (stack[-1][0] not in ("li", "dd", "option") and name in BLOCK)):
            opened[stack.pop()[0]] -= 1
        _, inside, article, named = stack[-1] if stack else ("", False, 0, 0)
        if drop == NAMED:
            above.append(named)
            named = len(above) - 1
        if name in ("article", "main") and not article:
            articles += 1
            article = articles
        stack.append((name, inside or drop == SURE, article, named))
        opened[name] += 1
    flush()
    free = _released(above, [(c, b.article > 0, len(b.text)) for b, c in zip(out, within) if not b.dropped])
    for b, c in zip(out, within):
        b.dropped |= c not in free
    return out


def stop_density(text: str) -> float:
    """The share of stop words, in the language that has most of them."""
    words = [w.strip(".,;:!?()\"'").lower() for w in text.split()]
    return max(sum(w in some for w in words) for some in STOP_WORDS) / len(words)


def decide(b: Block, rules: Rules, known: bool = True) -> str:
    """text, boilerplate, or the ambiguous labels short and near; without ``known`` stop words (of no listed language) length decides.

    Of an article's blocks only links in a row and notices of rights are boilerplate at once.
    """
    size = len(b.text)
    if b.linked / size > rules.link_density:
        return "short" if b.article and not b.row else "boilerplate"
    if "\xa9" in b.text[:40] and size < rules.long:
        return "boilerplate"
    if size < rules.short:
        return "boilerplate" if b.linked and not b.article else "short"
    stop = stop_density(b.text) if known else rules.stop_high
    if stop >= rules.stop_high:
        return "text" if size > rules.long else "near"
    if b.article:
        return "text" if stop >= rules.stop_low and size > rules.long else "near"
    return "near" if stop >= rules.stop_low else "boilerplate"


def _rows_of_links(blocks: list[Block], rules: Rules) -> None:
    linked = [not b.heading and b.linked > rules.link_density * len(b.text) for b in blocks]
    for i, b in enumerate(blocks):
        b.row = linked[i] and any(linked[j] and blocks[j].article == b.article for j in (i - 1, i + 1) if 0 <= j < len(blocks))


def _decided(labels: list[str], articles: list[int]) -> tuple[list[int], list[int]]:
    """Of each block the nearest decided block before and behind it, -1 without one; an article's blocks look within it."""
    n = len(labels)
    before, behind = [-1] * n, [-1] * n
    for out, order in ((before, range(n)), (behind, range(n - 1, -1, -1))):
        last: dict[int, int] = {}                       # by article; outside of them every block counts
        for i in order:
            out[i] = last.get(articles[i], -1)
            if labels[i] in ("text", "boilerplate"):
                last[articles[i]] = last[0] = i
    return before, behind


def main_blocks(page: str, rules: Rules = Rules()) -> list[str]:
    """The main text's blocks in page order."""
    blocks = [b for b in blocks_of(page) if not b.dropped]
    _rows_of_links(blocks, rules)
    known = any(len(b.text) >= rules.short and stop_density(b.text) >= rules.stop_low for b in blocks)
    labels = [decide(b, rules, known) for b in blocks]
    n, articles = len(labels), [b.article for b in blocks]
    none = "text" not in labels and not any(articles)
    before, behind = _decided(labels, articles)
    for i, b in enumerate(blocks):
        if b.article and labels[i] in ("near", "short"):
            beside = [labels[j] for j in (before[i], behind[i]) if j >= 0]
            labels[i] = "boilerplate" if beside == ["boilerplate"] * 2 else "text"
    before, behind = _decided(labels, articles)
    keep = []
    for i, x in enumerate(labels):
        beside = [j for j in (before[i], behind[i]) if j >= 0]
        sides = {labels[j] for j in beside}
        if x == "near":
            x = "text" if "text" in sides or none else "boilerplate"
        elif x == "short":
            near = [labels[j] for j in (i - 1, i + 1) if 0 <= j < n]
            inherits = sides == {"text"} and (len(beside) == 2 or not blocks[beside[0]].article)         # an article does not reach beyond its end
            x = "text" if inherits or ("text" in sides and "near" in near) or none else "boilerplate"
        keep.append(x == "text")
    return [b.text for b, k in zip(blocks, keep) if k]


def extract_text(df: DataFrame, rules: Rules = Rules(), id_col: str = "page_id", html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``page_id, text`` and the columns in ``keep``, one row for each input row.

    Character references are decoded, white space inside a block becomes one
    space, blocks are joined by a line feed. A null or empty page, or one
    without main text, gives the empty text. Repeated rows are extracted alike;
    an empty table gives no rows.
    """
    keep = keep or []
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in parts(batches):
            texts = ["\n".join(main_blocks(p or "", rules)) for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), *(batch.column(c) for c in keep)],
                                             names=["page_id", "text", *keep])

    schema = f"page_id {kind}, text string" + "".join(f", `{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return small_batches(df).select(F.col(id_col).alias("page_id"), F.col(html_col).cast("string").alias("html"), *keep).mapInArrow(run, schema)

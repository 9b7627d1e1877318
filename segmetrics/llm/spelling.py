"""Grouping of spelling variants with bidirectional FM-index search schemes.

Words are counted over all texts. Two words one edit apart agree in the first
or in the second half of either: a word is filed under the first halves that a
word of its own length, one less or one more would have, and likewise under
second halves, and asks under its own two halves. Shards of filed words (a
half that many words share is dealt into blocks of texts and of asks) build a
bidirectional FM-index over their delimited words ``$word$word$``: one index of
the text, one of its reverse, and intervals of suffix ranks kept in step. A
search matches a half, with its delimiter, from the cut outwards, and extends
over the other half allowing one error; second halves are the same search with
the two indexes and the word turned round. Each pair is found once: what the
second search finds with an equal first half is left to the first.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmetrics.llm.common import parts, small_batches, stored

RUN = "A-Za-zÀ-ÿ"
SYMBOLS = 300_000             # aimed at in the text of one index
STEP = 16                     # rows between the counts that an index stores
FEW = 64                      # rows of a state whose letters are listed one by one
CHUNK = 4_000                 # asks searched at once
HELD = 200_000                # words that a task counts before it hands them on
END, MARK = 0, 1              # symbols: end of the text, delimiter of words; letters follow

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")      # of UTF-8: other letters stay


def count_words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6, drop_one_in: int = 199) -> DataFrame:
    """``word, n``: lower-cased runs of letters with ``least`` code points or more, over whole texts.

    A run loses the code point crc32 % length where ``drop_one_in`` divides the
    crc32 of ``<id>:<run>`` (0: never). A null id counts as an empty one.
    """
    runs = re.compile(f"[{RUN}]{{{least},}}")

    def count(batches):
        held: Counter = Counter()
        for batch in parts(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = Counter(runs.findall((text or "").encode().translate(_LOWER).decode()))
                if drop_one_in:
                    prefix = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                    for run in [r for r in own if zlib.crc32(r.encode(), prefix) % drop_one_in == 0]:
                        at, n = zlib.crc32(run.encode(), prefix) % len(run), own.pop(run)
                        if len(run) > least:
                            held[run[:at] + run[at + 1:]] += n
                held.update(own)
                if len(held) > HELD:
                    yield counts(held)
                    held = Counter()
        yield counts(held)

    def counts(held):
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    some = small_batches(df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))).mapInArrow(count, "word string, n long")
    return some.groupBy("word").agg(F.sum("n").alias("n"))


class Index:
    """FM-index of one direction: suffix ranks, last column, counts at every STEP rows."""

    def __init__(self, text: np.ndarray, sigma: int):
        n = len(text)
        packed = max(1, min(n, int(62 / math.log2(sigma))))                 # symbols that a first key holds
        rank = np.zeros(n, np.int64)
        for k in range(packed):
            rank = rank * sigma
            rank[:n - k] += text[k:]
        reach = packed
        while True:
            order = np.argsort(rank, kind="stable")
            new = np.zeros(n, np.int64)
            new[order[1:]] = np.cumsum(rank[order[1:]] != rank[order[:-1]])
            if n < 2 or new[order[-1]] == n - 1:
                break
            rank = new * (n + 1)
            rank[:max(0, n - reach)] += new[reach:] + 1
            reach *= 2
        self.suffix, self.sigma, self.n = order, sigma, n
        self.last = np.full(n + STEP, 255, np.uint8)
        self.last[:n] = text[order - 1]
        at = np.arange(n) // STEP * sigma + self.last[:n]
        counts = np.bincount(at, minlength=(n // STEP + 1) * sigma).reshape(-1, sigma)
        self.before = np.zeros((len(counts) + 1, sigma), np.int32)
        np.cumsum(counts, 0, out=self.before[1:])
        self.first = np.concatenate(([0], np.cumsum(self.before[-1])))[:sigma]
        self.below = np.cumsum(self.before, 1, dtype=np.int32) - self.before
        self.starts = np.flatnonzero(text == MARK)                          # of words, the last one of none

    def _rows(self, c: np.ndarray, i: np.ndarray):
        block = i // STEP
        rows = self.last[(block * STEP)[:, None] + np.arange(STEP)]
        return block, rows, np.arange(STEP, dtype=np.uint8) < (i - block * STEP).astype(np.uint8)[:, None]

    def ranks(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How many of the first ``i`` rows of the last column are ``c``."""
        out = np.empty(len(c), np.int64)
        for lo in range(0, len(c), 65_536):
            x, r = c[lo:lo + 65_536].astype(np.uint8), i[lo:lo + 65_536]
            block, rows, inside = self._rows(x, r)
            out[lo:lo + 65_536] = self.before[block, x] + np.count_nonzero((rows == x[:, None]) & inside, 1)
        return out

    def smaller(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How many of the first ``i`` rows of the last column are smaller than ``c``."""
        out = np.empty(len(c), np.int64)
        for lo in range(0, len(c), 65_536):
            x, r = c[lo:lo + 65_536].astype(np.uint8), i[lo:lo + 65_536]
            block, rows, inside = self._rows(x, r)
            out[lo:lo + 65_536] = self.below[block, x] + np.count_nonzero((rows < x[:, None]) & inside, 1)
        return out

    def words(self, row: np.ndarray) -> np.ndarray:
        """Number of the word whose opening delimiter the suffix at this rank begins with."""
        return np.searchsorted(self.starts, self.suffix[row])


def extend(index: Index, c: np.ndarray, lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of the intervals after one more symbol on the side of ``index``."""
    before = index.ranks(c, lo)
    return index.first[c] + before, index.ranks(c, lo + size) - before


def shift(index: Index, c: np.ndarray, lo: np.ndarray, size: np.ndarray) -> np.ndarray:
    """How far this symbol moves the interval's start in the index of the other direction."""
    return index.smaller(c, lo + size) - index.smaller(c, lo)


def children(index: Index, lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(state, letter) for every letter that may extend a state on the side of ``index``."""
    small = np.flatnonzero(size <= FEW)
    state = np.repeat(small, size[small])
    rows = np.arange(len(state)) - np.repeat(np.cumsum(size[small]) - size[small], size[small]) + lo[state]
    key = np.unique(state * index.sigma + index.last[rows])
    big = np.flatnonzero(size > FEW)
    key = np.concatenate((key, (big[:, None] * index.sigma + np.arange(index.sigma)).ravel()))
    state, c = key // index.sigma, key % index.sigma
    letter = c > MARK
    return state[letter], c[letter]


def search(left: Index, right: Index, flat: np.ndarray, start: np.ndarray, length: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ask, rank in ``right``) of every word with the ask's first ``cut`` symbols and exactly one error in the rest.

    ``flat[start:start + length]`` are the symbols of an ask. Its first half is
    matched from the cut to the left, up to the delimiter, with the intervals
    of both indexes in step; from there only that of ``right`` is needed. A
    state goes right with no error yet or with its one error behind it. Errors
    concern letters only.
    """
    def symbol(ask, pos):
        """The ask's symbol, the delimiter before and behind it."""
        inside = (pos >= 0) & (pos < length[ask])
        return np.where(inside, flat[np.where(inside, start[ask] + pos, 0)] if len(flat) else MARK, MARK)

    ask = np.arange(len(start))
    lo, rlo, size = np.zeros(len(ask), np.int64), np.zeros(len(ask), np.int64), np.full(len(ask), left.n, np.int64)
    ready: dict[int, list] = {}                                            # states without an error, by position
    step = 0
    while len(ask):
        c = symbol(ask, cut[ask] - 1 - step)
        rlo = rlo + shift(left, c, lo, size)
        lo, size = extend(left, c, lo, size)
        done = (cut[ask] == step) & (size > 0)
        for p in np.unique(cut[ask[done]]):
            at = done & (cut[ask] == p)
            ready.setdefault(int(p), []).append((ask[at], rlo[at], size[at]))
        on = (cut[ask] > step) & (size > 0)
        ask, lo, rlo, size = ask[on], lo[on], rlo[on], size[on]
        step += 1
    wrong: dict[int, list] = {}                                            # states with their error behind them
    found = []
    p = min(ready, default=0)
    while ready or wrong:
        if p in ready:
            ask, lo, size = (np.concatenate(x) for x in zip(*ready.pop(p)))
            inner = p < length[ask]
            wrong.setdefault(p + 1, []).append((ask[inner], lo[inner], size[inner]))                     # the ask's letter is missing
            s, c = children(right, lo, size)
            lo, size = extend(right, c, lo[s], size[s])
            some = size > 0
            s, c, lo, size = s[some], c[some], lo[some], size[some]
            own = symbol(ask[s], np.full(len(s), p))
            wrong.setdefault(p, []).append((ask[s], lo, size))                                           # a letter more
            sub = inner[s] & (c != own)
            wrong.setdefault(p + 1, []).append((ask[s][sub], lo[sub], size[sub]))                        # another letter
            same = inner[s] & (c == own)
            if same.any():
                ready.setdefault(p + 1, []).append((ask[s][same], lo[same], size[same]))
        if p in wrong:
            ask, lo, size = (np.concatenate(x) for x in zip(*wrong.pop(p)))
            lo, size = extend(right, symbol(ask, np.full(len(ask), p)), lo, size)
            over = (p == length[ask]) & (size > 0)
            found.append((ask[over], lo[over]))
            on = (p < length[ask]) & (size > 0)
            if on.any():
                wrong.setdefault(p + 1, []).append((ask[on], lo[on], size[on]))
        p += 1
        if p not in ready and p not in wrong:
            p = min([*ready, *wrong], default=p)
    if not found:
        return np.zeros(0, int), np.zeros(0, int)
    key = np.unique(np.concatenate([a * right.n + b for a, b in found]))   # two errors may lead to one word
    return key // right.n, key % right.n


def near_words(texts: list[str], asks: list[str], sides: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ask, text) numbers of the texts (all distinct) one edit from an ask that share its first half
    (side 0: length // 2), or its second half but not its first one (side 1)."""
    points = sorted({c for w in texts for c in w} | {c for w in asks for c in w})
    code = {c: i + 2 for i, c in enumerate(points)}
    sigma = len(points) + 2

    def symbols(words):
        return np.array([code[c] for w in words for c in w], np.int64)

    text = np.array([*(x for w in texts for x in (MARK, *(code[c] for c in w))), MARK], np.int64)
    forward = Index(np.append(text, END), sigma)
    backward = Index(np.append(text[::-1], END), sigma)
    out = []
    for side in (0, 1):
        mine = np.flatnonzero(sides == side)
        for lo in range(0, len(mine), CHUNK):
            part = mine[lo:lo + CHUNK]
            words = [asks[i] for i in part]
            length = np.array([len(w) for w in words])
            start, half = np.cumsum(length) - length, length // 2
            if side == 0:
                a, rank = search(forward, backward, symbols(words), start, length, half)
                found = len(texts) - 1 - backward.words(rank)
            else:
                a, rank = search(backward, forward, symbols([w[::-1] for w in words]), start, length, length - half)
                found = forward.words(rank)
                other = np.array([not texts[t].startswith(words[i][:half[i]]) for i, t in zip(a, found)], bool)
                a, found = a[other], found[other]
            out.append((part[a], found))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, int), np.zeros(0, int))


def _filed(words: DataFrame, least: int) -> DataFrame:
    """``word, n, side, half, asks``: the halves under which a word is filed; ``asks``: its own ones."""
    m = F.length("word")
    lengths = F.filter(F.array(m - 1, m, m + 1), lambda x: x >= least)
    first = F.transform(lengths, lambda x: F.floor(x / 2).cast("int"))
    second = F.transform(lengths, lambda x: (x - F.floor(x / 2)).cast("int"))

    def halves(side, sizes, own, cut):
        return F.transform(F.array_distinct(sizes), lambda k: F.struct(F.lit(side).alias("side"), cut(k).alias("half"), (k == own).alias("asks")))
    keys = F.concat(halves(0, first, F.floor(m / 2), lambda k: F.substring(F.col("word"), F.lit(1), k)),
                    halves(1, second, m - F.floor(m / 2), lambda k: F.substring(F.col("word"), m - k + 1, k)))
    return words.select("word", "n", F.explode(keys).alias("k")).select("word", "n", "k.side", "k.half", "k.asks")


def _near(words: DataFrame, least: int, symbols: int) -> DataFrame:
    """``word, n_near, best``: number of near words, and the near word of largest n (ties: the smallest)."""
    filed = _filed(words, least)
    size = (F.length("word") + 1).cast("long")
    total = filed.agg(F.sum(size)).first()[0] or 0
    shards = max(1, -(-total // symbols))
    crowded = (filed.groupBy("side", "half").agg(F.sum(size).alias("size")).filter(F.col("size") > symbols)
               .select("side", "half", F.ceil(F.col("size") / symbols).cast("long").alias("blocks")))
    dealt = filed.join(crowded, ["side", "half"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))
    own = F.pmod(F.xxhash64("word"), "blocks")
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    # a pair of blocks (texts, asks) is a group; with one block a row is both
    def at(t, a, text, ask):
        return F.struct(t.alias("t"), a.alias("a"), F.lit(text).alias("text"), ask.alias("ask"))
    alone = F.array(at(own, own, True, F.col("asks")))
    spread = F.concat(F.transform(every, lambda x: at(own, x, True, F.lit(False))),
                      F.transform(F.when(F.col("asks"), every).otherwise(F.array().cast("array<long>")), lambda x: at(x, own, False, F.lit(True))))
    place = F.xxhash64("side", "half")
    dealt = dealt.withColumn("shard", F.when(F.col("blocks") == 1, F.pmod(place, F.lit(shards))).otherwise(place))
    dealt = dealt.withColumn("at", F.explode(F.when(F.col("blocks") == 1, alone).otherwise(spread)))
    dealt = dealt.select("shard", "at.t", "at.a", "at.text", "at.ask", "side", "word", "n")

    def find(rows):
        word, n, text, ask, side = (rows.column(c).to_pylist() for c in ("word", "n", "text", "ask", "side"))
        count = {w: k for w, k, t in zip(word, n, text) if t}
        words, asked = sorted(count), [w for w, x in zip(word, ask) if x]
        n = np.array([count[w] for w in words], np.int64)
        sides = np.array([s for s, x in zip(side, ask) if x], np.int64)
        i, near = near_words(words, asked, sides) if words and asked else (np.zeros(0, int), np.zeros(0, int))
        order = np.lexsort((near, -n[near], i))
        i, near = i[order], near[order]
        one, first, times = np.unique(i, return_index=True, return_counts=True)
        return pa.table({"word": pa.array([asked[x] for x in one], pa.string()), "n_near": pa.array(times, pa.int64()),
                         "best_n": pa.array(n[near[first]], pa.int64()), "best": pa.array([words[j] for j in near[first]], pa.string())})

    found = dealt.groupBy("shard", "t", "a").applyInArrow(find, "word string, n_near long, best_n long, best string")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))).alias("best"))


def group_variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6, least_n: int = 5, times: int = 5,
                   drop_one_in: int = 199, symbols: int = SYMBOLS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word with ``least`` code points and ``least_n`` occurrences or more.

    Words are near if one inserted, deleted or replaced code point tells them
    apart. The form is the near word of largest ``n`` (ties: the smallest in
    code-point order) if that is at least ``times`` (2 or more) the word's own,
    else null; the root is the end of the chain of forms.

    Null and empty texts have no words, repeated rows count each time, very
    long words are words, an empty table gives no rows; a null id is an empty
    one. Other columns are not read.
    """
    words = stored(count_words(df, id_col, text_col, least, drop_one_in).filter(F.col("n") >= least_n))
    near = _near(words, least, symbols)
    is_form = -F.col("best.less") >= times * F.col("n")
    grouped = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best.word")).alias("form"),
        F.when(is_form, -F.col("best.less")).alias("form_n")))
    most = words.agg(F.max("n")).first()[0] or 1
    links = math.floor(math.log(max(1, most / least_n), times) + 1e-9) + 1      # a chain has at most so many forms
    up = grouped.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(links)) if links > 1 else 0):
        up = stored(up.alias("a").join(up.alias("b"), F.col("a.root") == F.col("b.word"), "left").select("a.word", F.coalesce("b.root", "a.root").alias("root")))
    return grouped.join(up, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

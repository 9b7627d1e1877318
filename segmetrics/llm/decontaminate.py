"""Benchmark decontamination with a generalised suffix automaton.

The normalised items are dealt into shards of at most ``SHARD_WORDS`` words,
which are broadcast; a task builds each shard's automaton once. The documents
are streamed: every stretch of words whose neighbouring pairs all
occur in the items is walked through the automaton, which tracks the longest
match that ends at each word. (No match of two words or more can leave such a
stretch.) Benchmarks of more than ``PASS_WORDS`` words take several passes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmetrics.llm.common import SpanHasher, parts, small_batches, spans, stored

SHARD_WORDS = 100_000
PASS_WORDS = 400_000
CHUNK = 1 << 20               # bytes of text that are taken at once

_CODE = np.arange(256, dtype=np.uint8)
_CODE[65:91] += 32                                                  # A-Z lower-cased
_IS_WORD = (_CODE >= 128) | ((_CODE >= 48) & (_CODE < 58)) | ((_CODE >= 97) & (_CODE < 123))


def words_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and start and end of each word."""
    raw = np.frombuffer(data, np.uint8)
    return _CODE[raw], *spans(_IS_WORD[raw])


def normalised(text: str) -> list[bytes]:
    low, start, end = words_of((text or "").encode())
    data = low.tobytes()
    return [data[i:j] for i, j in zip(start.tolist(), end.tolist())]


class Automaton:
    """Suffix automaton of several word sequences."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[tuple[int, str]] = []
        for item, words in items:
            state = 0
            for w in words:
                state = self._extend(state, w)
                ends.append((state, item))
        # items under each state, from each place where a prefix ends up along the suffix links
        members: list[set] = [set() for _ in self.next]
        for state, item in ends:
            while state > 0 and item not in members[state]:
                members[state].add(item)
                state = self.link[state]
        self.items = [tuple(m) if self.length[i] >= window else () for i, m in enumerate(members)]
        #: state -> lengths of whole items, shorter than a window, that end there
        self.short: dict[int, dict[int, tuple]] = {}
        for item, words in items:
            if 0 < len(words) < window:
                state = 0
                for w in words:
                    state = self.next[state][w]
                old = self.short.setdefault(state, {}).get(len(words), ())
                self.short[state][len(words)] = tuple({*old, item})
        self.least = min([window, *(len(x) for _, x in items if x)])

    def _extend(self, last: int, w: bytes) -> int:
        if w in self.next[last]:                                   # another item took the same step
            q = self.next[last][w]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
        new = self._state(self.length[last] + 1, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
        else:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return new

    def _state(self, length: int, step: dict) -> int:
        self.next.append(step)
        self.length.append(length)
        self.link.append(0)
        return len(self.next) - 1

    def _split(self, p: int, w: bytes, q: int) -> int:
        """A copy of ``q`` for its strings that end in ``p`` and ``w``."""
        copy = self._state(self.length[p] + 1, dict(self.next[q]))
        self.link[copy], self.link[q] = self.link[q], copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def walk(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set, int]:
        """Word spans that lie in occurrences of windows, the windows' items, the longest match."""
        found, items, longest = [], set(), 0
        state = size = 0
        for i, w in enumerate(words):
            while state > 0 and w not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if w not in self.next[state]:
                state = size = 0
                continue
            state, size = self.next[state][w], size + 1
            longest = max(longest, size)
            wide = 0
            if size >= self.window:
                wide, at = self.window, state
                while self.length[self.link[at]] >= self.window:     # the state of the last window's words
                    at = self.link[at]
                items.update(self.items[at])
            at = state
            while at > 0 and self.short:                              # whole short items among the suffixes
                for n, who in self.short.get(at, {}).items():
                    if n <= size:
                        items.update(who)
                        wide = max(wide, n)
                at = self.link[at]
            if wide:
                if found and found[-1][1] >= i + 1 - wide:
                    found[-1] = (min(found[-1][0], i + 1 - wide), i + 1)
                    while len(found) > 1 and found[-2][1] >= found[-1][0]:
                        a, b = found.pop()
                        found[-1] = (min(a, found[-1][0]), b)
                else:
                    found.append((i + 1 - wide, i + 1))
        return found, items, longest


class Matcher:
    """Finds the stretches of a text that an automaton may match, from hashes of words and of word pairs."""

    def __init__(self, shards: list[tuple[Automaton, list]]):
        self.hasher = SpanHasher()
        self.automata = [a for a, _ in shards]
        self.least = min((a.least for a in self.automata), default=1)
        words = {w for _, items in shards for _, ws in items for w in ws}
        pairs = {p for _, items in shards for _, ws in items for p in zip(ws, ws[1:])}
        data = b"\0".join(sorted(words))
        buf = np.frombuffer(data, np.uint8)
        start, end = spans(buf != 0)
        hashed = self.hasher(buf, start, end)
        number = dict(zip(sorted(words), hashed.tolist()))
        self.word = self._filter(hashed)
        self.pair = self._filter(self._pairs(np.array([number[a] for a, _ in pairs], np.uint64), np.array([number[b] for _, b in pairs], np.uint64)))

    @staticmethod
    def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return a * np.uint64(0x9E3779B97F4A7C15) ^ (b >> np.uint64(7)) * np.uint64(0xD6E8FEB86659FD93)

    @staticmethod
    def _filter(hashed: np.ndarray) -> np.ndarray:
        """Bits by hash: a word that is not in it is surely not among the items'."""
        bits = np.zeros(1 << max(16, int(np.ceil(np.log2(64 * max(1, len(hashed)))))), bool)
        bits[(hashed >> np.uint64(20)).astype(np.int64) & (len(bits) - 1)] = True
        return bits

    def stretches(self, low: np.ndarray, start: np.ndarray, end: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end word of each stretch worth a walk; ``breaks``: words that start a text."""
        hashed = self.hasher(low, start, end)
        known = self.word[(hashed >> np.uint64(20)).astype(np.int64) & (len(self.word) - 1)]
        if not len(known):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        joined = np.zeros(len(known), bool)                          # with the word before
        both = np.flatnonzero(known[1:] & known[:-1]) + 1
        h = self._pairs(hashed[both - 1], hashed[both])
        joined[both] = self.pair[(h >> np.uint64(20)).astype(np.int64) & (len(self.pair) - 1)]
        joined[breaks[breaks < len(joined)]] = False
        if self.least == 1:
            first = np.flatnonzero(known & ~joined)
            last = np.flatnonzero(known & ~np.append(joined[1:], False)) + 1
            return first, last
        a, b = spans(joined)
        a = a - 1
        long = b - a >= self.least
        return a[long], b[long]


def _chunks(texts: list[bytes | None]):
    """Lists of row numbers of about CHUNK bytes of text."""
    at, size = [], 0
    for i, t in enumerate(texts):
        at.append(i)
        size += len(t or b"")
        if size >= CHUNK:
            yield at
            at, size = [], 0
    if at:
        yield at


def _shards(items):
    """Lists of ``(id, words)`` of SHARD_WORDS words at most (an item that is longer stands alone)."""
    some, size = [], 0
    for item, words in items:
        if some and size + len(words) > SHARD_WORDS:
            yield some
            some, size = [], 0
        some.append((item, words))
        size += len(words)
    if some:
        yield some


def _passes(items):
    """Groups of shards of PASS_WORDS words at most."""
    group, size = [], 0
    for shard in _shards(items):
        n = sum(len(w) for _, w in shard)
        if group and size + n > PASS_WORDS:
            yield group
            group, size = [], 0
        group.append(shard)
        size += n
    yield group


SPAN = pa.list_(pa.int32())


def find_contamination(df: DataFrame, benchmark: DataFrame, window: int = 13, coverage: float = 0.05, id_col: str = "doc_id",
                       text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``doc_id, n_words, n_hit, items, spans, longest, contaminated, clean`` and the columns in ``keep``, one row for each input row.

    Words are runs of ASCII letters, digits and characters beyond ASCII, A-Z
    lower-cased. A window is ``window`` consecutive words of an item; a shorter
    item that has words is one window. ``spans``: word numbers (start, end,
    start, end ...) of the words inside occurrences of windows; ``items``: ids,
    as sorted strings, of the items whose windows occur (a null id is the empty
    string); ``longest``: longest match in words; ``contaminated``: hits cover
    at least ``coverage`` of the words. ``clean`` is the text without the hit
    spans, for contaminated texts only (else null). Null texts have no words.
    Repeated items count once, repeated documents are judged alike, and an
    empty benchmark hits nothing.
    """
    spark = df.sparkSession
    keep = keep or []
    kind = df.schema[id_col].dataType.simpleString()
    extra = "".join(f", `{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    rows = small_batches(df).select(F.col(id_col).alias("__id"), F.col(text_col).cast("binary").alias("__text"), F.lit(0).alias("__n"),
                     F.array().cast("array<int>").alias("__spans"), F.array().cast("array<string>").alias("__items"), F.lit(0).alias("__longest"), *keep)
    source = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")), F.col(item_text_col).cast("string")).dropDuplicates()
    read = ((r[0], words) for r in source.toLocalIterator() if (words := normalised(r[1])))
    schema = f"__id {kind}, __text binary, __n int, __spans array<int>, __items array<string>, __longest int{extra}"
    for i, group in enumerate(_passes(read)):
        held = spark.sparkContext.broadcast(group)
        rows = _pass(rows if not i else stored(rows), held, window, keep, schema)
    return _finished(rows, coverage, keep, kind, extra)


def _pass(rows: DataFrame, held, window: int, keep: list[str], schema: str) -> DataFrame:
    def match(batches):
        matcher = Matcher([(Automaton(s, window), s) for s in held.value])
        for batch in parts(batches):
            texts = batch.column("__text").to_pylist()
            n_words = np.zeros(len(texts), np.int64)
            old = {i: (s, it, n) for i, (s, it, n) in enumerate(zip(batch.column("__spans").to_pylist(), batch.column("__items").to_pylist(),
                                                                    batch.column("__longest").to_pylist()))}
            for at in _chunks(texts):
                data = b" ".join(texts[i] or b"" for i in at) + b" "
                low, start, end = words_of(data)
                edge = np.concatenate(([0], np.cumsum([len(texts[i] or b"") + 1 for i in at])))
                first = np.searchsorted(start, edge)                   # the first word of each text
                n_words[at] = np.diff(first)
                for a, b in zip(*(x.tolist() for x in matcher.stretches(low, start, end, first[:-1]))):
                    j = int(np.searchsorted(first, a, "right")) - 1
                    ws = [low[p:q].tobytes() for p, q in zip(start[a:b].tolist(), end[a:b].tolist())]
                    for automaton in matcher.automata:
                        found, items, longest = automaton.walk(ws)
                        if longest:
                            s, it, n = old[at[j]]
                            off = a - int(first[j])
                            old[at[j]] = ([*s, *(x + off for f in found for x in f)], [*it, *items], max(n, longest))
            for i, (s, it, n) in old.items():
                if s:
                    pair = sorted(zip(s[0::2], s[1::2]))
                    merged = [list(pair[0])]
                    for p, q in pair[1:]:
                        if p <= merged[-1][1]:
                            merged[-1][1] = max(q, merged[-1][1])
                        else:
                            merged.append([p, q])
                    old[i] = ([x for f in merged for x in f], sorted(set(it)), n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id"), batch.column("__text"), pa.array(n_words, pa.int32()), pa.array([old[i][0] for i in range(len(texts))], SPAN),
                 pa.array([old[i][1] for i in range(len(texts))], pa.list_(pa.string())), pa.array([old[i][2] for i in range(len(texts))], pa.int32()),
                 *(batch.column(c) for c in keep)], names=["__id", "__text", "__n", "__spans", "__items", "__longest", *keep])

    return rows.mapInArrow(match, schema)


def _finished(rows: DataFrame, coverage: float, keep: list[str], kind: str, extra: str) -> DataFrame:
    def cut(batches):
        for batch in parts(batches):
            texts, n_words, all_spans = batch.column("__text").to_pylist(), batch.column("__n").to_pylist(), batch.column("__spans").to_pylist()
            n_hit, bad, clean = [], [], []
            for t, n, s in zip(texts, n_words, all_spans):
                hit = sum(s[1::2]) - sum(s[0::2])
                n_hit.append(hit)
                bad.append(hit > 0 and hit >= coverage * n - 1e-9)
                left = None
                if bad[-1]:
                    _, start, end = words_of(t)
                    pieces, at = [], 0
                    for a, b in zip(s[0::2], s[1::2]):
                        pieces.append(t[at:start[a]])
                        at = end[b - 1]
                    left = b"".join([*pieces, t[at:]])
                clean.append(left)
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id"), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), batch.column("__items"), batch.column("__spans"),
                 batch.column("__longest"), pa.array(bad, pa.bool_()), pa.array(clean, pa.binary()).cast(pa.string()), *(batch.column(c) for c in keep)],
                names=["doc_id", "n_words", "n_hit", "items", "spans", "longest", "contaminated", "clean", *keep])

    return rows.mapInArrow(cut, f"doc_id {kind}, n_words long, n_hit long, items array<string>, spans array<int>, longest int, "
                                f"contaminated boolean, clean string{extra}")

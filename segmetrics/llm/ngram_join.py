"""N-gram Jaccard join: rare-first prefixes with length, positional and suffix filters.

1. Every text becomes its set of word n-grams (64-bit hashes). Texts with equal
   sets are one *node*, named by the hash of the set.
2. N-grams are counted over all texts. Chunks of texts send their n-grams to
   shards by hash; an n-gram that many texts of a chunk hold is sent once with
   its count, the list of its texts stays with the chunk. The shards return the
   n-grams of two texts at least, with their frequency, to the chunks.
3. A node orders its n-grams by (frequency, hash). A partner at similarity
   ``t`` shares one of the first ``n - ceil(t n) + 1``; n-grams without a
   second text cannot be shared, so a node whose prefix has no others is done.
4. Nodes meet at shared prefix n-grams. First each node goes to its two most
   crowded ones, where blocks of nodes are compared by a matrix product, which
   joins groups of near copies without emitting their pairs. Then the prefix
   n-grams that still hold nodes of different groups give the pairs that pass
   the filters; each distinct pair is verified once.
5. Joined blocks and links give the components, by label propagation.
"""

from __future__ import annotations

from fractions import Fraction
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmetrics.llm.common import SpanHasher, mix64, parts, release, small_batches, spans, stored

CHUNK_BYTES = 4 << 20
CHUNK_DOCS = 20_000
HASH_BYTES = 1 << 20         # of text that is hashed at once
LOCAL_HOT = 64               # texts of a chunk with an n-gram, above which it is sent once
SHARD_GRAMS = 1 << 20
BLOCK = 300                  # nodes compared by one matrix product
PARTS = 32                   # of the suffix filter
HOT = 0xFFFF

_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_WORD = np.ones(256, bool)
_WORD[[0x20, 9, 10, 11, 12, 13]] = False
_POWERS = [np.uint64(pow(0xA0761D6478BD642F, k + 1, 2**64)) for k in range(64)]


def _combined(words: list[np.ndarray]) -> np.ndarray:
    """Hashes of word sequences from the hashes of their words."""
    with np.errstate(over="ignore"):
        total = np.full(len(words[0]), len(words), np.uint64)
        for c, p in zip(_POWERS, words):
            total = total + p * c
        return mix64(total)


def shingle_sets(texts: list[bytes | None], size: int, hasher: SpanHasher) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text; of a text with fewer words, its whole sequence."""
    if sum(len(t or b"") for t in texts) > HASH_BYTES and len(texts) > 1:
        half = len(texts) // 2
        return shingle_sets(texts[:half], size, hasher) + shingle_sets(texts[half:], size, hasher)
    data = b" ".join(t or b"" for t in texts) + b" "
    raw = np.frombuffer(data, np.uint8)
    start, end = spans(_WORD[raw])
    h = hasher(_LOW[raw], start, end)
    edge = np.concatenate(([0], np.cumsum([len(t or b"") + 1 for t in texts])))
    first = np.searchsorted(start, edge).tolist()
    grams = _combined([h[k:len(h) - size + 1 + k] for k in range(size)]) if len(h) >= size else np.zeros(0, np.uint64)
    out = []
    for a, b in zip(first, first[1:]):
        if b - a >= size:
            out.append(np.unique(grams[a:b - size + 1]))
        elif b > a:
            out.append(_combined([h[k:k + 1] for k in range(a, b)]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def node_of(grams: np.ndarray) -> int:
    """Name of a set: a hash of its members, as a signed 64-bit integer."""
    with np.errstate(over="ignore"):
        s = mix64(grams).sum(dtype=np.uint64) ^ np.uint64(len(grams) * 0x9E3779B97F4A7C15 % 2**64)
    return int(mix64(np.array([s], np.uint64)).view(np.int64)[0])


def _chunks(batches, column: int):
    """Lists of ``(first column, text)`` of about CHUNK_BYTES of text."""
    at, size = [], 0
    for batch in parts(batches):
        for i, t in zip(batch.column(0).to_pylist(), batch.column(column).to_pylist()):
            at.append((i, t))
            size += len(t or b"")
            if size >= CHUNK_BYTES or len(at) >= CHUNK_DOCS:
                yield at
                at, size = [], 0
    if at:
        yield at


def _features(rows: DataFrame, size: int, kind: str) -> DataFrame:
    """``doc_id, n, node``"""
    def run(batches):
        hasher = SpanHasher()
        for some in _chunks(batches, 1):
            sets = shingle_sets([t for _, t in some], size, hasher)
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in some], KINDS.get(kind)), pa.array([len(s) for s in sets], pa.int64()),
                                              pa.array([node_of(s) for s in sets], pa.int64())], names=["doc_id", "n", "node"])

    return rows.mapInArrow(run, f"doc_id {kind}, n long, node long")


KINDS = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "smallint": pa.int16()}


def low_bytes(bits: int) -> int:
    """Bytes of a hash that travel: the top ``bits`` bits are the shard's number."""
    return 6 if bits <= 16 else 5


def cut(keys: np.ndarray, bits: int) -> np.ndarray:
    """The bits of hashes that a shard's number and the bytes that travel keep."""
    return keys & np.uint64((2**64 - 2 ** (64 - bits)) | (2 ** (8 * low_bytes(bits)) - 1))


def _pack(keys: np.ndarray, n: int) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n]).tobytes()


def _unpack(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((len(data) // n, 8), np.uint8)
    out[:, :n] = np.frombuffer(data, np.uint8).reshape(-1, n)
    return out.reshape(-1).view("<u8")


def _pack_counts(counts: np.ndarray) -> bytes:
    """16 bits each, or 32 bits and one more byte where a count needs them."""
    return counts.astype(np.uint16).tobytes() if counts.max(initial=0) <= 0xFFFF else counts.astype(np.uint32).tobytes() + b"w"


def _unpack_counts(data: bytes) -> np.ndarray:
    return np.frombuffer(data[:-1], np.uint32) if len(data) % 2 else np.frombuffer(data, np.uint16)


SENT = "g long, chunk long, a binary, b binary, c binary, d binary, kind int"
GRAMS, TABLE = 0, 1


def _sent(rows: DataFrame, size: int, bits: int) -> DataFrame:
    """For each chunk and shard a row of n-grams; for each chunk a table of its nodes and of the texts of its frequent n-grams."""
    low = low_bytes(bits)

    def run(batches):
        hasher, part, number = SpanHasher(), TaskContext.get().partitionId(), 0
        for some in _chunks(batches, 0):
            nodes: dict[int, np.ndarray] = {}
            for s in shingle_sets([t for t, _ in some], size, hasher):
                if len(s):
                    nodes.setdefault(node_of(s), s)
            if not nodes:
                continue
            names = np.array(list(nodes), np.int64)
            number += 1
            chunk = int.from_bytes(blake2b(names.tobytes() + f"{part}/{number}".encode(), digest_size=8).digest(), "little", signed=True)
            n = np.array([len(s) for s in nodes.values()], np.uint32)
            grams, owner = np.concatenate(list(nodes.values())), np.repeat(np.arange(len(n)), n).astype(np.uint16)
            order = np.argsort(grams, kind="stable")                       # by shard, n-gram, text
            grams, owner = grams[order], owner[order]
            head = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
            times = np.diff(np.append(head, len(grams)))
            crowded = times > LOCAL_HOT
            hot_keys, hot_times = grams[head[crowded]], times[crowded].astype(np.uint32)
            cold = ~np.repeat(crowded, times)
            hot_owner = owner[~cold]
            grams, owner = grams[cold], owner[cold]
            table = [(chunk, names.tobytes(), n.tobytes(), hot_keys.tobytes() + hot_times.astype("<u8").tobytes(), hot_owner.tobytes())]
            yield _batch([(chunk % (1 << bits), *t, TABLE) for t in table])
            shard, hot_shard = grams >> np.uint64(64 - bits), hot_keys >> np.uint64(64 - bits)
            out = []
            for g in np.unique(np.concatenate((shard, hot_shard))):
                a, b = np.searchsorted(shard, g, "left"), np.searchsorted(shard, g, "right")
                p, q = np.searchsorted(hot_shard, g, "left"), np.searchsorted(hot_shard, g, "right")
                o = np.argsort(owner[a:b], kind="stable")
                counts = _pack_counts(np.bincount(owner[a:b], minlength=len(n)))
                out.append((int(g), chunk, _pack(grams[a:b][o], low), counts, _pack(hot_keys[p:q], low), hot_times[p:q].tobytes(), GRAMS))
            yield _batch(out)

    return rows.mapInArrow(run, SENT)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    g, chunk, a, b, c, d, kind = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(chunk, pa.int64()), *(pa.array(x, pa.binary()) for x in (a, b, c, d)),
                                       pa.array(kind, pa.int32())], names=["g", "chunk", "a", "b", "c", "d", "kind"])


def _counted(sent: DataFrame, bits: int) -> DataFrame:
    """What the shards return to the chunks: n-grams, frequencies and texts of the n-grams that occur twice; tables pass through."""
    low = low_bytes(bits)

    def run(key, pdf):
        import pandas as pd

        out = [tuple(r) for r in pdf.loc[pdf["kind"] == TABLE, ["chunk", "a", "b", "c", "d", "kind"]].itertuples(index=False)]
        rows = pdf[pdf["kind"] == GRAMS]
        keys, owner, chunk, weight = [], [], [], []
        for i, r in enumerate(rows.itertuples(index=False)):
            counts = _unpack_counts(r.b)
            k, h = _unpack(r.a, low), _unpack(r.c, low)
            keys += [k, h]
            owner += [np.repeat(np.arange(len(counts), dtype=np.uint16), counts), np.full(len(h), HOT, np.uint16)]
            weight += [np.ones(len(k), np.uint32), np.frombuffer(r.d, np.uint32)]
            chunk.append(np.full(len(k) + len(h), i, np.int32))
        if keys:
            keys, owner, chunk, weight = map(np.concatenate, (keys, owner, chunk, weight))
            order = np.argsort(keys, kind="stable")
            head = np.flatnonzero(np.concatenate(([True], keys[order][1:] != keys[order][:-1]))) if len(keys) else np.zeros(0, np.int64)
            df = np.add.reduceat(weight[order].astype(np.int64), head) if len(head) else np.zeros(0, np.int64)
            each = np.empty(len(keys), np.int64)
            each[order] = np.repeat(df, np.diff(np.append(head, len(keys))))
            full = keys | (np.uint64(int(key[0])) << np.uint64(64 - bits))
            for i, r in enumerate(rows.itertuples(index=False)):
                a, b = np.searchsorted(chunk, i, "left"), np.searchsorted(chunk, i, "right")     # the rows stand in order
                at = a + np.flatnonzero(each[a:b] >= 2)
                if len(at):
                    out.append((r.chunk, full[at].tobytes(), np.minimum(each[at], 0xFFFFFFFF).astype(np.uint32).tobytes(), owner[at].tobytes(), b"", GRAMS))
        keys = owner = chunk = weight = None
        release()
        return pd.DataFrame(out, columns=["chunk", "a", "b", "c", "d", "kind"])

    return sent.groupBy("g").applyInPandas(run, "chunk long, a binary, b binary, c binary, d binary, kind int")


def prefix_size(n, t: Fraction):
    """How many of a set's n n-grams, in the global order, hold one of any partner's."""
    return n - (t.numerator * n + t.denominator - 1) // t.denominator + 1


NODE = "node long, n long, u long, grams binary"


def _nodes(counted: DataFrame, bits: int, t: Fraction) -> DataFrame:
    """``node, n, u, grams``: nodes that may have a partner; ``grams``: their shared n-grams, rare first, after ``u`` n-grams that nobody shares."""
    def run(key, pdf):
        import pandas as pd

        table = pdf[pdf["kind"] == TABLE].iloc[0]
        names, n = np.frombuffer(table["a"], np.int64), np.frombuffer(table["b"], np.uint32).astype(np.int64)
        half = len(table["c"]) // 2
        hot_keys, hot_times = np.frombuffer(table["c"][:half], np.uint64), np.frombuffer(table["c"][half:], "<u8").astype(np.int64)
        hot_owner, hot_start = np.frombuffer(table["d"], np.uint16), np.cumsum(hot_times) - hot_times
        rows = pdf[pdf["kind"] == GRAMS]
        out = []
        if len(rows):
            keys = np.concatenate([np.frombuffer(x, np.uint64) for x in rows["a"]])
            df = np.concatenate([np.frombuffer(x, np.uint32) for x in rows["b"]])
            owner = np.concatenate([np.frombuffer(x, np.uint16) for x in rows["c"]])
            hot = np.flatnonzero(owner == HOT)
            if len(hot):
                order = np.argsort(cut(hot_keys, bits), kind="stable")
                at = order[np.searchsorted(cut(hot_keys, bits)[order], keys[hot])]
                more = [hot_owner[hot_start[j]:hot_start[j] + hot_times[j]] for j in at]
                size = hot_times[at]
                keys = np.concatenate((np.delete(keys, hot), np.repeat(keys[hot], size)))
                df = np.concatenate((np.delete(df, hot), np.repeat(df[hot], size)))
                owner = np.concatenate((np.delete(owner, hot), *more))
            order = np.lexsort((keys, df, owner))
            keys, owner = keys[order], owner[order]
            edge = np.searchsorted(owner, np.arange(len(n) + 1))
            shared = np.diff(edge)
            unique = n - shared
            for i in np.flatnonzero(unique < prefix_size(n, t)):
                out.append((names[i], n[i], unique[i], keys[edge[i]:edge[i + 1]].tobytes()))
        keys = df = owner = None
        release()
        return pd.DataFrame(out, columns=["node", "n", "u", "grams"])

    return counted.groupBy("chunk").applyInPandas(run, NODE).dropDuplicates(["node"])


def histogram(grams: np.ndarray) -> np.ndarray:
    """N-grams in each of PARTS parts of the hash range, up to 255."""
    return np.minimum(np.bincount((grams & np.uint64(PARTS - 1)).astype(np.int64), minlength=PARTS), 255).astype(np.uint8)


POSTING = "gram long, node long, n long, pos long"


def _postings(nodes: DataFrame, t: Fraction) -> DataFrame:
    """``gram, node, n, pos`` for each shared n-gram of each node's prefix; ``pos``: its place among the node's n-grams."""
    def run(batches):
        for batch in parts(batches):
            out = {k: [np.zeros(0, np.int64)] for k in ("gram", "node", "n", "pos")}
            for node, n, u, data in zip(*(batch.column(i).to_pylist() for i in range(4))):
                grams = np.frombuffer(data, np.uint64)
                m = min(len(grams), prefix_size(n, t) - u)
                out["gram"].append(grams[:m].view(np.int64))
                out["pos"].append(np.arange(u, u + m))
                out["node"].append(np.full(m, node))
                out["n"].append(np.full(m, n))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in out.values()], names=list(out))

    return nodes.select("node", "n", "u", "grams").mapInArrow(run, POSTING)


def _histograms(nodes: DataFrame) -> DataFrame:
    def run(batches):
        for batch in parts(batches):
            hist = [histogram(np.frombuffer(x, np.uint64)).tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hist, pa.binary())], names=["node", "hist"])

    return nodes.select("node", "grams").mapInArrow(run, "node long, hist binary")


def components_of_block(sets: list[np.ndarray], n: np.ndarray, t: Fraction) -> np.ndarray:
    """Label of each set in the graph of links, all intersections taken by matrix products."""
    k = len(sets)
    keys, owner = np.concatenate(sets), np.repeat(np.arange(k), [len(s) for s in sets])
    _, column, times = np.unique(keys, return_inverse=True, return_counts=True)
    keep = times[column] >= 2
    rank = np.cumsum(times >= 2) - 1
    column, owner, width = rank[column[keep]], owner[keep], int((times >= 2).sum())
    both = np.zeros((k, k), np.float32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for lo in range(0, width, 4096):
        a, b = np.searchsorted(column, lo), np.searchsorted(column, lo + 4096)
        x = np.zeros((k, min(4096, width - lo)), np.float32)
        x[owner[a:b], column[a:b] - lo] = 1
        both += x @ x.T
    inter = both.astype(np.int64)
    linked = t.denominator * inter >= t.numerator * (n[:, None] + n[None, :] - inter)
    label = np.arange(k)
    while True:
        new = np.where(linked, label[None, :], k).min(1)
        new = np.minimum(new, label)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _joined(nodes: DataFrame, homes: DataFrame, groups: int, t: Fraction) -> DataFrame:
    """``x, y``: each node and the least node that it is joined with at a home n-gram, within blocks of BLOCK nodes."""
    crowd = homes.groupBy("turn", "home").agg(F.count("*").alias("size")).filter("size > 1")
    placed = (homes.join(crowd, ["turn", "home"]).withColumn("block", F.pmod(F.xxhash64("node", "turn"), F.ceil(F.col("size") / BLOCK)))
              .select("node", "turn", "home", "block", F.pmod(F.xxhash64("turn", "home", "block"), F.lit(groups)).alias("g")))

    def run(key, pdf):
        import pandas as pd

        out = [pd.DataFrame({"x": np.zeros(0, np.int64), "y": np.zeros(0, np.int64)})]
        for _, part in pdf.groupby(["turn", "home", "block"], sort=False):
            part = part.sort_values("node")
            names = part["node"].to_numpy()
            label = components_of_block([np.frombuffer(x, np.uint64) for x in part["grams"]], part["n"].to_numpy(), t)
            at = np.flatnonzero(label != np.arange(len(names)))
            out.append(pd.DataFrame({"x": names[at], "y": names[label[at]]}))
        return pd.concat(out)

    return nodes.select("node", "n", "grams").join(placed, "node").groupBy("g").applyInPandas(run, "x long, y long")


def _pairs(live: DataFrame, groups: int, t: Fraction) -> DataFrame:
    """``x, y``: distinct pairs of nodes of different labels that share a prefix n-gram and pass the filters."""
    num, den = t.numerator, t.denominator

    def run(key, pdf):
        import pandas as pd

        pdf = pdf.sort_values(["gram", "node"])
        gram, node, n, pos, leader = (pdf[c].to_numpy() for c in ("gram", "node", "n", "pos", "label"))
        hist = np.frombuffer(b"".join(pdf["hist"]), np.uint8).reshape(-1, PARTS)
        head = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
        found = [np.zeros((0, 2), np.int64)]
        for a, b in zip(head, np.append(head[1:], len(gram))):
            names, at = np.unique(leader[a:b], return_inverse=True)
            if len(names) < 2:
                continue
            usual = np.bincount(at).argmax()
            for i in np.flatnonzero(at != usual):                     # every pair of two leaders has one that is not the usual one
                other = np.flatnonzero((at != at[i]) & ((at == usual) | (np.arange(b - a) > i)))
                if not len(other):
                    continue
                i, other = a + i, a + other
                need = -(-num * (n[i] + n[other]) // (num + den))     # least intersection
                ok = (num * np.maximum(n[i], n[other]) <= den * np.minimum(n[i], n[other])) & (
                    np.minimum(n[i] - pos[i], n[other] - pos[other]) >= need)
                other, need = other[ok], need[ok]
                least = np.minimum(hist[i], hist[other]).sum(1, dtype=np.int64)
                full = (hist[i] == 255).any() | (hist[other] == 255).any(1)
                other = other[full | (least >= need)]
                found.append(np.stack((np.minimum(node[i], node[other]), np.maximum(node[i], node[other])), 1))
        return pd.DataFrame(np.unique(np.concatenate(found), axis=0), columns=["x", "y"])

    grouped = live.withColumn("g", F.pmod("gram", F.lit(groups))).groupBy("g")
    return grouped.applyInPandas(run, "x long, y long").dropDuplicates(["x", "y"])


def _verified(pairs: DataFrame, nodes: DataFrame, t: Fraction) -> DataFrame:
    """The pairs whose sets are similar enough."""
    def run(batches):
        for batch in parts(batches):
            x, y, nx, ny, gx, gy = (batch.column(i).to_pylist() for i in range(6))
            ok = []
            for i in range(len(x)):
                inter = len(np.intersect1d(np.frombuffer(gx[i], np.uint64), np.frombuffer(gy[i], np.uint64), assume_unique=True))
                ok.append(t.denominator * inter >= t.numerator * (nx[i] + ny[i] - inter))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["x", "y"]).filter(pa.array(ok, pa.bool_()))

    side = lambda name: nodes.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("grams").alias(f"g_{name}"))
    both = pairs.join(side("x"), "x").join(side("y"), "y").select("x", "y", "n_x", "n_y", "g_x", "g_y")
    return both.mapInArrow(run, "x long, y long")


def connected(edges: DataFrame) -> DataFrame:
    """``v, label``: the least vertex of each vertex's component, by least-neighbour labels and short cuts."""
    both = stored(edges.select(F.col("x").alias("v"), F.col("y").alias("w")).union(edges.select("y", "x")).filter("v <> w").dropDuplicates())
    labels = stored(both.groupBy("v").agg(F.least(F.min("w"), F.col("v")).alias("label")))
    while True:
        near = both.join(labels.withColumnRenamed("v", "w"), "w").groupBy("v").agg(F.min("label").alias("near"))
        new = labels.join(near, "v").select("v", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("v").alias("label"), F.col("label").alias("further"))
        new = stored(new.join(jump, "label", "left").select("v", "old", F.least("label", "further").alias("label")))
        if new.filter("old <> label").isEmpty():
            return new.select("v", "label")
        labels = new.select("v", "label")


def link_documents(df: DataFrame, size: int = 5, similarity: tuple[int, int] = (4, 5), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row for each input row.

    Two rows link when the Jaccard similarity of their n-gram sets is
    ``similarity`` at least; ``component_id`` is the smallest doc_id reachable
    by links (rows of equal sets are linked; ``null`` ids count last). Words
    are runs of characters other than ASCII white space, A-Z lower-cased. A
    text of fewer than ``size`` words has its whole sequence as its one n-gram;
    an empty or null text has none and is linked with nothing. Other columns
    are ignored; an empty table gives no rows.
    """
    t = Fraction(*similarity)
    kind = df.schema[id_col].dataType.simpleString()
    if kind not in KINDS:
        raise ValueError(f"{id_col}: {kind}")
    rows = small_batches(df).select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    features = stored(_features(rows, size, kind))
    total = features.agg(F.sum("n")).first()[0] or 0
    bits = min(24, max(6, (total // SHARD_GRAMS).bit_length()))
    nodes = stored(_nodes(_counted(_sent(rows.select("text"), size, bits), bits), bits, t))
    postings = stored(_postings(nodes, t))
    crowd = postings.groupBy("gram").agg(F.count("*").alias("size")).filter("size > 1")
    live = stored(postings.join(crowd, "gram"))
    groups = max(64, live.count() // 100_000)
    most = F.slice(F.sort_array(F.collect_list(F.struct("size", "gram")), asc=False), 1, 2)               # of a node's prefix
    homes = stored(live.groupBy("node").agg(most.alias("h")).select("node", F.posexplode("h").alias("turn", "h")).select("node", "turn", F.col("h.gram").alias("home")))
    label = connected(_joined(nodes, homes, groups, t))
    live = live.join(label.withColumnRenamed("v", "node"), "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = live.groupBy("gram").agg(F.min("label").alias("a"), F.max("label").alias("b")).filter("a < b").select("gram")
    pairs = _pairs(live.join(mixed, "gram").join(_histograms(nodes), "node"), groups, t)
    links = _verified(stored(pairs), nodes, t)
    for end in ("x", "y"):
        links = links.join(label.select(F.col("v").alias(end), F.col("label").alias(f"l{end}")), end, "left").withColumn(f"l{end}", F.coalesce(f"l{end}", end))
    over = connected(links.select(F.col("lx").alias("x"), F.col("ly").alias("y")))
    label = label.select(F.col("v").alias("node"), F.col("label").alias("mid"))
    over = over.select(F.col("v").alias("mid"), F.col("label").alias("top"))
    first = features.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("first")).join(label, "node", "left")
    first = first.withColumn("mid", F.coalesce("mid", "node")).join(over, "mid", "left").withColumn("label", F.coalesce("top", "mid"))
    least = first.groupBy("label").agg(F.min("first").alias("component_id"))
    named = first.select(F.col("node").alias("named"), "label").join(least, "label").select("named", "component_id", F.lit(True).alias("some"))
    out = features.join(named, (F.col("node") == F.col("named")) & (F.col("n") > 0), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("some"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))

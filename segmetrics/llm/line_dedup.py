"""Line dedup by probing compact arrays behind a sharded minimal perfect hash.

Each task reduces its lines to (line hash, document) pairs, at most ``min_docs``
per hash, so a line that every document holds sends a few rows per batch. The
hashes found in enough documents are dealt into shards; each shard becomes a
minimal perfect hash with a fingerprint, a count and a last-document array.
Documents probe these arrays. While all shards together stay below
``PROBE_BYTES`` every task holds them; beyond that the line hashes travel to
the shards and only the dropped ones travel back.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmetrics.llm.common import mix64, parts, small_batches, stored

WHITE = b" \t\n\x0b\x0c\r"
SHARD_KEYS = 500_000
PROBE_BYTES = 48 << 20
NO_ID = -(1 << 63)          # stands for a null doc_id, below every other


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: levels of bits, each key at the first level where it is alone."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.rank = np.cumsum(bits, dtype=np.int64) - 1

    @staticmethod
    def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mix64(keys + np.uint64(0xD1B54A32D192ED03) * np.uint64(level + 1)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        sizes, bits, left = [], [], keys
        while len(left):
            size = max(8, 2 * len(left))
            at = cls.place(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            left = left[~alone[at]]
            if len(sizes) > 200:
                raise ValueError("keys are not distinct")
        return cls(sizes, np.concatenate(bits) if bits else np.zeros(0, bool))

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The key's number; for other keys any number, or -1."""
        out = np.full(len(keys), -1, np.int64)
        left, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = self.place(keys[left], level, size) + base
            hit = self.bits[at]
            out[left[hit]] = self.rank[at[hit]]
            left, base = left[~hit], base + size
        return out


class Shard:
    """Arrays of one shard: 64-bit fingerprints, counts (up to 255) and last documents, by perfect-hash number."""

    def __init__(self, hasher: PerfectHash, prints: np.ndarray, counts: np.ndarray, last: np.ndarray):
        self.hasher, self.prints, self.counts, self.last = hasher, prints, counts, last

    @classmethod
    def build(cls, keys, prints, counts, last) -> "Shard":
        hasher = PerfectHash.build(keys)
        order = np.empty(len(keys), np.int64)
        order[hasher.index(keys)] = np.arange(len(keys))
        return cls(hasher, prints[order], np.minimum(counts[order], 255).astype(np.uint8), last[order])

    def pack(self) -> dict[str, bytes]:
        return {"sizes": np.asarray(self.hasher.sizes, "<i8").tobytes(), "bits": np.packbits(self.hasher.bits).tobytes(),
                "prints": self.prints.astype("<u8").tobytes(), "counts": self.counts.tobytes(), "last": self.last.astype("<i8").tobytes()}

    @classmethod
    def unpack(cls, row) -> "Shard":
        sizes = np.frombuffer(row["sizes"], "<i8").tolist()
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(sizes)).astype(bool)
        return cls(PerfectHash(sizes, bits), np.frombuffer(row["prints"], "<u8"), np.frombuffer(row["counts"], np.uint8),
                   np.frombuffer(row["last"], "<i8"))

    def probe(self, keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count (0 for a line that the shard lacks) and last document of each line."""
        at = self.hasher.index(keys)
        at[at >= len(self.prints)] = -1
        hit = at >= 0
        hit[hit] = self.prints[at[hit]] == prints[hit]
        return np.where(hit, self.counts[at] if len(self.counts) else 0, 0), np.where(hit, self.last[at] if len(self.last) else 0, 0)


def line_keys(lines: list[bytes], min_chars: int) -> list[bytes | None]:
    """128-bit hash of each line's key, None for keys that are too short."""
    out = []
    for line in lines:
        k = line.strip(WHITE).lower()
        long = len(k) >= min_chars and (len(k) >= 4 * min_chars or len(k.decode("utf-8", "replace")) >= min_chars)
        out.append(blake2b(k, digest_size=16).digest() if long else None)
    return out


def _hashed(texts: list[bytes | None], min_chars: int):
    """Lines of each text; then of the long enough lines: text number, line number, key and fingerprint."""
    split = [(t or b"").split(b"\n") for t in texts]
    doc, line, digest = [], [], []
    for i, lines in enumerate(split):
        for j, k in enumerate(line_keys(lines, min_chars)):
            if k is not None:
                doc.append(i)
                line.append(j)
                digest.append(k)
    pair = np.frombuffer(b"".join(digest), "<u8").reshape(-1, 2)
    return split, np.asarray(doc, np.int64), np.asarray(line, np.int64), pair[:, 0].copy(), pair[:, 1].copy()


def _ids(column: pa.Array) -> np.ndarray:
    return np.asarray(column.fill_null(NO_ID).to_numpy(zero_copy_only=False), np.int64)


def repeated_lines(rows: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """``k, p, n, last``: hash and fingerprint of each line of ``min_docs`` documents at least, their number, the largest doc_id."""

    def reduce(batches):
        for batch in parts(batches):
            ids = _ids(batch.column(0))
            _, doc, _, k, p = _hashed(batch.column(1).to_pylist(), min_chars)
            d = ids[doc] if len(doc) else np.zeros(0, np.int64)
            order = np.lexsort((d, p, k))[::-1]                       # of each line the largest doc_ids first
            k, p, d = k[order], p[order], d[order]
            same = np.concatenate(([False], (k[1:] == k[:-1]) & (p[1:] == p[:-1]))) if len(k) else np.zeros(0, bool)
            new = ~same | np.concatenate(([True], d[1:] != d[:-1]))[:len(k)]
            k, p, d, same = k[new], p[new], d[new], same[new]
            first = np.flatnonzero(~same)
            nth = np.arange(len(k)) - np.repeat(first, np.diff(np.append(first, len(k))))
            few = nth < min_docs
            yield pa.RecordBatch.from_arrays([pa.array(k[few].view(np.int64)), pa.array(p[few].view(np.int64)), pa.array(d[few])], names=["k", "p", "d"])

    pairs = rows.select("doc_id", "text").mapInArrow(reduce, "k long, p long, d long")
    return (pairs.groupBy("k", "p").agg(F.count_distinct("d").alias("n"), F.max("d").alias("last"))
            .filter(F.col("n") >= min_docs))


def build_shards(repeated: DataFrame, n_shards: int) -> DataFrame:
    def build(key, pdf):
        import pandas as pd

        pdf = pdf.drop_duplicates("k")
        shard = Shard.build(pdf["k"].to_numpy().view(np.uint64), pdf["p"].to_numpy().view(np.uint64), pdf["n"].to_numpy(), pdf["last"].to_numpy())
        return pd.DataFrame([{"shard": int(key[0]), **shard.pack()}])

    return repeated.withColumn("shard", F.pmod("k", F.lit(n_shards)).cast("int")).groupBy("shard").applyInPandas(
        build, "shard int, sizes binary, bits binary, prints binary, counts binary, last binary")


def dedup_lines(df: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text",
                keep: list[str] | None = None, probe_bytes: int = PROBE_BYTES) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped`` and the columns in ``keep``, one row for each input row.

    A line's key is the line without white space at its ends, A-Z lower-cased.
    Keys of ``min_chars`` code points found under ``min_docs`` doc_ids lose all
    lines except under the largest doc_id that holds them. Rows that share a
    doc_id count as one document; null doc_ids count as one document below all
    others. A null or empty text is one empty line. An empty table gives no rows.
    """
    spark = df.sparkSession
    keep = keep or []
    kind = df.schema[id_col].dataType.simpleString()
    rows = small_batches(df).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), *keep)
    lines = stored(repeated_lines(rows, min_chars, min_docs))
    n_shards = max(1, -(-lines.count() // SHARD_KEYS))
    shards = stored(build_shards(lines, n_shards))
    size = shards.select(F.sum(sum((F.octet_length(c) for c in ("bits", "prints", "counts", "last")), F.lit(0)))).first()[0] or 0
    schema = "doc_id long, text string, n_lines long, n_dropped long" + "".join(f", `{c}` {df.schema[c].dataType.simpleString()}" for c in keep)

    def rebuilt(batch, split, doc, line, drop):
        out, n = [], np.bincount(doc[drop], minlength=len(split)) if len(doc) else np.zeros(len(split), np.int64)
        gone: dict[int, set] = {}
        for i, j in zip(doc[drop].tolist(), line[drop].tolist()):
            gone.setdefault(i, set()).add(j)
        for i, ls in enumerate(split):
            out.append(b"\n".join(x for j, x in enumerate(ls) if j not in gone[i]) if i in gone else b"\n".join(ls))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(out, pa.binary()).cast(pa.string()), pa.array([len(x) for x in split], pa.int64()), pa.array(n, pa.int64()),
             *(batch.column(c) for c in keep)], names=["doc_id", "text", "n_lines", "n_dropped", *keep])

    if size <= probe_bytes:
        held = spark.sparkContext.broadcast([r.asDict() for r in shards.collect()])          # at most probe_bytes

        def probe(batches):
            loaded = {r["shard"]: Shard.unpack(r) for r in held.value}
            for batch in parts(batches):
                ids = _ids(batch.column(0))
                split, doc, line, k, p = _hashed(batch.column(1).to_pylist(), min_chars)
                drop = np.zeros(len(k), bool)
                to = np.mod(k.view(np.int64), n_shards)
                for s, shard in loaded.items():
                    at = np.flatnonzero(to == s)
                    count, last = shard.probe(k[at], p[at])
                    drop[at] = (count >= min(min_docs, 255)) & (last != ids[doc[at]])
                yield rebuilt(batch, split, doc, line, drop)

        out = rows.mapInArrow(probe, schema)
    else:
        out = _probe_by_shard(rows, shards, schema, min_chars, min_docs, n_shards, keep, rebuilt)
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def _probe_by_shard(rows, shards, schema, min_chars, min_docs, n_shards, keep, rebuilt):
    """The same decisions where the arrays are too large for every task: line hashes go to their shard, dropped ones come back by document."""

    def sent(batches):
        for batch in parts(batches):
            ids = _ids(batch.column(0))
            _, doc, _, k, p = _hashed(batch.column(1).to_pylist(), min_chars)
            to = np.mod(k.view(np.int64), n_shards)
            order = np.argsort(to, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(to[order])) + 1) if len(order) else []:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(to[at[0]])], pa.int32()), pa.array([k[at].tobytes()], pa.binary()), pa.array([p[at].tobytes()], pa.binary()),
                     pa.array([ids[doc[at]].tobytes()], pa.binary())], names=["shard", "k", "p", "d"])

    def probe(key, lines, arrays):
        import pandas as pd

        out = [pd.DataFrame({"d": np.zeros(0, np.int64), "k": np.zeros(0, np.int64), "p": np.zeros(0, np.int64)})]
        shard = Shard.unpack(arrays.iloc[0]) if len(arrays) else None
        for kb, pb, db in zip(lines["k"], lines["p"], lines["d"]) if shard else []:
            k, p, d = np.frombuffer(kb, "<u8"), np.frombuffer(pb, "<u8"), np.frombuffer(db, "<i8")
            count, last = shard.probe(k, p)
            at = (count >= min(min_docs, 255)) & (last != d)
            out.append(pd.DataFrame({"d": d[at], "k": k[at].view(np.int64), "p": p[at].view(np.int64)}).drop_duplicates())
        return pd.concat(out)

    lines = rows.select("doc_id", "text").mapInArrow(sent, "shard int, k binary, p binary, d binary")
    dropped = (lines.groupBy("shard").cogroup(shards.groupBy("shard")).applyInPandas(probe, "d long, k long, p long")
               .groupBy("d").agg(F.collect_set(F.struct("k", "p")).alias("gone")))
    marked = rows.withColumn("d", F.coalesce("doc_id", F.lit(NO_ID))).join(dropped, "d", "left").select(
        "doc_id", "text", *keep, F.transform("gone", lambda x: x.k).alias("__k"), F.transform("gone", lambda x: x.p).alias("__p"))

    def remove(batches):
        for batch in parts(batches):
            split, doc, line, k, p = _hashed(batch.column(1).to_pylist(), min_chars)
            gone = [set(zip(a or [], b or [])) for a, b in zip(batch.column("__k").to_pylist(), batch.column("__p").to_pylist())]
            drop = np.fromiter(((a, b) in gone[i] for i, a, b in zip(doc.tolist(), k.view(np.int64).tolist(), p.view(np.int64).tolist())), bool, len(k))
            yield rebuilt(batch, split, doc, line, drop)

    return marked.mapInArrow(remove, schema)

"""BPE encoding and decoding by forced-boundary splitting.

Byte pairs that no vocabulary token holds mark certain cuts: no merge can cross
them. The fragments between cuts are encoded alone, each distinct one once per
worker, and their ids are concatenated.

A cut is only taken where the pre-tokenizer's pattern cannot see across it: the
right side starts a character and is not an apostrophe, and the left side ends
in a character that is surely not white space. Added tokens count as
vocabulary, so their strings are never cut.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmetrics.llm.common import parts, small_batches

CACHE_ENTRIES = 200_000      # fragments kept by a worker, then the cache starts anew
CACHE_BYTES = 256            # longer fragments are encoded each time


def byte_of_symbol() -> dict[str, int]:
    """The byte that each symbol of a byte-level vocabulary stands for."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or (0xA1 <= b and b != 0xAD)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def token_bytes(spec: dict) -> list[bytes]:
    """Bytes of each id."""
    symbol = byte_of_symbol()
    vocab = dict(spec["model"]["vocab"])
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    out = [b""] * (max([*vocab.values(), *added.values()]) + 1)
    for token, i in vocab.items():
        out[i] = bytes(symbol[c] for c in token) if all(c in symbol for c in token) else token.encode()
    for token, i in added.items():
        out[i] = token.encode()
    return out


def cut_table(tokens: list[bytes]) -> np.ndarray:
    """For each pair ``256 * left + right``: may a text be cut between the two bytes?"""
    seen = np.zeros(65536, bool)
    for t in tokens:
        for a, b in zip(t, t[1:]):
            seen[256 * a + b] = True
    left, right = np.divmod(np.arange(65536), 256)
    left_ok = ((left > 0x20) & (left < 0x7F)) | ((left >= 0x80) & (left < 0xC0))
    right_ok = ((right < 0x80) | (right >= 0xC0)) & (right != 0x27)
    return ~seen & left_ok & right_ok


class Codec(dict):
    """Fragment -> its ids as little-endian unsigned 32-bit integers, filled on demand."""

    def __init__(self, spec_json: str):
        from tokenizers import Tokenizer

        spec = json.loads(spec_json)
        spec["truncation"] = spec["padding"] = None
        self.tokenizer = Tokenizer.from_str(json.dumps(spec))
        self.tokens = token_bytes(spec)
        self.cuts = cut_table(self.tokens)
        self.kept = 0

    def __missing__(self, fragment: bytes) -> bytes:
        ids = self.tokenizer.encode(fragment.decode(), add_special_tokens=False).ids
        packed = np.asarray(ids, "<u4").tobytes()
        if len(fragment) <= CACHE_BYTES and self.kept < CACHE_ENTRIES:
            self[fragment] = packed
            self.kept += 1
        return packed

    def positions(self, data: bytes) -> np.ndarray:
        b = np.frombuffer(data, np.uint8)
        if len(b) < 2:
            return np.zeros(0, np.int64)
        at = np.flatnonzero(self.cuts[b[:-1].astype(np.int32) * 256 + b[1:]]) + 1
        if len(at):
            last, before = b[at - 1], b[np.maximum(at - 2, 0)]
            at = at[(last < 0x80) | ((before > 0xC2) & (before < 0xE0))]   # white space beyond ASCII is C2 .. or E1-E3 .. ..
        return at

    def encode(self, text: str) -> bytes:
        data = text.encode()
        if self.kept >= CACHE_ENTRIES:
            self.clear()
            self.kept = 0
        edge = [0, *self.positions(data).tolist(), len(data)]
        return b"".join(map(self.__getitem__, (data[i:j] for i, j in zip(edge, edge[1:]))))

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4").tolist()
        return b"".join(map(self.tokens.__getitem__, ids)).decode("utf-8", "replace")


def encode_decode(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                  keep: list[str] | None = None) -> DataFrame:
    """``doc_id, ids, decoded`` and the columns in ``keep``: ids as little-endian unsigned 32-bit integers, decoded text.

    One row for each input row, in a single scan without a shuffle. A null or
    empty text has no ids and decodes to the empty text. Other columns of the
    input are ignored. ``tokenizer`` is the path of a byte-level BPE file on
    the driver; its content travels with the job.
    """
    with open(tokenizer, encoding="utf-8") as f:
        spec = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        codec = Codec(spec.value)
        for batch in parts(batches):
            ids = [codec.encode(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary()), pa.array(map(codec.decode, ids), pa.string()), *(batch.column(c) for c in keep)],
                names=["doc_id", "ids", "decoded", *keep])

    keep = keep or []
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, ids binary, decoded string" + "".join(f", `{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return small_batches(df).select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"), *keep).mapInArrow(run, schema)

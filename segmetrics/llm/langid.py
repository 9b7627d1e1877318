"""Language ID with a bidirectional gated recurrent network over bytes.

Trained in numpy by backpropagation through time on a bounded sample of
labelled texts; every byte gets a distribution over the languages, and a
document's probabilities are the mean of its bytes' ones. A text is read in
windows of ``WINDOW`` bytes, all of them, many windows in step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmetrics.llm.common import parts, small_batches

HIDDEN = 8
WINDOW = 128
LANES = 2048                      # windows in step
TRAIN_TEXTS = 400                 # labelled texts of each language, about
TRAIN_TOTAL = 64 * TRAIN_TEXTS    # of all languages, which share it evenly where there are more than 64
TRAIN_CHARS = 800                 # code points taken of each
STEPS, BATCH, TRAIN_WINDOW, RATE = 300, 96, 48, 0.02
UNDETERMINED = "und"
LETTER = r"\p{L}"


@dataclass
class Direction:
    """One direction's weights: ``byte`` (256 x 3H) holds the input weights and bias of update, reset and candidate."""

    byte: np.ndarray
    gate: np.ndarray              # 2H x H
    cand: np.ndarray              # H x H


def _step(d: Direction, x: np.ndarray, h: np.ndarray):
    """New state (H x N) after the bytes ``x``, with what the backward pass needs. The gates are piecewise linear sigmoids."""
    n = len(h)
    inp = d.byte[x].T
    gates = np.clip(0.25 * (inp[:2 * n] + d.gate @ h) + 0.5, 0, 1)
    z, r = gates[:n], gates[n:]
    c = np.tanh(inp[2 * n:] + d.cand @ (r * h))
    return h + z * (c - h), (x, h, z, r, c)


class Network:
    def __init__(self, fore: Direction, back: Direction, out: np.ndarray, bias: np.ndarray):
        self.fore, self.back, self.out, self.bias = fore, back, out, bias            # out: K x 2H

    @classmethod
    def start(cls, classes: int, hidden: int = HIDDEN, seed: int = 7) -> "Network":
        g = np.random.default_rng(seed)
        one = lambda: Direction(g.normal(0, 0.3, (256, 3 * hidden)), g.normal(0, 0.3, (2 * hidden, hidden)), g.normal(0, 0.3, (hidden, hidden)))
        return cls(one(), one(), g.normal(0, 0.3, (classes, 2 * hidden)), np.zeros(classes))

    def weights(self) -> list[np.ndarray]:
        return [self.fore.byte, self.fore.gate, self.fore.cand, self.back.byte, self.back.gate, self.back.cand, self.out, self.bias]

    def single(self) -> "Network":
        w = [np.ascontiguousarray(x, np.float32) for x in self.weights()]
        return Network(Direction(*w[:3]), Direction(*w[3:6]), w[6], w[7])

    def states(self, x: np.ndarray):
        """Both directions' states (T x H x N) over the bytes ``x`` (T x N)."""
        t, n = x.shape
        h = self.fore.cand.shape[0]
        out, tapes = [], []
        for d, order in ((self.fore, range(t)), (self.back, range(t - 1, -1, -1))):
            s, all_s, tape = np.zeros((h, n), d.gate.dtype), np.empty((t, h, n), d.gate.dtype), [None] * t
            for i in order:
                s, tape[i] = _step(d, x[i], s)
                all_s[i] = s
            out.append(all_s)
            tapes.append(tape)
        return out, tapes

    def loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross-entropy of every position (all of a lane have label ``y``) and its gradients."""
        t, n = x.shape
        (f, b), tapes = self.states(x)
        s = np.concatenate((f, b), 1)
        p = _softmax(np.matmul(self.out, s) + self.bias[:, None])
        lanes = np.arange(n)
        loss = -np.log(p[:, y, lanes] + 1e-30).mean()
        p[:, y, lanes] -= 1
        p /= t * n
        g_out, g_bias = np.einsum("tkn,thn->kh", p, s), p.sum((0, 2))
        g_s = np.matmul(self.out.T, p)
        h = f.shape[1]
        grads = []
        for d, tape, gs, order in ((self.fore, tapes[0], g_s[:, :h], range(t - 1, -1, -1)), (self.back, tapes[1], g_s[:, h:], range(t))):
            g_byte, g_gate, g_cand, carry = np.zeros_like(d.byte), np.zeros_like(d.gate), np.zeros_like(d.cand), np.zeros((h, n))
            for i in order:
                xi, old, z, r, c = tape[i]
                g = carry + gs[i]
                a_c = g * z * (1 - c * c)
                back = d.cand.T @ a_c
                a_g = 0.25 * np.concatenate((g * (c - old) * ((z > 0) & (z < 1)), back * old * ((r > 0) & (r < 1))))
                carry = g * (1 - z) + back * r + d.gate.T @ a_g
                g_gate += a_g @ old.T
                g_cand += a_c @ (r * old).T
                np.add.at(g_byte, xi, np.concatenate((a_g, a_c)).T)
            grads += [g_byte, g_gate, g_cand]
        return loss, [*grads, g_out, g_bias]

    def position_scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities (T x K x N) of each byte of the lanes ``x`` (T x N)."""
        h = self.fore.cand.shape[0]
        a = np.matmul(self.out[:, :h], _states_only(self.fore, x, range(len(x))))
        a += np.matmul(self.out[:, h:], _states_only(self.back, x, range(len(x) - 1, -1, -1)))
        return _softmax(a + self.bias[:, None])


def _states_only(d: Direction, x: np.ndarray, order) -> np.ndarray:
    """States (T x H x N) as by ``_step``, without what training needs; the gates' slope and offset are taken into the weights."""
    (t, n), h = x.shape, d.cand.shape[0]
    one = d.gate.dtype.type
    byte = d.byte.T.copy()
    byte[:2 * h] = byte[:2 * h] * one(0.25) + one(0.5)
    gate = d.gate * one(0.25)
    out = np.empty((t, h, n), d.gate.dtype)
    old, both, c = np.zeros((h, n), d.gate.dtype), np.empty((2 * h, n), d.gate.dtype), np.empty((h, n), d.gate.dtype)
    for i in order:
        inp = byte.take(x[i], 1)
        np.matmul(gate, old, out=both)
        both += inp[:2 * h]
        np.maximum(both, one(0), out=both)
        np.minimum(both, one(1), out=both)
        np.multiply(both[h:], old, out=out[i])
        np.matmul(d.cand, out[i], out=c)
        c += inp[2 * h:]
        np.tanh(c, out=c)
        c -= old
        c *= both[:h]
        np.add(old, c, out=out[i])
        old = out[i]
    return out


def _softmax(a: np.ndarray) -> np.ndarray:
    e = np.exp(a - a.max(1, keepdims=True))
    e /= e.sum(1, keepdims=True)
    return e


def train(texts: list[bytes], labels: list[int], classes: int, steps: int = STEPS, seed: int = 11) -> Network:
    """Adam over windows drawn from the texts, every language as often."""
    g = np.random.default_rng(seed)
    net = Network.start(classes)
    weights = net.weights()
    m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    by = [[t for t, y in zip(texts, labels) if y == k and len(t)] for k in range(classes)]
    there = [k for k in range(classes) if by[k]]
    for step in range(1, steps + 1 if there else 1):
        y = np.array([there[i % len(there)] for i in range(BATCH)])
        x = np.full((TRAIN_WINDOW, BATCH), 32, np.uint8)
        for i, k in enumerate(y):
            t = by[k][g.integers(len(by[k]))]
            at = g.integers(max(1, len(t) - TRAIN_WINDOW + 1))
            piece = np.frombuffer(t[at:at + TRAIN_WINDOW], np.uint8)
            x[:len(piece), i] = piece
        _, grads = net.loss(x, y)
        rate = RATE * min(1.0, 2 * (steps - step + 1) / steps)
        for w, dw, a, b in zip(weights, grads, m, v):
            a += 0.1 * (dw - a)
            b += 0.001 * (dw * dw - b)
            w -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    return net


def pooled(net: Network, texts: list[bytes]) -> np.ndarray:
    """Mean of the bytes' probabilities of each text (texts x K); zeros for an empty text."""
    k = len(net.bias)
    sums = np.zeros((len(texts), k))
    size = np.array([len(t) for t in texts], np.int64)
    count = -(-size // WINDOW)
    owner = np.repeat(np.arange(len(texts)), count)
    data = np.frombuffer(b"".join(texts) + b" " * WINDOW, np.uint8)
    base = np.repeat(np.cumsum(size) - size, count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    start = base + nth * WINDOW
    length = np.minimum(WINDOW, np.repeat(size, count) - nth * WINDOW)
    order = np.argsort(-length, kind="stable")                   # short windows together: a lane ends where its window ends
    lanes = max(1, min(LANES, 16 * LANES // k))                  # many languages: fewer windows at once
    for lo in range(0, len(order), lanes):
        at = order[lo:lo + lanes]
        t = int(length[at[0]])
        inside = np.arange(t)[:, None] < length[at]
        x = np.where(inside, data[start[at] + np.arange(t)[:, None]], 32)
        p = net.position_scores(x)
        np.add.at(sums, owner[at], np.einsum("tkn,tn->nk", p, inside.astype(p.dtype)))
    return sums / np.maximum(size, 1)[:, None]


def held_out(doc_id: Column) -> Column:
    """The rows that no model is trained on: crc32 of the id as text leaves 1 when divided by 3 (a null id: not held out, not trained on)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[Network, list[str]]:
    """A network trained on about TRAIN_TEXTS texts of each language, TRAIN_CHARS code points of each, and its languages.

    The texts are those with the smallest hashes of their ids among the rows
    that are not held out and have an id, a language and a text with a letter.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    counts = dict(rows.groupBy("lang").count().collect())
    languages = sorted(counts)
    if not languages:
        return Network.start(1).single(), [UNDETERMINED]
    spot = F.xxhash64(F.col("doc_id"))
    each = max(1, min(TRAIN_TEXTS, TRAIN_TOTAL // len(languages)))
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, each / n)))])
    at = F.pmod(spot, F.greatest(F.lit(1), F.length("text") - TRAIN_CHARS + 1)).cast("int") + 1
    picked = (rows.filter(F.pmod(spot, F.lit(1_000_003)) < 1_000_003 * share[F.col("lang")]).filter(F.col("text").rlike(LETTER))
              .select("lang", F.substring("text", at, F.lit(TRAIN_CHARS)).alias("text"), spot.alias("spot"))
              .orderBy("spot", "text").limit(2 * each * len(languages)).collect())
    net = train([r.text.encode() for r in picked], [languages.index(r.lang) for r in picked], len(languages))
    return net.single(), languages


def predict(df: DataFrame, net: Network, languages: list[str], id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``doc_id, lang_pred, score, scores`` and the columns in ``keep``, one row for each input row.

    ``scores``: each language's pooled probability, in the order of
    ``languages``; ``score``: the largest one (ties: the first language). A
    null text or one without a letter is ``und`` with score 0 and no scores.
    """
    keep = keep or []
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in parts(batches):
            texts = [t if letter else None for t, letter in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            p = pooled(net, [(t or "").encode() for t in texts])
            best = p.argmax(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([languages[b] if t is not None else UNDETERMINED for t, b in zip(texts, best)], pa.string()),
                 pa.array([min(1.0, float(p[i, b])) if t is not None else 0.0 for i, (t, b) in enumerate(zip(texts, best))], pa.float64()),
                 pa.array([p[i].tolist() if t is not None else [] for i, t in enumerate(texts)], pa.list_(pa.float64())),
                 *(batch.column(c) for c in keep)], names=["doc_id", "lang_pred", "score", "scores", *keep])

    schema = f"doc_id {kind}, lang_pred string, score double, scores array<double>" + "".join(
        f", `{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return small_batches(df).select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"),
                                   F.col(text_col).cast("string").rlike(LETTER).alias("__letter"), *keep).mapInArrow(run, schema)

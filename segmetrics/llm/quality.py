"""Quality rules as a learned decision list, with DataFrame functions only.

Every text gets statistics by built-in functions of its own row. Sequential
covering learns from the statistics of labelled texts: a rule grows by the
threshold that gains most information about bad texts, condition by condition,
on two thirds of the rows; on the last third the end of the conjunction that
does not help is pruned. A rule that is precise there is kept, the rows that it
covers go, and the next rule is learned from the rest. Each step is one
aggregate over the binned rows: what reaches the driver is a few counts for
each feature and threshold. The list is emitted as one ordered CASE expression.
"""

from __future__ import annotations

import dataclasses
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmetrics.llm.common import stored

BLANKS = " \t\n\x0b\x0c\r"            # what the contract calls white space
WINDOW = 8                           # words of a window that may repeat
FIT_ROWS = 20_000                    # labelled rows (about) that the list is learned from
CUTS = 32                            # quantiles of all rows, and of the bad ones, that serve as thresholds
MAX_CONDITIONS = 3
MAX_RULES = 12
PRECISION = 0.9                      # least share of bad rows among those that a rule covers when pruned
SUPPORT = 5                          # least number of bad rows that it covers then
FEATURES = ("n_words", "mean_word", "symbols_per_word", "marks_per_word", "upper_share", "digit_share", "distinct_share",
            "short_share", "repeat_share", "duplicate_line_share")


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def _kept(text: Column, kept: str) -> Column:
    """Number of the text's characters of a class."""
    return F.length(F.regexp_replace(text, f"[^{kept}]+", "")).cast("long")


def _repeated(words: Column) -> Column:
    """Number of words inside windows of WINDOW words that stand in the text twice or more.

    Windows are compared by a 64-bit hash of their words (10^6 windows in one
    text: a chance of 3 in 10^8 of a false match).
    """
    hashes = F.when(F.size(words) >= WINDOW, F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(
        *[F.get(words, i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<long>"))

    def covered(h):
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twice(s):
            again = F.filter(s, lambda x, j: F.coalesce(x.h == F.get(s, j - 1).h, F.lit(False)) | F.coalesce(x.h == F.get(s, j + 1).h, F.lit(False)))
            return _let(F.sort_array(F.transform(again, lambda x: x.i)), lambda at: F.aggregate(
                F.transform(at, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - x, F.lit(WINDOW)))), F.lit(0).cast("long"), lambda a, b: a + b))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(_let(ordered, twice))
    return _let(hashes, covered)


def statistics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the struct ``stats``: counts of each text (null: empty) and the FEATURES made of them."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    trimmed = F.btrim(text, F.lit(BLANKS))
    words = F.when(F.length(trimmed) > 0, F.split(trimmed, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>"))

    def counts(w):
        lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(BLANKS))) > 0)
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
            _kept(text, "#*$%&|<>").alias("n_symbols"),
            _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("twice"))).alias("lines"),
            _repeated(w).alias("n_repeat_words"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
            F.size(F.filter(w, lambda x: F.length(x) <= 3)).cast("long").alias("n_short"),
            _kept(text, "!?").alias("n_marks"), _kept(text, r"\p{Lu}").alias("n_upper"), _kept(text, "0-9").alias("n_digits"))

    def features(c):
        def share(a, b):
            return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
        return F.struct(
            c.n_words.alias("n_words"), c.word_chars.alias("word_chars"), c.n_symbols.alias("n_symbols"), c.lines.twice.alias("n_dup_lines"),
            c.n_repeat_words.alias("n_repeat_words"), F.struct(
                c.n_words.cast("double").alias("n_words"), share(c.word_chars, c.n_words).alias("mean_word"), share(c.n_symbols, c.n_words).alias("symbols_per_word"),
                share(c.n_marks, c.n_words).alias("marks_per_word"), share(c.n_upper, c.word_chars).alias("upper_share"),
                share(c.n_digits, c.word_chars).alias("digit_share"), share(c.n_distinct, c.n_words).alias("distinct_share"),
                share(c.n_short, c.n_words).alias("short_share"), share(c.n_repeat_words, c.n_words).alias("repeat_share"),
                share(c.lines.twice, c.lines.n).alias("duplicate_line_share")).alias("features"))
    return df.withColumn("stats", _let(_let(words, counts), features))


def base_failed(stats: Column) -> Column:
    return (stats.n_words < 20) | (100 * stats.n_repeat_words > 30 * stats.n_words)


@dataclasses.dataclass(frozen=True)
class Rule:
    """A text is bad if every (feature, at_least, threshold) holds: value >= threshold, or value < threshold."""

    conditions: tuple[tuple[str, bool, float], ...]
    bad: int = 0                     # rows of the last third that it covered
    good: int = 0

    def holds(self, features: Column) -> Column:
        out = F.lit(True)
        for name, at_least, t in self.conditions:
            out = out & ((features[name] >= F.lit(t)) if at_least else (features[name] < F.lit(t)))
        return out

    def __str__(self) -> str:
        return " and ".join(f"{n} {'>=' if a else '<'} {t:.6g}" for n, a, t in self.conditions)


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    """Information gained about the bad rows by going from p0 bad and n0 good rows to p and n."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", bad_label: int = 0,
        fit_rows: int = FIT_ROWS) -> list[Rule]:
    """The decision list, learned from about ``fit_rows`` labelled texts that pass the base rules.

    Labels are chosen by a hash of their id. Null ids and labels are left out,
    several labels of one id count each. Without labelled texts of both kinds
    the list is empty.
    """
    known = labels.select(F.col(id_col).cast("long").alias("_id"), (F.col(label_col) == bad_label).alias("bad")).filter("_id IS NOT NULL AND bad IS NOT NULL")
    total = known.count()
    if not total:
        return []
    cut = min(1 << 30, -(-fit_rows * (1 << 30) // total))
    chosen = F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < cut                # of texts too, before they are dealt out
    texts = df.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).filter(chosen).join(known.filter(chosen), "_id")
    rows = statistics(texts, "_text").filter(~base_failed(F.col("stats"))).select(
        "bad", (F.pmod(F.crc32(F.col("_id").cast("string")), F.lit(3)) == 0).alias("last"), F.col("stats.features").alias("f"))
    rows = stored(rows)
    at = F.array(*[F.lit((k + 1) / (CUTS + 1)) for k in range(CUTS)])
    some = rows.agg(*[F.percentile(f"f.{n}", at).alias(f"a_{n}") for n in FEATURES], *[F.percentile(F.when(F.col("bad"), F.col(f"f.{n}")), at).alias(f"b_{n}") for n in FEATURES]).first()
    cuts = {n: sorted({float(x) for kind in "ab" for x in (some[f"{kind}_{n}"] or [])}) for n in FEATURES}
    cuts = {n: x for n, x in cuts.items() if x}

    def bin_of(name):
        """How many thresholds the value reaches."""
        return F.size(F.filter(F.array(*[F.lit(t) for t in cuts[name]]), lambda t: t <= F.col(f"f.{name}")))
    if not cuts:
        return []
    rows = stored(rows.select("bad", "last", "f", F.array(*[F.struct(F.lit(n).alias("name"), bin_of(n).alias("bin")) for n in cuts]).alias("bins")))
    out: list[Rule] = []
    while len(out) < MAX_RULES:
        free = ~covered(out, F.col("f")) if out else F.lit(True)
        grown = _grow(rows.filter(free & ~F.col("last")), cuts)
        if not grown.conditions:
            break
        rule = _prune(rows.filter(free & F.col("last")), grown)
        if rule is None:
            break
        out.append(rule)
    return out


def _grow(rows: DataFrame, cuts: dict[str, list[float]]) -> Rule:
    rule = Rule(())
    while len(rule.conditions) < MAX_CONDITIONS:
        left = rows.filter(rule.holds(F.col("f")))
        counts = left.select("bad", F.explode("bins").alias("b")).groupBy("b.name", "b.bin").agg(
            F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect()
        if not counts:
            break
        best, best_gain = None, 1e-9
        for name in cuts:
            own = sorted((r.bin, r.p, r.n) for r in counts if r.name == name)
            p0, n0 = sum(x[1] for x in own), sum(x[2] for x in own)
            if not p0 or not n0:
                break
            p = n = 0
            for k, t in enumerate(cuts[name]):           # below the threshold: the bins that reach at most k of them
                p, n = (sum(x[i] for x in own if x[0] <= k) for i in (1, 2))
                for at_least, a, b in ((True, p0 - p, n0 - n), (False, p, n)):
                    if (gain := _gain(a, b, p0, n0)) > best_gain:
                        best, best_gain = (name, at_least, t), gain
        if best is None:
            break
        rule = Rule((*rule.conditions, best))
    return rule


def _prune(rows: DataFrame, rule: Rule) -> Rule | None:
    """The start of the conjunction that is worth most on these rows; None if it is not precise enough."""
    starts = [Rule(rule.conditions[:k]) for k in range(1, len(rule.conditions) + 1)]
    counts = rows.agg(*[F.count_if(F.col("bad") & r.holds(F.col("f"))).alias(f"p{k}") for k, r in enumerate(starts)],
                      *[F.count_if(~F.col("bad") & r.holds(F.col("f"))).alias(f"n{k}") for k, r in enumerate(starts)]).first()
    worth = [((counts[f"p{k}"] - counts[f"n{k}"]) / max(1, counts[f"p{k}"] + counts[f"n{k}"]), -k) for k in range(len(starts))]
    k = -max(worth)[1]
    p, n = counts[f"p{k}"], counts[f"n{k}"]
    return Rule(starts[k].conditions, p, n) if p >= SUPPORT and p >= PRECISION * (p + n) else None


def covered(rules: list[Rule], features: Column) -> Column:
    out = F.lit(False)
    for r in rules:
        out = out | r.holds(features)
    return out


def judge(df: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """``df`` with ``stats``, ``base_failed``, ``rule`` (text of the first rule that holds, else null) and ``kept``.

    A text is kept if it passes the base rules and no rule holds. Null and
    empty texts have no words and so fail the base rules. Row-local: repeated
    rows give repeated results, an empty table gives no rows.
    """
    out = statistics(df, text_col).withColumn("base_failed", base_failed(F.col("stats")))
    first = F.lit(None).cast("string")
    for r in reversed(rules):
        first = F.when(r.holds(F.col("stats.features")), F.lit(str(r))).otherwise(first)
    return out.withColumn("rule", F.when(~F.col("base_failed"), first)).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())

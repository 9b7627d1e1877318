"""Secret scans: a random forest that removes false positives.

Candidates are long runs of key characters and, from 6 characters on, values
that a key word names, passwords in links and dotted keys. Each gets features of its length,
entropy, character transitions, dictionary coverage, path and neighbouring
words. Findings that a labelling rule is sure of (known key formats, or words,
identifiers and links) train the forest, which then scores every candidate.
The rule's formats are no features: the forest has to tell the others apart by
their shape and surroundings. SQL expressions and Spark's own forest only.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmetrics.llm.common import stored

LEAST = 6                          # characters of a value that a key word or a link names
NAMES = ("password", "passwd", "passwort", "passphrase", "pass", "pwd", "secret", "token", "key", "auth", "credential", "credentials")
VALUE = r"[^\s\"'`<>,;&(){}\[\]]"
_AFTER_NAME = r"(?<=[=:>\"'`])(?:" + "|".join(rf"(?<=(?i:{n}){q}{a}{b})" for n in NAMES for q in ("", "[\"']") for a in ("=", ":", ":=", "=>")
                                               for b in ("", "[\"'`]")) + ")"
_USER = r"[^\s:/?#@]*:[^\s/?#@]{%d,}" % LEAST                                       # user:password of a link
_RUN = rf"(?!/{{1,2}}{_USER}@)[A-Za-z0-9+/_\-]{{16,}}+={{0,2}}+"
#: A candidate inside a white-space separated word; nothing captures and look-behinds have fixed widths, so that Java and Python read it alike.
CANDIDATE = "|".join((r"SG\.[A-Za-z0-9_\-]{16,}\.[A-Za-z0-9_\-]{16,}", r"eyJ[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{5,}(?:\.[A-Za-z0-9_\-]+)?",
                      rf"(?<=://){_USER}(?=@)", _RUN + "(?![!@$%^*~])", rf"{_AFTER_NAME}(?![=:>]){VALUE}{{{LEAST - 1},}}{VALUE}(?<![.:?])", _RUN))
NAMED = "(?i)(?:" + "|".join(NAMES) + r")[\"'`]?"
ASSIGN = r"\s*(?::|=|:=|=>)"
NEAR = 64                          # characters of what stands before and behind a candidate that its features look at
TRAIN_FINDINGS = 20_000            # labelled findings of each label that train the forest, at most
TREES, DEPTH, SEED = 24, 6, 17

# Key formats that are surely secrets, forms that surely are none.
SECRET_FORMATS = [
    ("aws-access-key", r"^(?:AKIA|ASIA)[0-9A-Z]{16}$"), ("github-token", r"^gh[pousr]_[A-Za-z0-9]{36,}$"), ("gitlab-token", r"^glpat-[A-Za-z0-9_\-]{20}$"),
    ("slack-token", r"^xox[abprs]-[A-Za-z0-9\-]{10,}$"), ("google-key", r"^AIza[0-9A-Za-z_\-]{35}$"), ("stripe-key", r"^[rs]k_(?:live|test)_[0-9a-zA-Z]{24,}$"),
    ("sendgrid-key", r"^SG(\.[A-Za-z0-9_\-]{16,}\.)?[A-Za-z0-9_\-]{22,}$"), ("npm-token", r"^npm_[A-Za-z0-9]{36}$"), ("jwt", r"^eyJ([A-Za-z0-9_\-]{16,}|[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{5,}(\.[A-Za-z0-9_\-]+)?)$"),
]
KEY_WORDS = r"(?i)(token|secret|passw|pwd|api_?key|apikey|access_?key|auth|bearer|credential|private)"
HARMLESS_FORMATS = [
    r"^[a-z]+$", r"^[A-Z]?[a-z]+$", r"^[A-Z]+$", r"^[A-Za-z]+([-_][A-Za-z]+)+$", r"^[0-9]+$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$", r"^(.)\1+$", r"^/[A-Za-z_\-]+(/[A-Za-z0-9_\-]+)*/?$",
]
DICTIONARY = ("the and ing ion ent for tion ment able with from this that your user name test example sample dummy change here place holder password "
              "secret token key value default config server client data file path index page content image style script public private local global "
              "author date time year week month number string object class method function return import export module package version release "
              "build debug error warning message system service account group admin manager request response header body html http www com org net "
              "der die und sch ung keit lich heit que les des eux aux ais los las ado ida ción mente para por").split()
FEATURES = ["length", "entropy", "digits", "uppers", "lowers", "marks", "transitions", "vowel_changes", "coverage", "slashes", "in_link", "assigned",
            "quoted", "key_before", "word_before", "word_after"]


def _share(c: Column, pattern: str) -> Column:
    return (F.length(c) - F.length(F.regexp_replace(c, pattern, ""))) / F.length(c)


def _runs(c: Column, classes: list[tuple[str, str]]) -> Column:
    """Changes between classes of characters, as a share of the neighbours."""
    for pattern, letter in classes:
        c = F.regexp_replace(c, pattern, letter)
    return (F.length(F.regexp_replace(c, r"(.)\1+", "$1")) - 1) / F.greatest(F.length(c) - 1, F.lit(1))


def _entropy(c: Column) -> Column:
    each = F.transform(F.array_distinct(F.split(c, "")), lambda x: (F.length(c) - F.length(F.replace(c, x, F.lit("")))) / F.length(c))
    return F.aggregate(F.filter(each, lambda p: p > 0), F.lit(0.0), lambda a, p: a - p * F.log2(p))


def candidates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, word, nth, finding, kind, label`` and the features: one row for each candidate of each input row.

    ``word``: number of the white-space separated word that holds it, from 0;
    ``nth``: its number in that word. ``label``: 1 secret, 0 harmless, null
    where the rule does not know. Null and empty texts have no candidates.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.filter(F.col("text").rlike(r"[=:]|eyJ|[A-Za-z0-9+/_\-]{16}")).select("doc_id", F.split("text", r"\s+").alias("w"))
    word = lambda i: F.get("w", i)
    inside = lambda i: ((F.length(word(i)) >= 16) | F.contains(word(i), F.lit("=")) | F.contains(word(i), F.lit(":"))) & F.rlike(word(i), F.lit(CANDIDATE))
    given = lambda i: (F.length(word(i)) >= LEAST) & F.coalesce(
        ((F.endswith(word(i - 1), F.lit("=")) | F.endswith(word(i - 1), F.lit(":")) | F.endswith(word(i - 1), F.lit(">"))) & F.rlike(F.concat_ws(" ", word(i - 2), word(i - 1)), F.lit(NAMED + ASSIGN + "$")))
        | ((F.startswith(word(i), F.lit("=")) | F.startswith(word(i), F.lit(":"))) & F.rlike(word(i - 1), F.lit(NAMED + "$"))), F.lit(False))
    at = F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: inside(i) | given(i))
    near = lambda i, k: F.coalesce(F.get("w", i + k), F.lit(""))
    end, start = (lambda c: F.substring(c, -NEAR, NEAR)), (lambda c: F.substring(c, 1, NEAR))
    found = F.transform(at, lambda i: F.struct(i.alias("word"), F.get("w", i).alias("held"), F.concat_ws(" ", end(near(i, -3)), end(near(i, -2)), end(near(i, -1))).alias("before"),
                                               end(near(i, -1)).alias("last"), start(near(i, 1)).alias("after"), given(i).alias("given")))
    rows = rows.select("doc_id", F.explode(found).alias("x")).select("doc_id", "x.*")
    held = F.col("held")
    # a word is read a fixed number of times, whatever it holds: its candidates take along what stands before them
    rows = rows.select("*", F.regexp_extract_all("held", F.lit(CANDIDATE), F.lit(0)).alias("in_word"), F.split("held", CANDIDATE, -1).alias("between"),
                       (F.length(held) - F.length(F.replace(held, F.lit("/"), F.lit("")))).cast("double").alias("slashes"),
                       held.rlike(r"(?i)(://|www\.|\.(com|org|net|html?|php|png|jpe?g|gif|js|css)\b)").alias("linked"))
    begin = rf"^([=:>]*[\"'`]?)({VALUE}{{{LEAST - 1},}}{VALUE}(?<![.:?]))"
    value = F.regexp_extract("held", begin, 2)
    own = F.transform("in_word", lambda c, j: F.struct(c.alias("finding"), F.concat(
        end(F.coalesce(F.get("in_word", j - 1), F.lit(""))), end(F.get("between", j))).alias("lead")))
    more = F.when(F.col("given") & (value != "") & ~F.exists("in_word", lambda x: F.contains(x, value)),
                  F.array(F.struct(value.alias("finding"), F.regexp_extract("held", begin, 1).alias("lead")))).otherwise(F.array().cast("array<struct<finding:string,lead:string>>"))
    rows = rows.select("doc_id", "word", "before", "last", "after", "slashes", "linked", F.posexplode(F.concat(own, more)).alias("nth", "x"))
    rows = rows.select("*", "x.finding", "x.lead")
    c, lead = F.col("finding"), F.col("lead")
    user = lead.endswith("://") & c.contains(":")                      # user:password of a link, not a part of its path
    plain = r"^[\p{L}'’]+[.,;:!?)]*$"
    rows = rows.select(
        "doc_id", "word", "nth", "finding",
        F.length(c).cast("double").alias("length"), _entropy(c).alias("entropy"), _share(c, "[0-9]").alias("digits"), _share(c, "[A-Z]").alias("uppers"),
        _share(c, "[a-z]").alias("lowers"), _share(c, "[^0-9A-Za-z]").alias("marks"),
        _runs(c, [("[a-z]", "a"), ("[A-Z]", "A"), ("[0-9]", "0"), ("[^aA0]", "-")]).alias("transitions"),
        _runs(c, [("(?i)[aeiouy]", "1"), ("[A-Za-z]", "2"), ("[^12]", "3")]).alias("vowel_changes"),
        _share(c, "(?i)(" + "|".join(sorted(DICTIONARY, key=lambda x: (-len(x), x))) + ")").alias("coverage"),
        "slashes", (F.col("linked") & ~user).cast("double").alias("in_link"),
        (lead.rlike(r"[=:]") | F.col("last").rlike(r"[=:]$")).cast("double").alias("assigned"),
        lead.rlike("[\"'`]$").cast("double").alias("quoted"), F.concat_ws(" ", "before", lead).rlike(KEY_WORDS).cast("double").alias("key_before"),
        F.col("last").rlike(plain).cast("double").alias("word_before"), F.col("after").rlike(plain).cast("double").alias("word_after"))
    kind = F.coalesce(*[F.when(c.rlike(p), F.lit(k)) for k, p in SECRET_FORMATS],
                      F.when(c.rlike(r"^[0-9a-f]{32,64}$") & (F.col("key_before") > 0) & (F.col("assigned") > 0), F.lit("assigned-hex")))
    harmless = F.lit(False)
    for p in HARMLESS_FORMATS:
        harmless = harmless | (c.rlike(p) & (F.length(c) >= 16))          # the rule is sure of no short value
    rows = rows.withColumn("kind", kind)
    return rows.withColumn("label", F.when(F.col("kind").isNotNull(), F.lit(1)).when(harmless | (F.col("in_link") > 0), F.lit(0)))


def train_forest(found: DataFrame, labelled: DataFrame | None = None):
    """A forest from labelled findings (columns FEATURES and ``label``), TRAIN_FINDINGS of each label at most; None if a label has none.

    Without ``labelled`` the findings whose label the rule knows are taken,
    those with the smallest hashes.
    """
    rows = (labelled if labelled is not None else found).filter(F.col("label").isNotNull())
    if "finding" in rows.columns:
        rows = rows.dropDuplicates(["finding", "label"]).withColumn("h", F.xxhash64("finding"))
    else:
        rows = rows.withColumn("h", F.xxhash64(*FEATURES))
    held = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    few = lambda k: F.pmod("h", F.lit(1_000_003)) < 1_000_003 * min(1.0, 1.2 * TRAIN_FINDINGS / max(1, held.get(k, 0)))  # noqa: E731  before the sort
    one = lambda k: rows.filter(F.col("label") == k).filter(few(k)).orderBy("h", *FEATURES).limit(TRAIN_FINDINGS).select(F.col("label").cast("double"), *FEATURES)
    sample = stored(one(1).union(one(0)))
    count = {int(r["label"]): r["count"] for r in sample.groupBy("label").count().collect()}
    if len(count) < 2:
        return None
    most = max(count.values())
    weight = F.create_map(*[x for k, n in count.items() for x in (F.lit(float(k)), F.lit(most / n))])
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample.withColumn("weight", weight[F.col("label")]))
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, weightCol="weight").fit(data)


def scan_secrets(df: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, word, nth, finding, kind, score, is_secret``: every candidate with the forest's probability.

    One row for each candidate, repeated input rows alike. A null or empty text
    gives none, an empty table gives no rows. Where there are no findings of
    both labels to train on, the rule alone decides (score 1, 0, or 0.5 where
    it does not know).
    """
    found = stored(candidates(df, id_col, text_col))
    forest = train_forest(found, labelled)
    keep = ["doc_id", "word", "nth", "finding", "kind"]
    if forest is None:
        return found.select(*keep, F.coalesce(F.col("label").cast("double"), F.lit(0.5)).alias("score"), F.coalesce(F.col("label") == 1, F.lit(False)).alias("is_secret"))
    scored = forest.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found))
    score = vector_to_array("probability")[1]
    return scored.select(*keep, score.alias("score"), (score >= 0.5).alias("is_secret"))

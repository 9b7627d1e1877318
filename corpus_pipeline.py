"""Corpus cleaning: language ID, line dedup, near-duplicate join, benchmark decontamination, BPE coding.

Each stage takes ``(spark, docs, sf_dir)`` and works on every row it is given;
all but the last return the columns of ``documents``. The rows of a stage are
written as Parquet to the shared folder and read again by the next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from segmetrics.llm.bpe import encode_decode
from segmetrics.llm.common import stored, table
from segmetrics.llm.decontaminate import find_contamination
from segmetrics.llm.langid import fit, predict
from segmetrics.llm.line_dedup import dedup_lines
from segmetrics.llm.ngram_join import link_documents
from segmetrics.llm.queries import TOKENIZER

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


MIN_SCORE = 0.3           # of the likeliest language: below it the network sees no language in a text's bytes
MIN_BYTES = 256           # two windows of the network; of a shorter text the score says too little to reject it


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a language go: null texts, texts without a letter, and those of MIN_BYTES or more whose likeliest
    language has a pooled probability below MIN_SCORE."""
    net, languages = fit(docs)
    kept = predict(docs, net, languages, keep=["text", "lang", "source", "n_chars"])
    likely = (F.col("score") >= MIN_SCORE) | (F.octet_length("text") < MIN_BYTES)
    return kept.filter((F.size("scores") > 0) & likely).select(COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of three documents at least stay in the document with the largest id alone; ``n_chars`` is counted anew."""
    return dedup_lines(docs, keep=["lang", "source"]).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def row_key() -> Column:
    """Text that sorts as doc_id (null last), then tells different texts of one id apart; equal rows share it."""
    place = F.lpad(F.expr("CAST(CAST(doc_id AS DECIMAL(20, 0)) + 9223372036854775808BD AS STRING)"), 20, "0")
    return F.concat(F.coalesce(place, F.lit("~")), F.lit(":"), F.hex(F.xxhash64("text")), F.when(F.col("text").isNull(), "-").otherwise("+"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays: that of the smallest id; of several texts of this id the smallest
    hash, of equal rows any. Rows are told apart by id and text, so an id that stands for a copy and for a text of its
    own loses only the copy."""
    keyed = docs.select(COLUMNS).withColumn("key", row_key())
    linked = link_documents(keyed, id_col="key").groupBy(F.col("doc_id").alias("key")).agg(
        F.min("component_id").alias("first"), F.count("*").alias("times"))
    odd = linked.filter("first <> key OR times > 1").select("key", "first")      # copies, and rows that repeat
    # one shuffle of the texts: the rows that stay are numbered where the join has put them
    stay = keyed.join(stored(odd), "key", "left").filter("first IS NULL OR first = key")
    nth = F.row_number().over(Window.partitionBy("key").orderBy("key"))
    return stay.withColumn("nth", nth).filter("nth = 1").select(COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"), keep=["text", "lang", "source", "n_chars"])
    return found.filter(~F.col("contaminated")).select(COLUMNS)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers) and digests of ids and decoded text."""
    coded = encode_decode(docs, TOKENIZER, keep=["lang", "source"])
    return coded.select("doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("bpe", bpe)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs)
    return docs

"""A corpus pipeline of five operators, each stage over what its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet in the shared folder and reads as the next stage's docs.
Language ID, the chosen-path join and the index search can't be said in SQL, so
ORACLE_SQL is None.  tests/llm holds the stages against plain-Python versions on
small tables (language ID: held-out documents and awkward rows).

Every stage takes an empty table and returns one.  A null id is an id like
others; a null or empty text has no language, so the first stage drops it.  Rows
equal in id and text are one document: the Jaccard stage keeps one of them where
the text has a word, the others treat each like the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import decontam, jaccard, langid, linededup, mixing
from ledgerlens.llm._spark import fold, ship, table, text_key, written
from ledgerlens.session import apply_defaults

#: A document goes if its leading language has less of it than this, or it has no letter.
LEAST_SHARE = 0.4
#: Benchmark items of fewer words than this remove no document: a single common
#: word as an item would empty the corpus.
LEAST_ITEM_WORDS = 3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a main language (learned as op9 learns it); repeated
    rows and rows without id are judged each by their text."""
    ship(spark)
    model = langid.fit(docs.filter(fold("doc_id", 4) != 2))
    found = langid.predict(docs, model, through=docs.columns)
    return found.filter((F.col("lang_pred") != langid.UND) & (F.col("score") >= LEAST_SHARE)).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated three-line windows, n_chars anew; a document all
    of whose lines stand elsewhere goes. A null id comes before others, rows of one
    id and text are one document; a text that was blank before stays."""
    cols = docs.columns
    out = linededup.dedup_lines(docs)
    out = out.filter((F.col("n_removed") == 0) | (F.btrim("text", F.lit(" \t\r\n")) != ""))
    return out.select(*[F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in cols])


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays: that with the smallest id (a null id before
    others; of rows with one id, that with the smallest text key; rows equal in
    both are one document, of which the smallest row stays)."""
    ship(spark)
    found = written(jaccard.jaccard_join(docs), "stage-jaccard").filter("n_links > 0")
    linked = found.groupBy("group_key", "doc_id", "text_key").agg(F.count("*").alias("rows"))
    first = linked.groupBy("group_key").agg(F.min(F.struct("doc_id", "text_key", "rows")).alias("first"))
    marks = written(linked.join(first, "group_key").select(
        F.col("doc_id").alias("__doc"), F.col("text_key").alias("__key"), "rows",
        F.struct("doc_id", "text_key", "rows").eqNullSafe(F.col("first")).alias("is_first")), "stage-jaccard-marks")
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__k") == F.col("__key"))
    rows = docs.withColumn("__k", text_key("text"))
    kept = rows.join(marks.filter("not is_first or rows > 1"), same, "left_anti").drop("__k")
    # a minimum by partial sums, so that no task gets all rows of a document repeated very often
    merged = (rows.join(marks.filter("is_first and rows > 1"), same, "left_semi")
              .groupBy("doc_id", "__k").agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*"))
    return kept.unionByName(merged)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item (of at least
    LEAST_ITEM_WORDS words); every row of such an id and text goes."""
    ship(spark)
    words = F.regexp_count("text", F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"))
    found = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark").filter(words >= LEAST_ITEM_WORDS))
    hit = found.filter("n_hit > 0").select(F.col("doc_id").alias("__doc"), F.col("text_key").alias("__key")).distinct()
    out = docs.withColumn("__k", text_key("text"))
    out = out.join(hit, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__k") == F.col("__key")), "left_anti")
    return out.drop("__k")


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Equal weights for all sources (a null source is one of them), one epoch;
    repeated rows draw the same number of copies, rows without id by their text."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", jaccard_join),
    ("benchmark_decontamination", decontamination),
    ("mixing_sources", mixing_sources),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_defaults(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

"""The registered queries of the subpackage: thin bindings of the operators to the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (
    bpe,
    decontam,
    jaccard,
    langid,
    linecrf,
    linededup,
    mixing,
    pii,
    puquality,
    resample,
    spelling,
    toxicity,
    warc,
)
from ledgerlens.llm._spark import fold, ship, table
from ledgerlens.session import apply_defaults


def _ready(spark: SparkSession) -> None:
    apply_defaults(spark)
    ship(spark)


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    return table(spark, sf_dir, "documents")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(_docs(spark, sf_dir)).drop("text_key", "group_key")


def op2_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal weights for all sources, one epoch."""
    return mixing.mix(_docs(spark, sf_dir))


def op3_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    return pii.find(docs, pii.fit(docs))


def op4_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op5_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    return puquality.predict(docs, puquality.fit(docs, table(spark, sf_dir, "labels")))


def op6_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    return linecrf.predict(docs, linecrf.fit(docs))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.decontaminate(_docs(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"), "n_near_items")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    return toxicity.predict(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir).select("doc_id", "text", "lang", (fold("doc_id", 4) == 2).alias("held_out"))
    model = langid.fit(docs.filter(~F.col("held_out")))
    return langid.predict(docs, model, through=["doc_id", "held_out"])


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(_docs(spark, sf_dir).select("doc_id", "text"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_docs(spark, sf_dir))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample.resample(_docs(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op13_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _docs(spark, sf_dir).select("doc_id", "text")
    vocab = bpe.vocabulary(spark, public_tokenizers.path("word_bpe_49k.json"))
    out = bpe.decode(bpe.encode(docs, vocab), vocab)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_poisson_mixing": op2_poisson_mixing,
    "op3_pii_spans": op3_pii_spans,
    "op4_warc_bundles": op4_warc_bundles,
    "op5_quality_pu": op5_quality_pu,
    "op6_quality_lines": op6_quality_lines,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_toxicity": op8_toxicity,
    "op9_language_id": op9_language_id,
    "op10_line_dedup": op10_line_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_bpe_round_trip": op13_bpe_round_trip,
    "pipeline": pipeline,
}

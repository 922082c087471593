"""Corpus preparation: quality rules, language identification, near duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes it as Parquet to the shared checkpoint folder and the next stage reads
it from there. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import best_two_fit, bpe_backtrack, host_rules, ppm_langid, signature_tree
from strata.llm.rowids import row_ids
from strata.llm.tables import sized, table, written

MIN_LANGUAGE_SCORE = 0.5
ROW = "__row_id"  # names a text where its doc_id names several
MAX_LANGUAGE_BITS = 2  # times the median bits per byte of the language


def _as_one(docs: DataFrame, *names: str) -> DataFrame:
    """Whole rows as one column ``_row``, beside the columns a stage reads: no name of theirs clashes with the stage's."""
    return docs.select(F.struct("*").alias("_row"), *names)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail a rule, or whose source does as a whole."""
    judged = host_rules.judge(_as_one(docs, "text", "source"), keep=["_row"])
    return judged.where("kept").select("_row.*")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters, those whose language is not clear, and those that no language explains.

    A language without held-out rows is held to the loosest limit of the others.
    """
    model = ppm_langid.train(docs)
    usual = ppm_langid.usual_bits(docs, model)
    limit = F.lit(max(usual.values(), default=float("inf")))
    for lang, bits in usual.items():
        limit = F.when(F.col("lang_pred") == lang, bits).otherwise(limit)
    predicted = ppm_langid.predict(_as_one(docs, "text"), model, ["_row"], bits=True)
    clear = (F.col("lang_pred") != ppm_langid.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return predicted.where(clear & (F.col("bits_per_byte") <= MAX_LANGUAGE_BITS * limit)).select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group: the one with the smallest id, once. Rows without an id stay.

    Texts that share an id are documents each: one goes only if its own set of shingles is another's, or near it.
    """
    rows, _ = row_ids(docs, ROW)
    found = written(signature_tree.similar_components(rows.select(F.col(ROW).alias("doc_id"), "text")), "near-duplicates")
    found = found.withColumnRenamed("doc_id", ROW)
    drop = written(found.where(f"{ROW} != component_id").select(ROW).distinct(), "near-duplicates-drop")
    repeated = written(found.where(f"{ROW} is not null").groupBy(ROW).count().where("count > 1").select(ROW), "repeated-ids")
    kept = rows.join(sized(drop), ROW, "left_anti")
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    again = kept.join(sized(repeated), ROW, "left_semi").select(ROW, F.struct(*docs.columns).alias("_row"), "text")
    once = again.groupBy(ROW).agg(F.min_by("_row", F.struct("text", F.xxhash64("_row"))).alias("_row")).select("_row.*")
    return kept.join(sized(repeated), ROW, "left_anti").select(*docs.columns).unionByName(once)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of the documents that are left."""
    return best_two_fit.pack(docs, bpe_backtrack.vocabulary_path())


STAGES = [
    ("quality rules", quality_rules),
    ("language id", language_id),
    ("n-gram jaccard join", near_duplicates),
    ("best-fit packing", packing),
]

#: SQL expresses neither the language model nor the tokenizer; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs

"""Registered queries: every operator over its whole driver table, and the oracle SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    best_two_fit,
    bpe_backtrack,
    conversation_trie,
    host_rules,
    html_suffix,
    iblt,
    oracle,
    ppm_langid,
    signature_tree,
    snapshot_collapse,
    token_rollup,
    url_redirects,
    warc_bundles,
    whitening,
)
from strata.llm.tables import table, written
from strata.plans.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_url_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_redirects.judge(table(spark, sf_dir, "pages"))


def op2_html_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_suffix.extract(table(spark, sf_dir, "pages"))


def op3_iblt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iblt.fingerprints(table(spark, sf_dir, "documents"))


def op4_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_two_fit.pack(table(spark, sf_dir, "documents"), bpe_backtrack.vocabulary_path())


def op5_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup = token_rollup.Rollup(spark, scratch_path(spark, "token-rollup"))
    for batch_id, changes in token_rollup.change_feed(table(spark, sf_dir, "documents")).items():
        rollup.commit(batch_id, changes)
        rollup.commit(batch_id, changes)  # a repeated commit counts once
    return rollup.totals()


def op6_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    judged = host_rules.judge(docs, keep=["doc_id", "source"])
    return judged.select("doc_id", *host_rules.MEASURES, "base_failed", "kept")


def op7_bpe_backtrack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_backtrack.encode_digests(table(spark, sf_dir, "documents"), bpe_backtrack.vocabulary_path())


def op8_ppm_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rows = docs.withColumn("held_out", ppm_langid.held_out())
    return ppm_langid.predict(rows, ppm_langid.train(docs), ["doc_id", "held_out"])


def op9_signature_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_tree.similar_documents(table(spark, sf_dir, "documents"))


def op10_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_collapse.rendered(table(spark, sf_dir, "conversations"))


def op11_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc_bundles.archive(table(spark, sf_dir, "pages"), path)
    number = lambda c, name: F.col(c).cast("long").alias(name)
    return warc_bundles.records(spark, path).select(
        number("id", "page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to", "refers_to")
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_trie.ordered(table(spark, sf_dir, "conversations"))
    turns = written(turns, "trie-ordered")
    return conversation_trie.trie(conversation_trie.shared_heads(turns), turns.select("conv_id"))


QUERIES: dict[str, Query] = {
    "op1_url_redirects": op1_url_redirects,
    "op2_html_suffix": op2_html_suffix,
    "op3_iblt": op3_iblt,
    "op4_best_two_fit": op4_best_two_fit,
    "op5_token_rollup": op5_token_rollup,
    "op6_host_rules": op6_host_rules,
    "op7_bpe_backtrack": op7_bpe_backtrack,
    "op8_ppm_langid": op8_ppm_langid,
    "op9_signature_tree": op9_signature_tree,
    "op10_snapshot_collapse": op10_snapshot_collapse,
    "op11_warc_bundles": op11_warc_bundles,
    "op12_whitening": op12_whitening,
    "op13_conversation_trie": op13_conversation_trie,
}

ORACLE: dict[str, str] = {
    "op1_url_redirects": oracle.URL_REDIRECTS,
    "op5_token_rollup": oracle.TOKEN_ROLLUP,
    "op6_host_rules": oracle.HOST_RULES,
    "op10_snapshot_collapse": oracle.SNAPSHOT_COLLAPSE,
    "op11_warc_bundles": oracle.WARC_BUNDLES,
    "op13_conversation_trie": oracle.CONVERSATION_TRIE,
}

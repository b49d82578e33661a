"""The registered queries of the operators: digests of their outputs over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import html, lexical, manifest, mixing, packing, pieces, pii, pq, quality, simhash, substrings, topk, urls
from eventlake.llm.common import importable, table
from eventlake.llm.oracles import ORACLES as ORACLES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
# A stand-in: production runs pass a secret of their own.
PII_SECRET = "not a secret"


def query(run: Query) -> Query:
    def ready(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(importable(spark), sf_dir)

    ready.__doc__ = run.__doc__
    QUERIES[run.__name__] = ready
    return ready


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's fingerprint and the smallest document it is linked with."""
    rows = simhash.classes(table(spark, sf_dir, "documents"))
    return rows.select(
        F.col("key").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of each document the mix takes."""
    rows = mixing.mix_counts(table(spark, sf_dir, "documents"))
    return rows.select(
        F.col("key").alias("doc_id"),
        "size",
        "source",
        "source_size",
        "target",
        (F.col("size") * F.col("n_copies")).alias("taken"),
    )


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of each document, and whether it passes."""
    rows = quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select(
        F.col("key").alias("doc_id"),
        (quality.fold(F.col("key")) == 2).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of each document went."""
    rows = packing.pieces(packing.pack(table(spark, sf_dir, "documents")))
    return rows.select(
        F.col("key").alias("doc_id"),
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "window",
        "step_id",
    )


@query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their personal data replaced, and how many mentions were."""
    docs = table(spark, sf_dir, "documents")
    return pii.replace(docs, PII_SECRET, count="n_replaced").select("doc_id", "text", "n_replaced")


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline from documents to packed sequences."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


@query
def op3_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows for every fiftieth vector."""
    rows = topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % topk.EVERY == 0)
    return rows.select(
        F.col("query").alias("query_id"), "rank", F.col("key").alias("vec_id"), "score"
    )


@query
def op8_pq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of each label."""
    rows = pq.near_duplicates(table(spark, sf_dir, "embeddings"))
    return rows.select(
        F.col("key").alias("vec_id"),
        "n_links",
        F.col("component").alias("component_id"),
        F.col("key").eqNullSafe(F.col("component")).alias("kept"),
    )


@query
def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    rows = html.main_text(table(spark, sf_dir, "pages"))
    return rows.select(
        F.col("key").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars")
    )


@query
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages against dated lists.

    The tables hold neither fetch times nor lists, so both come from ``events``: the event of a
    page's number tells when it was fetched; an event of a user is a change, at its time, of the
    rule about the page of that user's number, and the kind of event says which and how.
    """
    pages, events = table(spark, sf_dir, "pages"), table(spark, sf_dir, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    fetched = events.select(F.col("event_id").alias("page_id"), at.alias("at"))
    captures = pages.select("page_id", "url").join(fetched, "page_id", "left")
    listed = events.select(F.col("user_id").alias("page_id"), "event_type", at.alias("at"))
    url, what = F.col("url"), F.col("event_type")
    rule = F.when(what.isin("click", "error"), urls.domain_rule(url, 3)).when(what == "view", urls.url_rule(url))
    rule = rule.otherwise(urls.host_rule(url))
    action = F.when(what.isin("click", "view"), urls.BLOCK).when(what == "purchase", urls.ALLOW)
    changes = listed.join(pages.select("page_id", "url"), "page_id")
    changes = changes.select(rule.alias("rule"), "at", action.alias("action"))
    rows = urls.judge(captures.select(F.col("page_id").alias("key"), "url", "at"), changes)
    blocked = F.coalesce(F.col("action") == urls.BLOCK, F.lit(False))
    return rows.select(F.col("key").alias("page_id"), "n_active", "rule", "action", blocked.alias("blocked"))


@query
def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeated strings of 200 bytes cover in each document."""
    rows = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return rows.select(
        F.col("key").alias("doc_id"),
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    rows = lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select(F.col("item").alias("item_id"), "rank", F.col("key").alias("doc_id"), "score")


@query
def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, and what it says about copies with some texts tampered with."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = F.translate("text", manifest.UPPER, manifest.UPPER.lower())
    tree = manifest.build(
        docs,
        order="doc_id",
        group="lang",
        fields=("doc_id", "source", "lang", "n_chars", "text"),
        changed={"text": F.when(tampered, lowered).otherwise(F.col("text"))},
    )
    rows = tree.proofs()
    return rows.select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2("proof", 256).alias("proof_sha256"),
        "folded_root",
        "verified",
        F.coalesce(F.size("copied"), F.lit(0)).cast("long").alias("n_copied"),
    )


@query
def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids, spans and decoded text of every document, as digests."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = pieces.encode(table(spark, sf_dir, "documents"), path, decoded=True)
    return rows.select(
        F.col("key").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).cast("long").alias("n_bytes"),
    )

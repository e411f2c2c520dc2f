"""Registered queries of the corpus operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (byte_bpe, conversation_repair, html_text, language_id, lm_score, minhash, mixing, passages,
               quality_model, quality_rules, token_alignment, url_filters, vector_links)
from ..session import configure
from .arrow import find_package
from .oracle import ORACLES

__all__ = ["ORACLES", "QUERIES", "VOCABULARY"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Files of the installed tokenizer package, which every worker has.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def query(name: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(find_package(configure(spark)), sf_dir)
        QUERIES[name] = run
        return f
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_minhash")
def _minhash(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs, shingle=4)


@query("op2_quality_model")
def _quality_model(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scored = quality_model.classify(docs, table(spark, sf, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query("op3_html_text")
def _html_text(spark, sf):
    found = html_text.extract(table(spark, sf, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op4_vector_links")
def _vector_links(spark, sf):
    return vector_links.links(table(spark, sf, "embeddings"))


@query("op5_mixing")
def _mixing(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@query("op6_url_filters")
def _url_filters(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    return url_filters.judge(pages).select("page_id", "host", "path", "rule", "verdict")


@query("op7_byte_bpe")
def _byte_bpe(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    coded = byte_bpe.encode(docs, VOCABULARY, decoded=True)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        byte_bpe.ids_digest().alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op8_passages")
def _passages(spark, sf):
    return passages.repeated_passages(table(spark, sf, "documents").select("doc_id", "text"))


@query("op9_lm_score")
def _lm_score(spark, sf):
    return lm_score.score(table(spark, sf, "documents").select("doc_id", "text"))


@query("op10_quality_rules")
def _quality_rules(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return quality_rules.apply_cascade(docs).drop("text", "rejected_by")


@query("op11_token_alignment")
def _token_alignment(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    aligned = token_alignment.align(docs, VOCABULARY, PIECES)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    counted = aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "links")
    return token_alignment.weigh(counted)


@query("op12_conversation_repair")
def _conversation_repair(spark, sf):
    return conversation_repair.repair(table(spark, sf, "conversations"))


@query("op13_language_id")
def _language_id(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    return language_id.identify(docs).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")

"""Queries over the test tables, one per operator, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import line_rules, quality
from .exact_dedup import exact_dedup
from .jaccard_join import jaccard_components
from .oracles import ORACLES
from .packing import pack_documents
from .pieces import sample_pieces
from .prefix_trie import conversation_trie
from .secrets import scan_secrets
from .sharding import shard
from .shared import table
from .spelling import spelling_variants
from .toxicity import score as score_toxicity
from .urls import judge
from .wrappers import extract


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op5_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op6_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.line_rules(table(spark, sf_dir, "documents"))


def op7_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_pieces(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), max_tokens=2048)


def op9_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"), shards=16)


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), width=5, percent=80)


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_permuterm_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_zfast_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_quality_classifier, op3_url_filter, op4_secret_scan, op5_html_wrappers, op6_line_rules,
    op7_sampled_pieces, op8_best_fit_packing, op9_sampled_splitters, op10_ngram_jaccard_join, op11_toxicity, op12_permuterm_variants, op13_zfast_trie)}

__all__ = ["ORACLES", "QUERIES"]

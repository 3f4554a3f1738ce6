"""Registered queries of the training-data operators, and their DuckDB SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import jaccard_join, license_scan, simhash_join
from .bestfit_packing import pack
from .common import table
from .html_mincut import extract
from .huffman_ids import token_id_files
from .impact_topk import top_k
from .nbsvm_quality import score
from .order_minhash import fingerprints
from .periodic_runs import run_digests
from .pii_anchors import find_pii
from .source_mixing import TARGETS, domain_labels, mix
from .spelling_variants import word_variants


def op1_html_mincut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op3_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))


def op5_impact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op6_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_id_files(table(spark, sf_dir, "documents"))


def op7_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op8_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), domain_labels(table(spark, sf_dir, "labels")), TARGETS)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op11_simhash_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_join.join(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_mincut": op1_html_mincut,
    "op2_license_scan": op2_license_scan,
    "op3_nbsvm_quality": op3_nbsvm_quality,
    "op4_pii_anchors": op4_pii_anchors,
    "op5_impact_topk": op5_impact_topk,
    "op6_token_id_files": op6_token_id_files,
    "op7_bestfit_packing": op7_bestfit_packing,
    "op8_soft_mixing": op8_soft_mixing,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_order_minhash": op10_order_minhash,
    "op11_simhash_pigeonhole": op11_simhash_pigeonhole,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE: dict[str, str] = {
    "op2_license_scan": license_scan.oracle_sql(),
}

"""The opN_<name> queries: each operator over its whole table with production parameters, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, hosts, language, minhash, negatives, packing, phrases, pii, quality, simhash, suffixes, toxicity, warc
from .common import table


def op1_candidate_boosting_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


def op2_host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts.judge(table(spark, sf_dir, "documents"))


def op3_simhash_deletion_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.build(table(spark, sf_dir, "pages"))


def op5_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_suffix_array_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_latent_neighbour_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_suffix_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.deduplicate(table(spark, sf_dir, "documents"))


def op9_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_mixture_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op11_bayesian_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_cover_tree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(table(spark, sf_dir, "embeddings"))


def op13_setm_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_candidate_boosting_pii": op1_candidate_boosting_pii,
    "op2_host_quality_rules": op2_host_quality_rules,
    "op3_simhash_deletion_variants": op3_simhash_deletion_variants,
    "op4_warc_derivatives": op4_warc_derivatives,
    "op5_string_kernel_toxicity": op5_string_kernel_toxicity,
    "op6_suffix_array_decontamination": op6_suffix_array_decontamination,
    "op7_latent_neighbour_quality": op7_latent_neighbour_quality,
    "op8_suffix_merge_dedup": op8_suffix_merge_dedup,
    "op9_harmonic_packing": op9_harmonic_packing,
    "op10_mixture_language": op10_mixture_language,
    "op11_bayesian_minhash": op11_bayesian_minhash,
    "op12_cover_tree_negatives": op12_cover_tree_negatives,
    "op13_setm_collocations": op13_setm_collocations,
}

ORACLES: dict[str, str] = {
    "op2_host_quality_rules": hosts.oracle(),
    "op11_bayesian_minhash": minhash.oracle(),
    "op12_cover_tree_negatives": negatives.oracle(),
    "op13_setm_collocations": phrases.oracle(),
}

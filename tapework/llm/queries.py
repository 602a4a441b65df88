"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tapework.llm import chat, decontaminate, divergence, htmltext, language, licenses, merkle, minhash, ngramjoin, packing, secrets, spotsigs, substrings
from tapework.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edited_fingerprints(table(spark, sf_dir, "documents"))


def op2_count_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.linked(table(spark, sf_dir, "documents"))


def op3_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotation_report(table(spark, sf_dir, "conversations"))


def op4_byte_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_report(table(spark, sf_dir, "documents"))


def op5_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extracted(table(spark, sf_dir, "pages"))


def op7_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op8_license_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(table(spark, sf_dir, "documents"))


def op9_substring_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.substring_report(table(spark, sf_dir, "documents"))


def op10_certified_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


def op11_run_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_octopus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_spotsigs, op2_count_vectors, op3_rotation, op4_byte_network, op5_prefix_join, op6_text_density, op7_secret_forest, op8_license_automaton, op9_substring_index, op10_certified_packing, op11_run_length, op12_minhash, op13_octopus)}
ORACLES: dict[str, str] = {"op2_count_vectors": ngramjoin.JOIN_SQL, "op3_rotation": chat.ROTATION_SQL, "op9_substring_index": substrings.SUBSTRING_SQL, "op5_prefix_join": decontaminate.CONTAMINATION_SQL, "op11_run_length": divergence.AUDIT_SQL, "op12_minhash": minhash.NEAR_SQL, "op13_octopus": merkle.MANIFEST_SQL}

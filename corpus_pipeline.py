"""A corpus pipeline: language ID, near-duplicate removal, decontamination, secret masking, packing.

Every stage reads what the one before it kept. All but the last return the columns of `documents`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapework.llm import decontaminate, language, ngramjoin, packing, secrets
from tapework.llm.common import shared_dir, table

#: A text whose likeliest language gets less than this share of its positions' probability is rejected, as one without letters is.
LEAST_SCORE = 0.35


def _free(docs: DataFrame, *names: str) -> list[str]:
    """Names that no column of docs has, one for each of those."""
    taken = {c.lower() for c in docs.columns}
    mark = "_"
    while any(f"{mark}{n}".lower() in taken for n in names):
        mark += "_"
    return [f"{mark}{n}" for n in names]


def _apart(docs: DataFrame, *added: str) -> tuple[DataFrame, list[Column]]:
    """docs with other names for its columns that bear a name in added, and what gives its own columns back."""
    clash = [c for c in docs.columns if c.lower() in added]
    new = dict(zip(clash, _free(docs, *clash), strict=True))
    return docs.withColumnsRenamed(new), [F.col(f"`{new.get(c, c)}`").alias(c) for c in docs.columns]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language stay; lang is what the network says where the table has none. Texts without letters (null and empty ones too) or with no clear language go.

    Equal rows are judged alike, and all other columns stay as they are, whatever their names. An empty table stays empty.
    """
    apart, own = _apart(docs, "lang_pred", "score")
    seen = language.identified(apart, language.learned_from(docs)).filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return seen.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*own)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that links connect, the one with the smallest id stays; rows with the same id and text stay once.

    Rows that repeat an id are one document. Documents without an id, text or words are in no group and stay. All columns stay as they are, whatever their names.
    """
    id_, component = _free(docs, "id", "component")
    found = ngramjoin.linked(docs).select(F.col("doc_id").alias(id_), F.col("component_id").alias(component))
    heads = found.filter(F.col(id_).isNull() | (F.col(id_) == F.col(component))).select(id_).distinct()
    return docs.join(heads, F.col("doc_id").eqNullSafe(F.col(id_)), "left_semi").dropDuplicates(["doc_id", "text"])


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages beyond the contamination rule go. Null and wordless texts hold none and stay; equal rows are judged alike. All columns stay as they are, whatever their names."""
    id_, hash_ = _free(docs, "id", "hash")
    judged = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    bad = judged.filter("contaminated").select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_)).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(hash_)), "left_anti")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, its secrets masked and, where there were any, its length counted anew. Null and empty texts have none. All other columns stay as they are, whatever their names."""
    apart, own = _apart(docs, "findings", "n_candidates", "masked_text")
    scanned = secrets.scanned(apart).withColumn("text", F.col("masked_text")).withColumn("n_chars", F.when(F.size("findings") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return scanned.select(*own)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences, as `packing.packed_documents` gives them: null and empty texts are a document of one token, equal rows are pieces each, other columns are left out."""
    return packing.packed_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", decontaminate_benchmark),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack),
]

#: Language ID, secret scans and packing are not SQL; the stages are tested against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written as Parquet in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

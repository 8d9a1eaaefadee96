"""Corpus pipeline: toxicity, line dedup, near duplicates, decontamination, mixing.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``; its rows are written as
Parquet in the shared folder and read again as the next stage's ``docs``.  All
stages but the last return the columns of ``documents``.

Edge cases follow the operators: documents with NULL ids or NULL and empty
texts pass the filters unchanged, an empty table stays empty, extra columns
are kept.  Where a stage changes a text, ``n_chars`` (if there) is its new
length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm.common import table, written
from vaultline.llm.decontaminate import remove_spans
from vaultline.llm.line_dedup import build
from vaultline.llm.mixing import replicate
from vaultline.llm.ngram_jaccard import keep_one
from vaultline.llm.toxicity import keep_clean


def _same_columns(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with ``n_chars`` measured again."""
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of low expected severity; the others go."""
    return keep_clean(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that another document owns go; every document stays."""
    # Only id and text enter the operator's own columns, so any other column
    # name of the input is safe; the rest is carried in one struct.
    packed = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    out = build(packed).dedup(packed)
    text = F.when(F.col("row.text").isNull() & (F.col("text") == ""), F.lit(None)).otherwise(F.col("text"))
    columns = [text.alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    return _same_columns(out.select(*columns), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are removed from the texts."""
    return _same_columns(remove_spans(docs, table(spark, sf_dir, "benchmark")), docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated to equal source shares and shuffled."""
    return replicate(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mixing", mixing),
]

#: The classifier, the language of the benchmark search and the group search
#: are not expressible in SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

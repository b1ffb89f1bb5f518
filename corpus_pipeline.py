"""A training corpus in five stages, each written as Parquet and read again as the documents of the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.decontamination import leak_free
from tierline.llm.mixing import mixed
from tierline.llm.ngram_join import one_text_of_each
from tierline.llm.pii import redacted
from tierline.llm.quality import clean
from tierline.llm.shared import settled


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without their failing lines."""
    return clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: of the smallest id, or of none where no member has one."""
    return one_text_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return leak_free(docs, benchmark)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind."""
    return redacted(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, a row each with `repeats`, the number of times."""
    packed = docs.select("doc_id", "source", "text", F.struct("*").alias("row"))
    taken = mixed(packed).where("m_repeats > 0")
    return taken.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != "repeats"], F.col("m_repeats").alias("repeats"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
]

#: Near duplicates, the latent search and the redactions are not SQL; tests hold run() against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of sources made from the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

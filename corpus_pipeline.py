"""The corpus pipeline: stages over the documents table, each written and reread.

Language ID drops documents without a recognised language, the Jaccard join keeps
one document of each group of near duplicates, the secret scan marks secrets in
the texts, the mix repeats and drops documents to the sources' weights, packing
makes token sequences of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from verdictlake.llm.common import written
from verdictlake.llm.language import recognised
from verdictlake.llm.mixing import mixed_documents
from verdictlake.llm.packing import pack_documents
from verdictlake.llm.secrets import redacted
from verdictlake.llm.signature_join import without_near_duplicates

TOKENIZER = "byte_bpe_50k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters, or without a likely language, go; all others stay."""
    return recognised(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document with the least id stays."""
    return without_near_duplicates(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts become marks; every document stays."""
    return redacted(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their weights: a row per epoch that takes a document,
    so a document may come twice, the second time cut at its source's budget."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of the mix, packed: a row per piece. A document that the mix
    repeats has pieces of each of its rows."""
    return pack_documents(docs, TOKENIZER, with_ids=False)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("secret_scan", secret_scan),
          ("mixing", mixing), ("packing", packing)]

# Networks, set digests and tokenizers are beyond SQL; tests hold the stages
# against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""From raw documents to packed training sequences.

Each stage takes whole documents, decides by one operator, and returns the documents it keeps with all their columns; the
last returns where every piece of a document lies in the packed sequences. Between stages the rows are stored in the shared
folder, so a lost executor never reaches back beyond one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trustlake.llm.contamination import without_leaks
from trustlake.llm.exact_dedup import without_copies
from trustlake.llm.packing import pack
from trustlake.llm.quality import fit, good_documents
from trustlake.llm.simhash import one_per_group
from trustlake.session import lineage_cut


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier fitted on the labels accepts."""
    return good_documents(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The longest, then first, of documents that are equal but for white space."""
    return without_copies(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group linked by fingerprints of three-word shingles within two bits."""
    return one_per_group(docs, shingle=3, radius=2)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' pieces in sequences of at most 2,048 tokens."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

#: The classifier's and the tokenizer's results are not SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = lineage_cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

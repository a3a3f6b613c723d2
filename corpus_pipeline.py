"""The corpus pipeline: filter, deduplicate, mix and pack ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``.  ``run`` writes each stage's result as
Parquet under the shared folder and rereads it for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quotelake.llm.common import read_table, tokenizer_path, written
from quotelake.llm.line_dedup import line_dedup_filter
from quotelake.llm.mixing import mix_filter
from quotelake.llm.ngram_join import near_duplicate_filter
from quotelake.llm.packing import pack_documents
from quotelake.llm.quality_rules import calibrated, quality_filter


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base counts and the compression bands, whose limits are measured over ``docs``."""
    return quality_filter(docs, calibrated(docs))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated lines; ``n_chars`` follows the text."""
    return line_dedup_filter(docs, size_col="n_chars" if "n_chars" in docs.columns else None)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near duplicates."""
    return near_duplicate_filter(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample raked to the source, language and topic weights."""
    return mix_filter(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining documents and their places in sequences."""
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("mixing sources to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

# Compression ratios, tokens and the packing plan have no SQL form; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, "pipeline-" + name.replace(" ", "-"))
    return docs

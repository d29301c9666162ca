"""From raw documents to packed token sequences, in five stages.

Every stage takes the rows its predecessor kept, reread from Parquet in the shared folder, so a
lost executor costs no stage before the running one. All stages but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import decontam, packing, pii, quality, simhash
from tidewatch.llm.common import drop_stage_tables, read, stage_table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: that of the smallest doc_id."""
    return simhash.keep_first(docs)


def unknown_to_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids with their places in the sequences."""
    return packing.crc(packing.pack(docs))


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", one_of_each),
    ("decontamination", unknown_to_benchmark),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

#: Classifiers and tokenizers cannot be written as SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the last one's rows.

    What a stage has stored on its way is removed once its result is written.
    """
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop_stage_tables(spark, keep=docs)
    return STAGES[-1][1](spark, docs, sf_dir)

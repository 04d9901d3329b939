"""The corpus pipeline: documents through toxicity, near copies, decontamination, personal data and packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. The first four
return the columns they got: the first three drop rows, the fourth rewrites
texts. The last packs what is left and returns one row for each piece of a
document. Null and empty texts, rows without an id and columns beyond those of
documents are kept; rows that repeat an id are judged each by its own text, and of
equal ones the second stage keeps one. Empty tables give empty tables. ``run`` writes each stage's rows as Parquet in the shared folder and
gives the next stage what it reads back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from braidflow.llm import decontamination, encoding, jaccard_join, packing, pii, toxicity
from braidflow.llm.common import shared_dir


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 2048 tokens, with the crc32 of each piece's ids.

    A null or empty text is the end token alone; rows that repeat an id are documents of their own.
    """
    pieces = packing.pack(docs, encoding.default_path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", toxicity.drop_toxic),
    ("ngram_jaccard_join", jaccard_join.drop_copies),
    ("decontamination", decontamination.drop_contaminated),
    ("pii", pii.redact_documents),
    ("packing", packed),
]

#: SQL has no tokenizer, no trained classifier and no EM; tests hold run() against a plain version in Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        at = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
    return docs

"""A training corpus from the documents table: judged, deduplicated, mixed and encoded.

Each stage takes what its predecessor kept; all but the last return the columns of documents, and columns that
documents has besides go with their rows.

Defined results: null text counts as empty; rows with a null identifier are judged, deduplicated and mixed like
others, and are never learnt from; of equal texts one row stays, so repeated rows do too; rows equal in
identifier and text that come to the near-duplicate stage stay or go together; ties are broken by identifiers and digests of
texts; very long texts are read whole; an empty table gives an empty result with the same columns at every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm import bpe, exact_dedup, minhash, mixing, quality_model
from quillstone.llm.common import delete_folder, file_order, free_shuffles, shared_folder, table
from quillstone.llm.queries import VOCABULARY, held_out


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects go."""
    trees = quality_model.fit(docs, table(spark, sf_dir, "labels").where(~held_out()))
    scored = quality_model.score(docs, trees, docs.columns)
    return scored.where(F.col("score") >= quality_model.CUT).drop("score")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the smallest doc_id stays."""
    free_shuffles(spark)
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup (five words, similarity 0.8): one document of each group stays."""
    free_shuffles(spark)
    return minhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights: documents as often as the mix takes them, in training order."""
    free_shuffles(spark)
    return mixing.training_order(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: ids and digests for each row of the mix; position is its place in the training order, rising with gaps."""
    free_shuffles(spark)
    return bpe.encode_documents(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, keep=(file_order().alias("position"),))


STAGES = [("quality classifier", keep_good), ("exact dedup", drop_copies), ("MinHash near-dedup", drop_near_copies), ("mixing sources", mix_sources), ("byte-level BPE", encode)]
#: The classifier's training and the tokenizer can't be expressed in SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written as Parquet and read again by the next; a stage's folder goes when the next one's is written."""
    import uuid

    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
            if k:
                delete_folder(spark, f"{folder}/{k - 1}")
    return docs

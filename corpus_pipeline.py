"""A training-data pipeline of five stages, each of which works on all that the one before it kept.

Stages take (spark, docs, sf_dir) and return a DataFrame; the stages before the last return the columns of
``documents``. The last one returns a row per document that is left: doc_id, n_tokens, ids_sha256,
decoded_sha256 and the ids as little-endian unsigned 32-bit integers.

Nulls, empty texts, repeated rows and extra columns: as the operators' docstrings say. Documents without
a text fail the quality rules, so none reaches the later stages.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm.anchored_pii import redact
from corpusloom.llm.byte_bpe import encode_documents
from corpusloom.llm.common import documents, shared_dir
from corpusloom.llm.compression_bands import keep_good
from corpusloom.llm.queries import BYTE_BPE, SEED, WEIGHTS, domain_of_source
from corpusloom.llm.simhash import keep_one
from corpusloom.llm.source_mixing import mix

#: The part of the tokens left that the mix may use, in one epoch.
SHARE = (4, 5)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the word rules or the compression bands reject go."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, the one of smallest id."""
    return keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to the mark of its kind; n_chars is the new length."""
    return redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each leaf of the domain-language-source tree gives documents up to its budget."""
    return mix(docs, WEIGHTS, SEED, max_epochs=1, share=SHARE, domain=domain_of_source())


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the hash of what they decode to."""
    return encode_documents(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("source mix", source_mix),
    ("byte-level BPE", byte_bpe),
]

#: SQL has no zstandard, XXH64 or BPE; ``tests/llm`` holds every stage against a brute-force version.
ORACLE_SQL = None


def remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each one's result written to the shared folder and read again.

    A result is removed once the next one is written; only the last, which the returned table reads, stays.
    """
    docs = documents(spark, sf_dir)
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            out.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
            if k:
                remove(spark, f"{folder}/{k - 1}")
    return out

"""The training-data pipeline: documents in, packed token sequences out, one operator a stage.

Every stage takes all that the one before kept.  ``run`` stores each stage's result in the session's
shared checkpoint folder and reads it again, as a driver that calls STAGES one by one would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.jobs import drop_stage, write_stage
from tillroll.llm.minhash import deduplicated
from tillroll.llm.mixing import mixed_documents
from tillroll.llm.packing import pack
from tillroll.llm.pii import pseudonymised
from tillroll.llm.quality import scored
from tillroll.llm.queries import pseudonym_key, quality_model, tokenizer_path

# bytes of text that a worker packs at once
PACKING_CHUNK = 1 << 20


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of 0.5 or more, so a tie stays).

    Null and empty texts are scored by their one feature "empty"; repeated rows and null ids are scored row
    by row; without labels every score is 0.5 and all stay.  Columns stay as they are.
    """
    return scored(docs, quality_model(spark, sf_dir)).where("predicted = 1").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: that of the smallest doc_id (five words, 0.8 or more).

    Rows are compared and go one by one, also those that share a doc_id (of equal ones the one read first
    stays) or have none; null, empty and blank texts all stay; an empty table stays empty.
    """
    return deduplicated(docs, shingle=5, percent=80)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by pseudonyms of the same format; ``n_chars`` follows the new text.

    Null texts stay null, with a null ``n_chars``; texts without personal data stay as they are, row by row.  The
    key is the session's (``pseudonym_key``).
    """
    return pseudonymised(docs, pseudonym_key(spark)).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the source mix draws them; what it draws twice is there twice.

    Null sources are a source; null and empty texts have no words and are not drawn; a repeated row is drawn for
    itself; an empty table stays empty.
    """
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece's place in sequences of 4,096 tokens.

    Null and empty texts are one piece of the end token; repeated rows are packed once each; an empty table
    gives no pieces.  Executors still hold what the earlier stages took, so less text is handled at once.
    """
    return pack(docs, tokenizer_path("word_bpe_49k.json"), chunk=PACKING_CHUNK)


STAGES = [("quality classifier", quality), ("MinHash near-dedup", near_duplicates), ("PII", pii),
          ("source mixing", mixing), ("best-fit packing", packing)]

# the classifier's scores, hash permutations and the tokenizer have no SQL form;
# tests/llm/test_pipeline.py compares the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = None
    for _, stage in STAGES[:-1]:
        docs = write_stage(stage(spark, docs, sf_dir), "stage")
        if kept is not None:
            drop_stage(spark, kept)
        kept = docs
    return STAGES[-1][1](spark, docs, sf_dir)

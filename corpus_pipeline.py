"""A training corpus from the table ``documents``: five stages, each the next one's input.

Toxic documents go, one document of each near-duplicate group stays, documents
with benchmark passages go, secrets are redacted, and what is left is packed
into windows. Every stage but the last returns the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from pathloom.llm import decontam, jaccard, packing, secret_scan, toxicity
from pathloom.llm.common import checkpoint_dir, documents
from pathloom.sources import sinks


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.reject(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, keep_ids=False).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack_windows),
]

#: No stage from the first on can be said in SQL: a trained classifier, sets of XXH64 hashes and a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder that the next one reads.

    A stage's table is removed once the next one is written; that of the last stays, as the result is read from it.
    """
    docs, last = documents(spark, sf_dir), None
    base = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        path = f"{base}/{i}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if last:
            sinks.remove(spark, last)
        last = path
    return docs

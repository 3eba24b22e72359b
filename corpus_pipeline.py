"""A corpus pipeline: documents through five stages, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lexflume.llm import line_dedup, minhash, mixing, packing, quality_rules
from lexflume.llm.common import shared_folder

#: Each takes (spark, docs, sf_dir). All but the last return the columns of documents.
STAGES = [
    ("quality_rules", quality_rules.stage),
    ("line_dedup", line_dedup.stage),
    ("minhash", minhash.stage),
    ("mixing", mixing.stage),
    ("packing", packing.stage),
]

#: The estimates of the first stage and the hashes of others have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs

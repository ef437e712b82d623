"""The corpus pipeline: documents in, packed training sequences out.

``STAGES`` lists the stages in order. Each takes ``(spark, docs, sf_dir)``, works on all that
the stage before it kept, and all but the last return the columns of ``documents``. ``run``
writes each stage's result as Parquet in the shared scratch folder and reads it back as the
next one's input, so a lost executor costs at most the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rillflow.llm import mixing, packing, quality, simhash, substring
from rillflow.llm.common import stored

STAGES = [
    ("quality_rules", quality.quality_stage),
    ("simhash_near_dedup", simhash.simhash_stage),
    ("substring_dedup", substring.substring_stage),
    ("mixing", mixing.mix_stage),
    ("packing", packing.packing_stage),
]

#: No SQL: rule accuracies come from expectation-maximisation, tokens from a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences made from ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""From raw documents to a training mix, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, which is written as Parquet and read again as the next one's docs;
all but the last return the columns of documents. The stages, and what they do with odd rows, are in tramlake.llm.stages.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tramlake.llm import stages
from tramlake.llm.common import shared_dir, table

STAGES = [
    ("language ID", stages.language),
    ("quality classifier", stages.good_quality),
    ("SimHash near-dedup", stages.one_of_each),
    ("benchmark decontamination", stages.decontaminated),
    ("mixing sources", stages.mixed),
]
#: Trained stages can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what lies between them is written to the folder that executors share."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        kept = stage(spark, docs, sf_dir)
        kept.write.parquet(path := f"{folder}/{k}")
        docs = spark.read.schema(kept.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

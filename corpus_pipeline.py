"""From raw documents to packed sequences: each stage reads what the one before it wrote.

language_id drops documents whose language is rejected (null texts and texts without a letter among them); near_dedup keeps one document of each
group, and one row of a repeated id; decontamination drops documents that hold a benchmark item; secret_scan replaces secrets in the text and
changes no other column but n_chars; packing gives a row for each piece of what is left. Rows with a null id go through every stage. Repeated rows, ties,
very long texts and clashing names are each operator's own matter (see their docstrings); columns beyond those of documents are carried along to the
last stage. An empty table gives an empty result.

The tables between stages lie in the folder that the session names for checkpoints; a lost executor costs the tasks of one stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm import decontamination, language_id, near_dedup, packing, secrets
from tablewright.llm.common import shared_folder

STAGES = [
    ("language_id", language_id.stage),
    ("near_dedup", near_dedup.stage),
    ("decontamination", decontamination.stage),
    ("secret_scan", secrets.stage),
    ("packing", packing.stage),
]

#: The stages learn models and follow links, which SQL does not state; tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents. Each result is a table in the folder that the session names for checkpoints."""
    base = shared_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/corpus-{uuid.uuid4().hex}-{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

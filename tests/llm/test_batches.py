"""Arrow batches of the document operators."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from tablewright.llm.common import BATCH_ROWS, in_short_batches, map_batches


def test_short_batches_come_from_spark(spark):
    """Executors never hold a session's usual batch of 10,000 texts, and the caller's session keeps its settings."""
    before = spark.conf.getAll
    docs = spark.range(0, 3000, 1, 2).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"))

    def sizes(batches):
        for batch in batches:
            # The rows of the buffers that Spark sent, not those of a slice of them.
            whole = batch.column("doc_id").buffers()[1].size // 8
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([whole])], ["n", "whole"])

    n, whole = map_batches(docs, sizes, "n long, whole long").agg(F.sum("n"), F.max("whole")).first()
    assert n == 3000
    assert whole <= 2 * BATCH_ROWS
    assert spark.conf.getAll == before
    assert spark.catalog.listTables("global_temp") == []
    assert in_short_batches(docs).exceptAll(docs).count() == 0

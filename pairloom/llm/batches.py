"""The size of the batches that travel between Spark and Python."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Rows of a batch.  Spark's own 10,000 are right for numbers; of whole texts they would be a task's memory.
ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds of a table of texts; a session's lower setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > ROWS:
        spark.conf.set(name, str(ROWS))

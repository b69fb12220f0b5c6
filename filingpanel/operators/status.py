"""Statistics over the outcome of processing files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_statistics(status: DataFrame) -> DataFrame:
    """Per entity type: processed and skipped quarters, records, mean columns (whole number).

    ``status`` has ``(entity_type, quarter, state, records, columns)`` with the states
    ``processed``, ``skipped`` and ``error``.
    """
    done = F.col("state") == "processed"
    processed = F.count_if(done)
    columns = F.sum(F.when(done, F.col("columns")))
    return status.groupBy("entity_type").agg(
        processed.alias("processed"),
        F.count_if(F.col("state") == "skipped").alias("skipped"),
        F.count_if(F.col("state") == "error").alias("errors"),
        F.coalesce(F.sum(F.when(done, F.col("records"))), F.lit(0)).alias("records"),
        F.floor(F.try_divide(columns, processed)).cast("bigint").alias("avg_columns"),
    )


def state_counts(status: DataFrame) -> DataFrame:
    """Files per state."""
    return status.groupBy("state").agg(F.count("*").alias("files"))

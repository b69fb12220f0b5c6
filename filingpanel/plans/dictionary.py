"""From a dictionary export to the stored dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from filingpanel.operators.dictionary import build_dictionary
from filingpanel.sinks.panel import write_dictionary
from filingpanel.sources.dictionary import read_dictionary, read_dictionary_csv


def store_dictionary(spark: SparkSession, export: str, folder: str) -> DataFrame:
    """Read a dictionary export, build the dictionary, write it, and return the stored table."""
    _, parquet = write_dictionary(build_dictionary(read_dictionary_csv(spark, export)), folder)
    return read_dictionary(spark, parquet)

"""Whole-column numeric inference over long text values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingpanel.functions.text import parse_number


def numeric_verdicts(cells: DataFrame, column_keys: Sequence[str], raw: str = "raw") -> DataFrame:
    """``(*column_keys, n_values, n_text, is_numeric)``: a column is numeric if every value parses.

    The two counters combine map-side, so a column with very many rows costs no more shuffle
    than any other.
    """
    value = F.col(raw)
    return (
        cells.groupBy(*column_keys)
        .agg(
            F.count(value).alias("n_values"),
            F.count_if(value.isNotNull() & parse_number(value).isNull()).alias("n_text"),
        )
        .withColumn("is_numeric", F.col("n_text") == 0)
    )


def typed_values(cells: DataFrame, verdicts: DataFrame, column_keys: Sequence[str], raw: str = "raw") -> DataFrame:
    """Replace ``raw`` by ``num_value`` or, for columns that are not numeric, ``str_value``.

    Only the columns found to be text are joined back. They are few, so the runtime statistics
    let the planner broadcast them; were they many, skewed keys of the big side are split.
    """
    text = verdicts.where(~F.col("is_numeric")).select(*column_keys, F.lit(True).alias("_text"))
    joined = cells.join(text, list(column_keys), "left")
    value = F.col(raw)
    is_text = F.col("_text").isNotNull()
    return joined.select(
        "*",
        F.when(~is_text, parse_number(value)).alias("num_value"),
        F.when(is_text, value).alias("str_value"),
    ).drop(raw, "_text")

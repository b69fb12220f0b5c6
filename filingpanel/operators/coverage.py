"""Coverage of the panel: counts per entity type and quarter, and statistics over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingpanel.constants import LEAD_COLUMNS
from filingpanel.functions.periods import quarter_label


def filer_counts(
    filers: DataFrame, group: Sequence[str] = ("entity_type", "quarter"), filer: str = "filer_id", period: str = "period"
) -> DataFrame:
    """``(*group, date, num_rows, num_banks)``: distinct filers, null ids not counted.

    The distinct count first reduces to (group, filer), so a group that holds most of the rows
    is spread over all tasks.
    """
    return filers.groupBy(*group).agg(
        F.min(period).alias("date"),
        F.count("*").alias("num_rows"),
        F.count_distinct(filer).alias("num_banks"),
    )


def variable_counts(catalog: DataFrame, group: Sequence[str] = ("entity_type", "quarter")) -> DataFrame:
    """``(*group, num_variables, num_non_null_vars, num_null_columns)`` from the column catalog."""
    per_variable = (
        catalog.where(~F.upper("variable").isin(*LEAD_COLUMNS))
        .groupBy(*group, "variable")
        .agg(F.sum("n_values").alias("n_values"))
    )
    return per_variable.groupBy(*group).agg(
        F.count("*").alias("num_variables"),
        F.count_if(F.col("n_values") > 0).alias("num_non_null_vars"),
        F.count_if(F.col("n_values") == 0).alias("num_null_columns"),
    )


def coverage_summary(
    filers: DataFrame,
    catalog: DataFrame,
    sizes: DataFrame | None = None,
    group: Sequence[str] = ("entity_type", "quarter"),
) -> DataFrame:
    """One row per entity type and quarter: date, filers, variables, null columns, size.

    ``sizes`` may add ``(*group, file_size_mb, file_path)`` from a file listing.
    """
    group = list(group)
    summary = filer_counts(filers, group).join(variable_counts(catalog, group), group, "left")
    counts = ("num_variables", "num_non_null_vars", "num_null_columns")
    summary = summary.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})
    return summary if sizes is None else summary.join(sizes, group, "left")


def _only(column: Column) -> Column:
    """Aggregate: the single value of a group; an error where there are several."""
    return F.when(F.count("*") > 1, F.raise_error(F.lit("more than one row for a quarter and entity type"))).otherwise(
        F.first(column)
    )


def pivot_quarters(
    summary: DataFrame,
    entities: Sequence[str],
    values: Sequence[str] = ("num_banks", "num_variables"),
    date: str = "date",
) -> DataFrame:
    """One row per quarter with ``<entity>_<value>`` columns and the quarter's first date.

    A repeated (quarter, entity type) is an error. The summary has one row per entity type and
    quarter, so everything here is small; the entity types are given, which spares a job.
    """
    unique = summary.groupBy("quarter", "entity_type").agg(
        *[_only(F.col(v)).alias(v) for v in values], F.min(date).alias("_date")
    )
    aggregates = []
    for entity in entities:
        for value in values:
            picked = F.when(F.col("entity_type") == entity, F.col(value))
            aggregates.append(F.max(picked).alias(f"{entity}_{value}"))
    return unique.groupBy("quarter").agg(F.min("_date").alias("date"), *aggregates).orderBy("quarter")


def entity_statistics(summary: DataFrame) -> DataFrame:
    """Per entity type: quarters, mean filers, mean variables, total size, first and last date."""
    return summary.groupBy("entity_type").agg(
        F.count("*").alias("quarters"),
        F.avg("num_banks").alias("avg_filers"),
        F.avg("num_variables").alias("avg_variables"),
        *([F.sum("file_size_mb").alias("total_mb")] if "file_size_mb" in summary.columns else []),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


def overall_statistics(summary: DataFrame) -> DataFrame:
    """One row: number of quarters, date range, and mean/min/max of every count."""
    counts = [
        c
        for c in ("num_banks", "num_variables", "num_non_null_vars", "num_null_columns")
        if c in summary.columns
    ]
    per_count = [f(c).alias(f"{c}_{n}") for c in counts for n, f in (("avg", F.avg), ("min", F.min), ("max", F.max))]
    return summary.agg(
        F.count("*").alias("quarters"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        *per_count,
        *([F.sum("file_size_mb").alias("total_mb")] if "file_size_mb" in summary.columns else []),
    )


def with_quarter_parts(summary: DataFrame, date: str = "date") -> DataFrame:
    """Add ``year`` and ``quarter_num``, as the exported summary has them."""
    return summary.withColumns({"year": F.year(date), "quarter_num": F.quarter(date)})


def tag_quarter(df: DataFrame, date: str, name: str = "quarter") -> DataFrame:
    """Add the quarter label of a date."""
    return df.withColumn(name, quarter_label(date))

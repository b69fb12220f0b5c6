"""Column profiles, and pruning of columns that are neither on the form nor filled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingpanel.constants import ALWAYS_KEEP_HISTORICAL
from filingpanel.operators.entities import entity_forms_of


def present(df: DataFrame, column: str) -> Column:
    """Whether a value is neither NULL nor NaN."""
    value = F.col(f"`{column}`")
    if df.schema[column].dataType.typeName() in ("double", "float"):
        return value.isNotNull() & ~F.isnan(value)
    return value.isNotNull()


def profile_columns(df: DataFrame, columns: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """``(*group, variable, n_values, all_null)``: all columns counted in one pass over the rows."""
    counts = df.groupBy(*group).agg(*[F.count_if(present(df, c)).alias(c) for c in columns])
    return counts.unpivot(list(group), list(columns), "variable", "n_values").withColumn(
        "all_null", F.col("n_values") == 0
    )


def forms_overlap(forms: Column, allowed: Column) -> Column:
    """Whether a comma-joined list of forms and an array of forms have one in common."""
    return F.coalesce(F.arrays_overlap(F.split(forms, ","), allowed), F.lit(False))


def on_form(df: DataFrame, key: str, forms: DataFrame, form_key: str, form: str, allowed: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key has at least one of the allowed forms (semi-join)."""
    hits = forms.where(F.col(form).isin(*allowed)).select(F.col(form_key).alias(key)).distinct()
    return df.join(hits, key, "left_semi")


def prune_catalog(
    catalog: DataFrame,
    dictionary: DataFrame | None = None,
    always_keep: Sequence[str] = ALWAYS_KEEP_HISTORICAL,
    allowed: Column | None = None,
) -> DataFrame:
    """Catalog rows to keep: always kept, on one of the entity type's forms, or with data.

    ``catalog`` has ``(entity_type, quarter, variable, n_values, ...)``. A variable with data is
    always kept, so the fact table itself never has to be filtered: pruning is a decision over
    the far smaller catalog.
    """
    keep = F.upper("variable").isin(*always_keep) | (F.col("n_values") > 0)
    if dictionary is None:
        return catalog.where(keep)
    allowed = entity_forms_of(F.col("entity_type")) if allowed is None else allowed
    forms = dictionary.select(
        F.col("Variable").alias("_variable"), F.col("ReportingForms").alias("_forms")
    )
    return (
        catalog.join(forms, F.upper(catalog["variable"]) == forms["_variable"], "left")
        .where(keep | forms_overlap(F.col("_forms"), allowed))
        .select(catalog["*"])
    )


def columns_on_form(dictionary: DataFrame, columns: Sequence[str], allowed: Sequence[str]) -> set[str]:
    """Those of ``columns`` that are on an allowed form. The driver sees at most one row per column."""
    names = {c.upper() for c in columns}
    allowed_array = F.array(*[F.lit(a) for a in allowed])
    rows = (
        dictionary.where(F.col("Variable").isin(*names) & forms_overlap(F.col("ReportingForms"), allowed_array))
        .select("Variable")
        .distinct()
        .collect()
    )
    listed = {r["Variable"] for r in rows}
    return {c for c in columns if c.upper() in listed}


def prune_columns(
    df: DataFrame,
    allowed: Sequence[str],
    dictionary: DataFrame | None = None,
    always_keep: Sequence[str] = ALWAYS_KEEP_HISTORICAL,
) -> DataFrame:
    """Drop the columns of a wide table that are neither on an allowed form nor filled anywhere.

    One aggregation over only the columns still in doubt; the driver sees its single row.
    """
    kept = {c for c in df.columns if c.upper() in always_keep}
    if dictionary is not None:
        kept |= columns_on_form(dictionary, df.columns, allowed)
    doubtful = [c for c in df.columns if c not in kept]
    if doubtful:
        filled = df.agg(*[F.bool_or(present(df, c)).alias(c) for c in doubtful]).head()
        kept |= {c for c in doubtful if filled[c]}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in kept])

"""Splitting filers into entity types, and period conditions on them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingpanel.constants import CUTOFF_ENTITY, CUTOFF_PERIOD, ENTITY_CODES, ENTITY_FORMS


def entity_type_of(code: Column, codes: Mapping[str, Sequence[int]] = ENTITY_CODES) -> Column:
    """The entity type of a filer type code; null for codes that belong to none.

    A fixed mapping of a few codes is a CASE expression: the split needs neither a join nor one
    filter pass per type.
    """
    return F.coalesce(*[F.when(code.isin(*values), F.lit(name)) for name, values in codes.items()])


def entity_forms_of(entity_type: Column, forms: Mapping[str, Sequence[str]] = ENTITY_FORMS) -> Column:
    """The names of the forms an entity type files, as ARRAY<STRING>."""
    return F.coalesce(
        *[F.when(entity_type == name, F.array(*[F.lit(v) for v in values])) for name, values in forms.items()],
        F.array().cast("array<string>"),
    )


def split_entities(
    df: DataFrame,
    code: str,
    codes: Mapping[str, Sequence[int]] = ENTITY_CODES,
    name: str = "entity_type",
) -> DataFrame:
    """Add the entity type and drop rows whose code belongs to none. One pass, no shuffle."""
    return df.withColumn(name, entity_type_of(F.col(code), codes)).where(F.col(name).isNotNull())


def split_by_table(df: DataFrame, code: str, entity_map: DataFrame) -> DataFrame:
    """As ``split_entities`` with the mapping in a table ``(code, entity_type, ...)``.

    No broadcast hint: the planner broadcasts the table where its size allows that.
    """
    return df.join(entity_map.withColumnRenamed("code", code), code, "inner")


def apply_cutoff(
    df: DataFrame,
    entity: str = "entity_type",
    period: str = "period",
    cutoff_entity: str = CUTOFF_ENTITY,
    last: dt.date = CUTOFF_PERIOD,
) -> DataFrame:
    """Drop the rows of one entity type after its last period; other types and undated rows stay."""
    late = (F.col(entity) == cutoff_entity) & (F.col(period) > F.lit(last))
    return df.where(~F.coalesce(late, F.lit(False)))


def in_period_range(
    df: DataFrame,
    period: str,
    start: dt.date | None = None,
    end: dt.date | None = None,
    keep_undated: bool = False,
    quarter: str | None = None,
) -> DataFrame:
    """Rows with start <= period <= end. Undated rows are dropped, or kept on request.

    ``quarter`` names a column with the quarter (``YYYYQn``) of the period, such as the panel's partition column:
    a range on it follows from that on the period, and keeps other partitions from being listed and read.
    """
    column = F.col(period)
    inside = column.isNotNull()
    if start is not None:
        inside = inside & (column >= F.lit(start))
    if end is not None:
        inside = inside & (column <= F.lit(end))
    rows = df.where(column.isNull() | inside) if keep_undated else df.where(inside)
    if quarter is None or start is None and end is None:
        return rows
    label = F.col(quarter)
    within = label.isNotNull()
    if start is not None:
        within = within & (label >= _label(start))
    if end is not None:
        within = within & (label <= _label(end))
    return rows.where(label.isNull() | within) if keep_undated else rows.where(within)


def _label(date: dt.date) -> str:
    return f"{date.year:04d}Q{(date.month + 2) // 3}"

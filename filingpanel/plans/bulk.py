"""Bulk archives of tab-delimited schedules to the panel of commercial banks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingpanel.constants import ALWAYS_KEEP_BULK, CUTOFF_ENTITY
from filingpanel.functions.periods import QUARTER_END, period_from_bulk_name, quarter_label, reporting_period
from filingpanel.functions.text import parse_number
from filingpanel.operators.inference import numeric_verdicts
from filingpanel.operators.prune import prune_catalog
from filingpanel.plans.panel import (
    Panel,
    check_duplicate_rule,
    excluded_members,
    headers_of,
    member_errors,
    member_table,
    outcomes,
    quarter_status,
    staged_rows,
    with_occurrence,
    without_members,
)
from filingpanel.session import recorded, staged
from filingpanel.sources.cells import OUT_OF_RANGE, ROWS, SKIPPED, UNDATED
from filingpanel.sources.delimited import read_delimited
from filingpanel.sources.files import list_files, plain_name

LISTED = "*.{txt,csv,zip}"


def undated_files(spark: SparkSession, paths, pattern: str = LISTED) -> DataFrame:
    """Files whose name holds no quarter; they are left out of the panel."""
    files = list_files(spark, paths, pattern)
    return files.where(period_from_bulk_name("file_name").isNull())


def bulk_panel(
    spark: SparkSession,
    paths,
    dictionary: DataFrame | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    skip_quarters: Sequence[str] = (),
    period_style: str = QUARTER_END,
    on_duplicate: str = "first",
) -> Panel:
    """Read, merge, type and prune all bulk archives below ``paths``.

    Quarter, date range and quarters to skip are decided from the file names, before any file
    is opened. The decoded rows are written once, as three tables are derived from them.
    """

    def state_of(name) -> Column:
        period = period_from_bulk_name(name)
        state = F.when(period.isNull(), UNDATED)
        if start is not None:
            state = state.when(period < F.lit(start), OUT_OF_RANGE)
        if end is not None:
            state = state.when(period > F.lit(end), OUT_OF_RANGE)
        return state.when(quarter_label(period).isin(*skip_quarters), SKIPPED) if skip_quarters else state

    listing = list_files(spark, paths, LISTED).select(
        "path", quarter_label(period_from_bulk_name("file_name")).alias("quarter"), state_of("file_name").alias("state")
    )
    with recorded() as folders:
        decoded = staged_rows(read_delimited(spark, paths, state_of(plain_name()).isNull()), "bulk")
        panel = assemble_bulk(decoded, dictionary, period_style, on_duplicate, listing)
    return replace(panel, folders=tuple(folders))


def assemble_bulk(
    decoded: DataFrame,
    dictionary: DataFrame | None = None,
    period_style: str = QUARTER_END,
    on_duplicate: str = "first",
    listing: DataFrame | None = None,
    earlier: DataFrame | None = None,
) -> Panel:
    """The panel from decoded rows, written by ``staged_rows``: they are read several times."""
    check_duplicate_rule(on_duplicate)
    dated = decoded.withColumns(
        {
            "entity_type": F.lit(CUTOFF_ENTITY),
            "quarter": quarter_label("period"),
            "period": reporting_period("period", period_style),
        }
    )
    members = member_table(dated)
    excluded = excluded_members(members, on_duplicate, earlier)
    used = without_members(dated, excluded)
    rows = with_occurrence(used.where(F.col("kind") == ROWS))
    columns = staged(_merged_columns(used, rows), "columns")
    keys = ("entity_type", "quarter", "period", "filer_id", "occurrence")
    catalog = columns.where("first").select(
        "entity_type",
        "quarter",
        "member_ordinal",
        "variable",
        F.when(F.col("is_numeric"), "double").otherwise("string").alias("dtype"),
        "ordinal",
        "n_values",
    )
    filers = rows.select(*keys).distinct().withColumn("entity_code", F.lit(None).cast("int"))
    kept = prune_catalog(catalog, dictionary, ALWAYS_KEEP_BULK)
    status = quarter_status(filers, kept, member_errors(dated, F.lit(CUTOFF_ENTITY)))
    if listing is None:
        listing = members.select("path", "quarter", F.lit(None).cast("string").alias("state")).distinct()
    inputs = staged(outcomes(listing, members, excluded, "bulk"), "inputs")
    values = _with_verdicts(rows, columns, keys)

    def expand(joined: DataFrame) -> DataFrame:
        return _typed_values(joined, keys)

    return Panel(expand(values), filers, kept, status, inputs, values, expand)


def _merged_columns(used: DataFrame, rows: DataFrame) -> DataFrame:
    """Every column of every member: whether it is the first of its name, its values, its type.

    Of a column in several members the first member's wins, even where it is empty.
    """
    member = ["path", "member_ordinal"]
    headers = headers_of(used, "entity_type", "quarter", *member).drop("kind")
    first = headers.groupBy("path", "variable").agg(F.min(F.struct("member_ordinal", "ordinal")).alias("_first"))
    cells = rows.select(*member, F.explode("cells").alias("_c")).select(*member, "_c.ordinal", "_c.raw")
    verdicts = numeric_verdicts(cells, [*member, "ordinal"])
    place = F.struct("member_ordinal", "ordinal")
    return (
        headers.join(first, ["path", "variable"])
        .withColumn("first", place == F.col("_first"))
        .join(verdicts, [*member, "ordinal"], "left")
        .select(
            headers["*"],
            "first",
            F.coalesce("n_values", F.lit(0)).alias("n_values"),
            F.coalesce("is_numeric", F.lit(True)).alias("is_numeric"),
        )
    )


def _with_verdicts(rows: DataFrame, columns: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the verdicts on their member's columns, as one array by column position.

    They join before the values are exploded: one lookup per filer row instead of one per value.
    """
    member = ["path", "member_ordinal"]
    verdict = F.when(F.col("first"), F.col("is_numeric"))
    by_position = F.array_sort(F.collect_list(F.struct("ordinal", verdict.alias("numeric"))))
    verdicts = columns.groupBy(*member).agg(F.transform(by_position, lambda c: c["numeric"]).alias("_numeric"))
    return rows.join(verdicts, member).select(*keys, "_numeric", "cells")


def _typed_values(joined: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Typed values of the winning columns."""
    exploded = joined.select(*keys, "_numeric", F.explode("cells").alias("_c"))
    typed = exploded.select(
        *keys, "_c.variable", "_c.raw", F.get(F.col("_numeric"), F.col("_c.ordinal")).alias("is_numeric")
    ).where(F.col("is_numeric").isNotNull())
    return typed.select(
        *keys,
        "variable",
        F.when(F.col("is_numeric"), parse_number(F.col("raw"))).alias("num_value"),
        F.when(~F.col("is_numeric"), F.col("raw")).alias("str_value"),
    )

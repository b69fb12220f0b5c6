"""The coverage report of a panel."""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from filingpanel.constants import ENTITY_CODES
from filingpanel.operators.coverage import (
    coverage_summary,
    entity_statistics,
    overall_statistics,
    pivot_quarters,
)
from filingpanel.operators.entities import in_period_range
from filingpanel.operators.gaps import find_gaps, preview_gaps
from filingpanel.operators.inventory import partition_sizes
from filingpanel.sources.files import list_files
from filingpanel.sources.panel import read_panel


@dataclass(frozen=True)
class CoverageReport:
    """The tables of the report, all lazy."""

    summary: DataFrame
    quarters: DataFrame
    entities: DataFrame
    overall: DataFrame
    gaps: DataFrame
    gap_preview: DataFrame


def report_on(
    summary: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    entities: Sequence[str] | None = None,
) -> CoverageReport:
    """All report tables from a summary with one row per entity type and quarter; undated rows stay.

    ``entities`` are the columns of the quarter table; by default those that the summary has, which for
    files without entity folders is the one type they are listed under.
    """
    kept = in_period_range(summary, "date", start, end, keep_undated=True)
    if entities is None:
        entities = sorted(r["entity_type"] for r in kept.select("entity_type").distinct().collect())
    gaps = find_gaps(kept, "date", ["entity_type"])
    return CoverageReport(
        summary=kept.orderBy("entity_type", "date"),
        quarters=pivot_quarters(kept, entities),
        entities=entity_statistics(kept),
        overall=overall_statistics(kept),
        gaps=gaps,
        gap_preview=preview_gaps(gaps, ["entity_type"]),
    )


def coverage_report(
    spark: SparkSession, folder: str, start: dt.date | None = None, end: dt.date | None = None
) -> CoverageReport:
    """The report on a panel written by ``write_panel``."""
    panel = read_panel(spark, folder)
    sizes = partition_sizes(list_files(spark, os.path.join(folder, "facts"), "*.parquet", recursive=True))
    return report_on(coverage_summary(panel.filers, panel.catalog, sizes), start, end, tuple(ENTITY_CODES))

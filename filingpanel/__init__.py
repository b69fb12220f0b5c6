"""Quarterly filing panels on Spark."""

from filingpanel.plans.bulk import bulk_panel
from filingpanel.plans.dictionary import store_dictionary
from filingpanel.plans.historical import historical_panel
from filingpanel.plans.panel import Panel, wide_panel
from filingpanel.plans.report import coverage_report, report_on
from filingpanel.session import build_session
from filingpanel.sinks.panel import write_panel
from filingpanel.sources.panel import read_panel

__all__ = [
    "Panel",
    "build_session",
    "bulk_panel",
    "coverage_report",
    "historical_panel",
    "read_panel",
    "report_on",
    "store_dictionary",
    "wide_panel",
    "write_panel",
]

"""Bringing a stored panel up to date, quarter by quarter."""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingpanel.constants import CUTOFF_ENTITY, ENTITY_CODES, ID_COLUMN, LEAD_COLUMNS, PERIOD_COLUMN
from filingpanel.functions.periods import QUARTER_END
from filingpanel.operators.merge import union_sources
from filingpanel.plans.bulk import bulk_panel
from filingpanel.plans.historical import historical_panel
from filingpanel.plans.panel import PANEL_KEYS, Panel, wide_panel
from filingpanel.sinks.described import write_described
from filingpanel.sinks.panel import write_panel, write_wide
from filingpanel.sources.cells import SKIPPED
from filingpanel.sources.panel import processed_quarters, read_panel

EXPORTS_AT_ONCE = 4


def update_historical(
    spark: SparkSession,
    paths,
    folder: str,
    dictionary: DataFrame | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    force: bool = False,
) -> DataFrame:
    """Add the historical quarters that the panel in ``folder`` lacks; ``force`` rewrites all.

    Returns the status of the run, skipped quarters included. A quarter counts as processed once
    its file was, also if it had no filer of some entity type.
    """
    skip = [] if force else processed_quarters(spark, folder, "historical")
    rule = "last" if force else "first"
    panel = historical_panel(spark, paths, dictionary, start, end, skip, rule)
    return _write(panel, folder, tuple(ENTITY_CODES))


def update_bulk(
    spark: SparkSession,
    paths,
    folder: str,
    dictionary: DataFrame | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    force: bool = False,
    period_style: str = QUARTER_END,
) -> DataFrame:
    """Add the bulk quarters of commercial banks that the panel in ``folder`` lacks."""
    skip = [] if force else processed_quarters(spark, folder, "bulk")
    rule = "last" if force else "first"
    panel = bulk_panel(spark, paths, dictionary, start, end, skip, period_style, rule)
    return _write(panel, folder, (CUTOFF_ENTITY,))


def _write(panel: Panel, folder: str, entities: Sequence[str]) -> DataFrame:
    """Write, and return the run's status: a row for each file given that was skipped, too."""
    write_panel(panel, folder)
    spark = panel.status.sparkSession
    skipped = panel.inputs.where(F.col("state") == SKIPPED).select(
        F.explode(F.array(*map(F.lit, entities))).alias("entity_type"),
        "quarter",
        "state",
        F.lit(0).cast("bigint").alias("records"),
        F.lit(0).cast("bigint").alias("columns"),
        F.lit(None).cast("string").alias("message"),
    )
    rows = union_sources([panel.status, skipped])
    # Read off before the intermediate tables go: one row for each entity type and file.
    status = spark.createDataFrame(rows.collect(), rows.schema)
    panel.release()
    return status


def export_wide(
    spark: SparkSession, folder: str, out: str, dictionary: DataFrame | None = None, published: bool = False
) -> list[str]:
    """Write every entity type's quarters as wide datasets ``out/<entity type>/<quarter>.parquet``.

    Each has its own columns, pruned and described, in the order its kind of archive is published
    in: period, id and the file's own order for historical quarters, id, period and sorted names
    for bulk quarters (whose rows have no entity code). Reads only the quarter's partitions of
    the panel in ``folder``; the driver sees the list of quarters and column names. With ``published``
    a dataset is one plain file, whose fields have their descriptions in their own metadata.
    """
    panel = read_panel(spark, folder)
    datasets = panel.filers.groupBy(*PANEL_KEYS).agg(F.max("entity_code").isNull().alias("bulk"))
    def write(dataset) -> str:
        entity_type, quarter, bulk = dataset
        target = os.path.join(out, entity_type, f"{quarter}.parquet")
        order, rest = ((ID_COLUMN, PERIOD_COLUMN), "sorted") if bulk else (LEAD_COLUMNS, "original")
        wide = wide_panel(panel, entity_type, quarter, dictionary, order, rest)
        if published:
            write_described(wide, target, one_file=True)
        else:
            write_wide(wide, target)
        return target

    # Jobs of their own: some at a time fill the cluster while others end.
    with ThreadPool(EXPORTS_AT_ONCE) as pool:
        return pool.map(write, datasets.orderBy(*PANEL_KEYS).collect(), chunksize=1)

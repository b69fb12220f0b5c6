"""Historical transport files to the panels of all entity types."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingpanel.constants import ALWAYS_KEEP_HISTORICAL
from filingpanel.functions.periods import period_from_call_name, quarter_label
from filingpanel.operators.entities import apply_cutoff, entity_type_of
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
from filingpanel.sources.cells import ROWS
from filingpanel.sources.files import list_files
from filingpanel.sources.xport import PATTERN, name_state, read_xport


def historical_panel(
    spark: SparkSession,
    paths,
    dictionary: DataFrame | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    skip_quarters: Sequence[str] = (),
    on_duplicate: str = "first",
    blank_is_data: bool = True,
) -> Panel:
    """Read, split by entity type and prune all transport files below ``paths``.

    Files are left unopened where their names tell that they are not wanted, and members undecoded.
    """
    files = list_files(spark, paths, PATTERN)
    state = name_state(F.col("file_name"), start, end, skip_quarters)
    listing = files.select("path", quarter_label(period_from_call_name("file_name")).alias("quarter"), state.alias("state"))
    with recorded() as folders:
        decoded = staged_rows(read_xport(spark, paths, start, end, blank_is_data, skip_quarters=skip_quarters), "historical")
        panel = assemble_historical(decoded, dictionary, on_duplicate=on_duplicate, listing=listing)
    return replace(panel, folders=tuple(folders))


def assemble_historical(
    decoded: DataFrame,
    dictionary: DataFrame | None = None,
    on_duplicate: str = "first",
    listing: DataFrame | None = None,
    earlier: DataFrame | None = None,
) -> Panel:
    """The panel from decoded rows, written by ``staged_rows``: they are read several times."""
    check_duplicate_rule(on_duplicate)
    dated = decoded.withColumn("quarter", quarter_label("period"))
    members = member_table(dated)
    excluded = excluded_members(members, on_duplicate, earlier)
    used = without_members(dated, excluded)
    typed = used.withColumn("entity_type", entity_type_of(F.col("entity_code")))
    kept_rows = typed.where(F.col("entity_type").isNotNull() & (F.col("kind") == ROWS))
    rows = with_occurrence(apply_cutoff(kept_rows))

    keys = ("entity_type", "quarter", "period", "filer_id", "occurrence")

    def expand(values: DataFrame) -> DataFrame:
        exploded = values.select(*keys, F.explode("cells").alias("_c"))
        return exploded.select(*keys, "_c.variable", F.col("_c.num").alias("num_value"), F.col("_c.raw").alias("str_value"))

    values = rows.select(*keys, "cells")
    facts = expand(values)
    filers = rows.select(*keys, "entity_code")
    # Each entity type of a quarter has all columns of the quarter's file.
    splits = rows.select("entity_type", "path").distinct()
    headers = headers_of(used, "quarter", "path", "member_ordinal").join(splits, "path")
    counts = facts.groupBy("entity_type", "quarter", "variable").agg(F.count("*").alias("n_values"))
    catalog = headers.join(counts, ["entity_type", "quarter", "variable"], "left").select(
        "entity_type",
        "quarter",
        "member_ordinal",
        "variable",
        F.col("kind").alias("dtype"),
        "ordinal",
        F.coalesce("n_values", F.lit(0)).alias("n_values"),
    )
    kept = staged(prune_catalog(catalog, dictionary, ALWAYS_KEEP_HISTORICAL), "catalog")
    status = quarter_status(filers, kept, member_errors(dated, F.lit(None).cast("string")))
    if listing is None:
        listing = members.select("path", F.lit(None).cast("string").alias("quarter"), F.lit(None).cast("string").alias("state")).distinct()
    inputs = staged(outcomes(listing, members, excluded, "historical"), "inputs")
    return Panel(facts, filers, kept, status, inputs, values, expand)

"""Writing panels, dictionaries and summaries."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingpanel.operators.coverage import with_quarter_parts
from filingpanel.plans.panel import PANEL_KEYS, Panel
from filingpanel.session import remove
from filingpanel.sources.files import list_files

PANEL_TABLES = ("facts", "filers", "catalog")


def write_partitioned(
    df: DataFrame, folder: str, keys: Sequence[str] = PANEL_KEYS, replace: str = "partitions"
) -> None:
    """Snappy Parquet, one folder per key combination.

    Rows are rebalanced by key: small combinations become one file each, and one that holds much
    of the data is split over several tasks and files. ``replace="partitions"`` overwrites the
    combinations that occur in ``df`` and leaves the others; ``"all"`` overwrites everything;
    ``"nothing"`` appends.
    """
    _write_keyed(df.hint("rebalance", *keys), folder, keys, replace)


def _write_keyed(df: DataFrame, folder: str, keys: Sequence[str], replace: str) -> None:
    writer = df.write.partitionBy(*keys).option("compression", "snappy")
    if replace == "partitions":
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(folder)
    elif replace == "all":
        writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)
    elif replace == "nothing":
        writer.mode("append").parquet(folder)
    else:
        raise ValueError(f"unknown replace rule {replace!r}")


def write_panel(panel: Panel, folder: str, replace: str = "partitions") -> None:
    """All tables of a panel; status and inputs are written last, so they never claim unwritten quarters.

    A quarter of an entity type that the panel reports as processed is replaced in every table, also
    in one that has no row of it any more. Facts are spread as filer rows and exploded afterwards, so
    their keys cross the network once a row and not once a value.
    """
    spark = panel.status.sparkSession
    quarters = panel.status.where(F.col("state") == "processed").select(*PANEL_KEYS).distinct()
    before = {} if replace != "partitions" else {t: _partitions_of(spark, os.path.join(folder, t), quarters) for t in PANEL_TABLES}
    for table in PANEL_TABLES:
        target = os.path.join(folder, table)
        if table == "facts" and panel.values is not None:
            _write_keyed(panel.expand(panel.values.hint("rebalance", *PANEL_KEYS)), target, PANEL_KEYS, replace)
        else:
            write_partitioned(getattr(panel, table), target, replace=replace)
        # A partition that still has its file was not overwritten: it belongs to a quarter without rows now.
        if before.get(table):
            after = _partitions_of(spark, target, quarters)
            remove(spark, [p for p, file in before[table].items() if after.get(p) == file])
    mode = "overwrite" if replace == "all" else "append"
    panel.status.hint("rebalance").write.mode(mode).parquet(os.path.join(folder, "status"))
    if panel.inputs is not None:
        panel.inputs.hint("rebalance").write.mode(mode).parquet(os.path.join(folder, "inputs"))


def _partitions_of(spark: SparkSession, folder: str, quarters: DataFrame) -> dict[str, str]:
    """The partition folders of some quarters in a table, with their first file each; none if there is no table yet.

    Files are reduced to one for each partition before the driver sees them; every write gives its files new names.
    """
    try:
        files = list_files(spark, folder, "*.parquet", recursive=True)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    inside = F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("inside")
    keyed = files.select("path", inside, *[F.url_decode(F.regexp_extract("path", rf"{k}=([^/]+)/", 1)).alias(k) for k in PANEL_KEYS])
    firsts = keyed.join(quarters, list(PANEL_KEYS), "left_semi").groupBy("inside").agg(F.min("path").alias("file"))
    return {r["inside"]: r["file"] for r in firsts.collect()}


def write_wide(wide: DataFrame, folder: str) -> None:
    """One wide dataset (an entity type's quarter, say); column descriptions stay in its schema."""
    wide.hint("rebalance").write.mode("overwrite").option("compression", "snappy").parquet(folder)


def write_dictionary(dictionary: DataFrame, folder: str) -> tuple[str, str]:
    """The dictionary sorted by variable, as CSV with header and as Parquet."""
    csv, parquet = os.path.join(folder, "data_dictionary.csv"), os.path.join(folder, "data_dictionary.parquet")
    dictionary.orderBy("Variable").write.mode("overwrite").parquet(parquet)
    # From the stored table, so that the dictionary is built once, and in its order.
    stored = dictionary.sparkSession.read.parquet(parquet).orderBy("Variable")
    stored.write.mode("overwrite").option("header", True).option("escape", '"').csv(csv)
    return csv, parquet


def write_summary(summary: DataFrame, folder: str) -> None:
    """The coverage summary as CSV with header, sorted, with year and quarter number."""
    ordered = with_quarter_parts(summary).orderBy("entity_type", "date")
    ordered.write.mode("overwrite").option("header", True).csv(folder)

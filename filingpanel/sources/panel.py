"""Reading panels, own and foreign."""

from __future__ import annotations

import os
import re
from collections import defaultdict
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from filingpanel.constants import ENTITY_CODES, ID_COLUMN, LEAD_COLUMNS, PERIOD_COLUMN
from filingpanel.functions.names import base_name, megabytes
from filingpanel.operators.coverage import filer_counts
from filingpanel.operators.merge import union_sources
from filingpanel.operators.prune import profile_columns
from filingpanel.plans.panel import Panel, latest_inputs
from filingpanel.sources.files import list_files

FLAT = "All"


def read_panel(spark: SparkSession, folder: str) -> Panel:
    """A panel written by ``sinks.panel.write_panel``; partition columns prune the files read."""
    return Panel(*[spark.read.parquet(os.path.join(folder, t)) for t in ("facts", "filers", "catalog", "status")])


def read_inputs(spark: SparkSession, folder: str) -> DataFrame | None:
    """The present state of every input file of a panel, or None where there is no panel yet."""
    inputs = os.path.join(folder, "inputs")
    if list_or_none(spark, inputs) is None:
        return None
    return latest_inputs(spark.read.parquet(inputs))


def processed_quarters(spark: SparkSession, folder: str, source: str) -> list[str]:
    """Quarters of which a file of this source (``historical`` or ``bulk``) was processed.

    The driver sees at most one label per calendar quarter.
    """
    inputs = read_inputs(spark, folder)
    if inputs is None:
        return []
    done = inputs.where((F.col("state") == "processed") & (F.col("source") == source))
    return sorted(r["quarter"] for r in done.select("quarter").distinct().collect())


def list_or_none(spark: SparkSession, folder: str) -> DataFrame | None:
    """The Parquet files below a folder, or None if there is no such folder yet."""
    try:
        return list_files(spark, folder, "*.parquet", recursive=True)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def list_wide_files(spark: SparkSession, folder: str, entities: Sequence[str] = tuple(ENTITY_CODES)) -> DataFrame:
    """``(entity_type, quarter, path, length)`` of wide quarterly datasets, files or folders.

    Datasets below entity folders are tagged with the folder; if there are none, those directly
    in the folder are tagged ``All``. The quarter is the dataset's name without suffix.
    """
    files = list_files(spark, folder, "*.parquet", recursive=True)
    parts = {"_parent": 2, "quarter": 3, "path": 1}
    dataset = r"^(.*?([^/]+)/([^/]+)\.parquet)(?:/[^/]*)?$"
    named = files.select("length", *[F.regexp_extract("path", dataset, i).alias(c) for c, i in parts.items()])
    tagged = named.groupBy("_parent", "quarter", "path").agg(F.sum("length").alias("length"))
    below = tagged.where(F.col("_parent").isin(*entities)).withColumnRenamed("_parent", "entity_type")
    if not below.isEmpty():
        return below
    own = os.path.basename(folder.rstrip("/"))
    return tagged.where(F.col("_parent") == own).select(F.lit(FLAT).alias("entity_type"), "quarter", "path", "length")


def summarize_wide_files(
    spark: SparkSession, folder: str, check_null_columns: bool = False, entities: Sequence[str] = tuple(ENTITY_CODES)
) -> DataFrame:
    """The coverage summary of wide quarterly datasets that have a schema each.

    Types of a column may differ between quarters, so files of one schema are read together, and
    those of another apart. Only the two lead columns are read, whose schemas are few, unless null
    columns are asked for. The driver sees the schemas.
    """
    listed = list_wide_files(spark, folder, entities).collect()
    if not listed:
        raise ValueError(f"no panel files in {folder}")
    with ThreadPool(_FOOTERS_AT_ONCE) as pool:
        schemas = pool.map(lambda file: spark.read.parquet(file["path"]).schema, listed)
    by_lead, by_schema = defaultdict(list), defaultdict(list)
    known = []
    for file, schema in zip(listed, schemas):
        lead = StructType([f for f in schema.fields if f.name in LEAD_COLUMNS])
        by_lead[lead.simpleString()].append((file["path"], lead))
        by_schema[schema.simpleString()].append((file["path"], schema))
        variables = len(schema) - len(lead)
        known.append((_same_path(file["path"]), file["entity_type"], file["quarter"], variables, file["length"]))

    def scans(groups):
        for files in groups.values():
            rows = spark.read.schema(files[0][1]).parquet(*[path for path, _ in files])
            yield files[0][1], rows.withColumn(_DATASET, _dataset_of_row())

    plain = _plain(F.col(_DATASET))
    counted = [
        filer_counts(rows, (_DATASET,), ID_COLUMN, PERIOD_COLUMN).withColumns({_DATASET: plain, "date": F.col("date").cast("timestamp")})
        for _, rows in scans(by_lead)
    ]
    info = spark.createDataFrame(
        known, f"{_DATASET} string, entity_type string, quarter string, num_variables bigint, length bigint"
    )
    summary = info.join(union_sources(counted), _DATASET, "left")
    if check_null_columns:
        empty = []
        for schema, rows in scans(by_schema):
            variables = [n for n in schema.names if n not in LEAD_COLUMNS]
            if variables:
                profile = profile_columns(rows, variables, (_DATASET,))
                empty.append(profile.groupBy(plain.alias(_DATASET)).agg(F.count_if("all_null").alias("num_null_columns")))
        if empty:
            summary = summary.join(union_sources(empty), _DATASET, "left")
    nulls = F.col("num_null_columns") if "num_null_columns" in summary.columns else F.lit(None)
    return summary.select(
        "entity_type",
        "quarter",
        "date",
        F.coalesce("num_banks", F.lit(0)).alias("num_banks"),
        "num_variables",
        (F.col("num_variables") - F.coalesce(nulls, F.lit(0))).alias("num_non_null_vars"),
        F.coalesce(nulls, F.lit(0)).cast("bigint").alias("num_null_columns"),
        megabytes(F.col("length")).alias("file_size_mb"),
        base_name(F.col(_DATASET)).alias("file_path"),
    )


_DATASET = "_dataset"
_FOOTERS_AT_ONCE = 16


def _same_path(path: str) -> str:
    """A path in the one spelling used to compare paths from listings and from rows."""
    return re.sub(r"^(\w+):/+", r"\1:/", path)


def _dataset_of_row() -> Column:
    """The dataset (file, or folder with the suffix) that a row comes from, spelled as in the row's metadata.

    For every row, so it takes no pattern search; ``_plain`` brings it to the listing's spelling after counting.
    """
    file = F.col("_metadata.file_path")
    name = F.substring_index(file, "/", -1)
    inside = file.endswith(F.concat(F.lit(".parquet/"), name)) & ~file.endswith(F.concat(F.lit("/.parquet/"), name))
    folder = F.substr(file, F.lit(1), F.length(file) - F.length(name) - 1)
    return F.when(inside, folder).when(file.endswith(".parquet") & ~file.endswith("/.parquet"), file).otherwise("")


def _plain(dataset: Column) -> Column:
    """A dataset of ``_dataset_of_row`` as ``_same_path`` spells it."""
    path = F.url_decode(F.regexp_replace(dataset, r"\+", "%2B"))
    return F.regexp_replace(path, r"^(\w+):/+", "$1:/")

"""Panels kept up to date as archives arrive.

A file stream with a checkpoint processes every archive once, also across restarts. Each batch
is an ordinary panel job over the new files. There is no watermark: a quarter's archive is complete in
itself. Of several files of a quarter the first by path stands for it, whichever batch brings it: a
batch compares its files with those recorded for earlier ones, so batch sizes decide nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from filingpanel.functions.names import base_name
from filingpanel.functions.periods import period_from_bulk_name, period_from_call_name, quarter_label
from filingpanel.plans.bulk import assemble_bulk
from filingpanel.plans.historical import assemble_historical
from filingpanel.plans.panel import Panel, staged_rows
from filingpanel.session import recorded, remove, staged
from filingpanel.sinks.panel import write_panel
from filingpanel.sources import cells, delimited, xport
from filingpanel.sources.files import read_listed
from filingpanel.sources.panel import read_inputs

_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def _file_stream(spark: SparkSession, folder: str, pattern: str, files_per_batch: int) -> DataFrame:
    """The listing of files that arrive, without their content: every use of a batch reads all that the stream selects."""
    reader = spark.readStream.format("binaryFile").schema(_FILE_SCHEMA)
    reader = reader.option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder).select("path", base_name(F.col("path")).alias("file_name"))


def _start(files: DataFrame, source: str, build, out: str, checkpoint: str) -> StreamingQuery:
    def write_batch(batch: DataFrame, _: int) -> None:
        # Overwriting whole quarters makes a repeated batch harmless.
        spark = batch.sparkSession
        inputs = read_inputs(spark, out)
        done = None if inputs is None else inputs.where((F.col("state") == "processed") & (F.col("source") == source))
        with recorded() as folders:
            earlier = None if done is None else staged(done.groupBy("quarter").agg(F.min("path").alias("path")), "earlier")
            # Names with pattern characters make the source list files of their folder twice.
            write_panel(build(batch.distinct(), earlier), out, replace="partitions")
        remove(spark, folders)

    writer = files.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def ingest_new_bulk(
    spark: SparkSession,
    folder: str,
    out: str,
    checkpoint: str,
    dictionary: DataFrame | None = None,
    files_per_batch: int = 1_000,
) -> StreamingQuery:
    """Add the bulk archives that arrived since the last run to the panel in ``out``."""

    def build(batch: DataFrame, earlier: DataFrame | None) -> Panel:
        period = period_from_bulk_name("file_name")
        state = F.when(period.isNull(), cells.UNDATED)
        listing = staged(batch.select("path", quarter_label(period).alias("quarter"), state.alias("state")), "listing")
        files = read_listed(listing.where("state IS NULL"), delimited.INLINE_BYTES, delimited.LOOSE_BYTES)
        decoded = staged_rows(delimited.decode_delimited(files), "bulk")
        return assemble_bulk(decoded, dictionary, listing=listing, earlier=earlier)

    return _start(_file_stream(spark, folder, delimited.PATTERN, files_per_batch), "bulk", build, out, checkpoint)


def ingest_new_historical(
    spark: SparkSession,
    folder: str,
    out: str,
    checkpoint: str,
    dictionary: DataFrame | None = None,
    files_per_batch: int = 1_000,
) -> StreamingQuery:
    """Add the transport files that arrived since the last run to the panel in ``out``."""

    def build(batch: DataFrame, earlier: DataFrame | None) -> Panel:
        state = xport.name_state(F.col("file_name"), None, None, ())
        quarter = quarter_label(period_from_call_name("file_name"))
        listing = staged(batch.select("path", quarter.alias("quarter"), state.alias("state")), "listing")
        decoded = staged_rows(xport.decode_xport(read_listed(listing.where("state IS NULL"))), "historical")
        return assemble_historical(decoded, dictionary, listing=listing, earlier=earlier)

    return _start(_file_stream(spark, folder, xport.PATTERN, files_per_batch), "historical", build, out, checkpoint)


def append_new_rows(
    spark: SparkSession,
    source: str,
    schema,
    transform: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    partition_by: tuple[str, ...] = (),
    pattern: str = "*.parquet",
) -> StreamingQuery:
    """Append the transformed rows of Parquet files that arrived since the last run."""
    rows = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(source)
    writer = transform(rows).writeStream.format("parquet").partitionBy(*partition_by)
    return writer.option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

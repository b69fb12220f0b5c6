"""Dictionary exports (CSV) and the stored dictionary (Parquet)."""

from __future__ import annotations

import csv
import io
import itertools
import zipfile
from collections.abc import Iterator
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from filingpanel.functions.text import na_to_null
from filingpanel.sources.delimited import encoding_of
from filingpanel.sources.headers import unique_names


def read_dictionary_csv(
    spark: SparkSession, path: str, preamble: int = 1, quoted_newlines: bool = True
) -> DataFrame:
    """A dictionary export: ``preamble`` lines, then a header, then rows; everything as text.

    UTF-8 is tried first and Latin-1 taken if the file is not valid UTF-8. Only the first lines
    come to the driver, for the column names. All values stay text, so item codes keep leading
    zeros, and the usual missing-value texts become null.
    """
    if path.lower().endswith(".zip"):
        return _from_fields(_zipped_fields(spark, path), preamble)
    encoding = "UTF-8" if _is_utf8(spark, path) else "ISO-8859-1"
    lines = spark.read.option("encoding", encoding).text(path).limit(preamble + 1).collect()
    if len(lines) <= preamble:
        raise ValueError(f"{path} has no header line")
    names = next(csv.reader([lines[preamble]["value"].removeprefix("\ufeff")]))
    # Numbered columns at first: the export's own names may repeat or differ in case only.
    schema = StructType([StructField(f"c{i}", StringType()) for i in range(len(names))])
    reader = spark.read.schema(schema).option("encoding", encoding).option("multiLine", quoted_newlines)
    rows = reader.option("quote", '"').option("escape", '"').csv(path)
    fields = [F.col(c) for c in rows.columns]
    first_lines = [next(csv.reader([r["value"].removeprefix("\ufeff")]), []) for r in lines]
    for line in first_lines:
        expected = [v or None for v in line[: len(names)]] + [None] * (len(names) - len(line))
        matches = [c.eqNullSafe(F.lit(v)) for c, v in zip(fields, expected)]
        rows = rows.where(~reduce(and_, matches))
    return rows.select(*[na_to_null(c).alias(n) for c, n in zip(fields, unique_names(names))])


def _zipped_fields(spark: SparkSession, path: str) -> DataFrame:
    """``(row_no, fields)`` of the first CSV member, at any depth, of a dictionary archive."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("row_no", pa.int64()), ("fields", pa.list_(pa.string()))])
        for batch in batches:
            for content in batch.column(0):
                with zipfile.ZipFile(io.BytesIO(content.as_py())) as archive:
                    member = next((m for m in archive.namelist() if m.lower().endswith(".csv")), None)
                    if member is None:
                        raise ValueError("no CSV member in the dictionary archive")
                    with archive.open(member) as probe:
                        encoding = encoding_of(probe)
                    with archive.open(member) as data:
                        lines = csv.reader(io.TextIOWrapper(data, encoding=encoding, newline=""))
                        numbered = enumerate(fields for fields in lines if fields)
                        while some := list(itertools.islice(numbered, 5_000)):
                            numbers, fields = zip(*some)
                            yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(fields, schema.types[1])], schema=schema)

    content = spark.read.format("binaryFile").load(path).select("content")
    return content.mapInArrow(parse, "row_no bigint, fields array<string>")


def _from_fields(rows: DataFrame, preamble: int) -> DataFrame:
    header = rows.where(F.col("row_no") == preamble).head()
    if header is None:
        raise ValueError("the dictionary has no header line")
    names = unique_names([n.removeprefix("\ufeff") for n in header["fields"]])
    body = rows.where(F.col("row_no") > preamble)
    return body.select(*[na_to_null(F.get("fields", F.lit(i))).alias(n) for i, n in enumerate(names)])


def _is_utf8(spark: SparkSession, path: str) -> bool:
    """Whether the file is valid UTF-8, checked line by line on the executors."""
    lines = spark.read.option("encoding", "UTF-8").text(path)
    broken = lines.where(~F.is_valid_utf8("value"))
    return broken.isEmpty()


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """The stored dictionary ``(Variable, Description, ReportingForms)``; forms may be missing."""
    stored = spark.read.parquet(path)
    forms = F.col("ReportingForms") if "ReportingForms" in stored.columns else F.lit("")
    return stored.select("Variable", "Description", F.coalesce(forms, F.lit("")).alias("ReportingForms"))

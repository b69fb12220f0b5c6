"""Whole pipelines on files written from the test tables, each with equivalent SQL.

A year's orders are a filing archive of that year's last quarter: a tab-delimited file whose name holds the
date, one row for each order. Values are null where an order's status is P.
"""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingpanel.functions.names import base_name
from filingpanel.plans.bulk import LISTED
from filingpanel.plans.panel import wide_panel
from filingpanel.plans.report import coverage_report, report_on
from filingpanel.plans.update import export_wide, update_bulk
from filingpanel.session import shared_folder
from filingpanel.sources.blocks import run_ends
from filingpanel.sources.dictionary import read_dictionary
from filingpanel.sources.files import list_files, read_files
from filingpanel.sources.panel import read_inputs, read_panel, summarize_wide_files
from filingpanel.streaming.incremental import ingest_new_bulk
from filingpanel.table_queries import registered, table

ENTITY = "FFIEC_031_041"
YEAR_SQL = "year(o_orderdate)"
VALUES_SQL = f"""SELECT {YEAR_SQL}::VARCHAR || 'Q4' AS quarter, o_orderkey AS filer_id,
    CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price, o_custkey AS customer FROM orders"""


def write_named(lines: DataFrame, folder: str) -> None:
    """Text files named by the column ``name``, with their ``line`` in the order of ``place``."""
    spark = lines.sparkSession
    parts = shared_folder(spark, "parts")
    ordered = _one_task_a_name(_chunks(lines, "name"), "name")
    ordered.select("name", F.col("data").cast("string").alias("line")).write.partitionBy("name").text(parts)
    _move(spark, parts, folder)


_CHUNK = "name string, number int, member string, part int, turn int, data binary"


def _chunks(lines: DataFrame, *keys: str) -> DataFrame:
    """Lines in the order of ``keys`` and ``place``, sorted by many tasks and joined to chunks of whole lines.

    A file's single writer then sorts a row for thousands of lines. The last line's end is left to that writer;
    null lines are empty. Chunks of one file are in order by ``part`` and ``turn``.
    """
    order = [*keys, "place"]
    if "member" not in lines.columns:
        lines = lines.withColumns({"number": F.lit(0), "member": F.lit("")})
    ordered = lines.repartitionByRange(*order).sortWithinPartitions(*order)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, turn = TaskContext.get().partitionId(), 0
        for batch in batches:
            names, numbers, members, lines = (batch.column(c) for c in ("name", "number", "member", "line"))
            lines = pc.binary_join_element_wise(pc.fill_null(lines.cast(pa.binary()), b""), b"", b"\n")
            at = 0
            for end in run_ends(names, numbers, members):
                offsets = np.frombuffer(lines.buffers()[1], "int32")[lines.offset + at : lines.offset + end + 1]
                data = lines.buffers()[2][int(offsets[0]) : int(offsets[-1]) - 1].to_pybytes()
                own = {"name": names[at].as_py(), "number": numbers[at].as_py(), "member": members[at].as_py()}
                yield pa.RecordBatch.from_pylist([own | {"part": part, "turn": turn, "data": data}], _CHUNK_ARROW)
                at, turn = end, turn + 1

    return ordered.mapInArrow(joined, _CHUNK)


_CHUNK_ARROW = pa.schema([("name", pa.string()), ("number", pa.int32()), ("member", pa.string()), ("part", pa.int32()), ("turn", pa.int32()), ("data", pa.binary())])


def _one_task_a_name(chunks: DataFrame, *keys: str) -> DataFrame:
    return chunks.repartition("name").sortWithinPartitions(*keys, "part", "turn")


def _move(spark: SparkSession, parts: str, folder: str) -> None:
    """Give the only file of each partition ``name`` that name."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(folder)
    files = target.getFileSystem(conf)
    files.mkdirs(target)
    listed = list_files(spark, parts, "*.txt", recursive=True)
    named = listed.select("path", F.url_decode(F.regexp_extract("path", "name=([^/]+)/", 1)).alias("name"))
    for row in named.collect():  # one for each year and schedule
        files.rename(jvm.org.apache.hadoop.fs.Path(row["path"]), jvm.org.apache.hadoop.fs.Path(os.path.join(folder, row["name"])))


def write_archives(lines: DataFrame, folder: str) -> None:
    """ZIP archives named by the column ``name``, with the members ``member`` in the order of ``number``.

    Each is packed by one task, as a stream: a row is a piece of an archive that ends at a line break, which the line
    writer adds. The last line break is the archive's comment. Members without lines are empty.
    """
    spark = lines.sparkSession
    parts = shared_folder(spark, "parts")
    keys = ("name", "number", "member")
    filled = _chunks(lines.where(F.col("line").isNotNull()), *keys)
    empty = lines.where(F.col("line").isNull()).select(*keys).distinct()
    none = {"part": F.lit(-1), "turn": F.lit(0), "data": F.lit(None).cast("binary")}
    chunks = filled.unionByName(empty.withColumns(none))
    archives = _one_task_a_name(chunks.where("number IS NOT NULL AND member IS NOT NULL"), *keys).mapInArrow(_archived, "name string, turn int, data binary")
    ordered = archives.sortWithinPartitions("name", "turn")
    ordered.select("name", F.col("data").cast("string").alias("line")).write.partitionBy("name").text(parts)
    _move(spark, parts, folder)


class _Pieces(io.RawIOBase):
    """What is written, to be taken in pieces that end at a line break."""

    def __init__(self):
        self.held, self.size = [], 0

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.held.append(bytes(data))
        self.size += len(data)
        return len(data)

    def taken(self, least: int) -> bytes | None:
        """The bytes before the last line break, if there are so many; that break is left out."""
        if self.size < least:
            return None
        data = b"".join(self.held)
        end = data.rfind(b"\n")
        self.held, self.size = [data[end + 1 :]], len(data) - end - 1
        return data[:end] if end >= 0 else None


def _archived(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (row for batch in batches for k in range(batch.num_rows) for row in batch.slice(k, 1).to_pylist())
    for name, own in groupby(rows, lambda r: r["name"]):
        sink, turn = _Pieces(), 0

        def pieces(least: int) -> Iterator[pa.RecordBatch]:
            nonlocal turn
            if (data := sink.taken(least)) is not None:
                yield pa.record_batch({"name": pa.array([name], pa.string()), "turn": pa.array([turn], pa.int32()), "data": pa.array([data], pa.binary())})
                turn += 1

        with zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.comment = b"\n"
            for (_, member), chunks in groupby(own, lambda r: (r["number"], r["member"])):
                with archive.open(member, "w", force_zip64=True) as target:
                    for chunk in chunks:
                        if chunk["data"] is not None:
                            target.write(chunk["data"] + b"\n")
                            yield from pieces(PIECE_BYTES)
        yield from pieces(1)


#: An archive is written in pieces of about this size.
PIECE_BYTES = 1 << 20


def filing_lines(spark: SparkSession, sf_dir: str, prefix: str = "Bulk ", price=None, columns=("RCON1", "RCON2"), rows=None) -> DataFrame:
    """The lines of the yearly files; ``rows`` limits the filers of a file to some of them."""
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    name = F.concat(F.lit(prefix), F.lit("1231"), F.col("year"), F.lit(".txt"))
    value = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast("string")).otherwise("") if price is None else price
    body = orders if rows is None else orders.where(rows)
    body = body.select(
        name.alias("name"),
        F.col("o_orderkey").alias("place"),
        F.concat_ws("\t", F.col("o_orderkey"), value, F.col("o_custkey")).alias("line"),
    )
    header = F.lit("\t".join(("IDRSSD", *columns)))
    return body.union(orders.select(name, F.lit(-1).cast("bigint"), header).distinct())


def schedule_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of yearly archives with four members: all orders, those with returned items, a header alone, nothing.

    The first two share the column RCON2, which has other values in the second one.
    """
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    returned = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("items"))
    price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast("string")).otherwise("")
    name = F.concat(F.lit("FFIEC CDR Call Bulk All Schedules 1231"), F.col("year"), F.lit(".zip")).alias("name")
    years = orders.select("year").distinct()

    def member(number: int, title: str, rows: DataFrame, *values) -> DataFrame:
        line = F.concat_ws("\t", "o_orderkey", *values)
        return rows.select(name, F.lit(title).alias("member"), F.lit(number).alias("number"), F.col("o_orderkey").alias("place"), line.alias("line"))

    def head(number: int, title: str, *columns: str) -> DataFrame:
        line = F.lit("\t".join(columns)) if columns else F.lit(None).cast("string")
        return years.select(name, F.lit(title).alias("member"), F.lit(number).alias("number"), F.lit(-1).cast("bigint").alias("place"), line.alias("line"))

    parts = [
        head(0, "Schedule RC.txt", "IDRSSD", "RCON1", "RCON2", "RCON3"),
        member(0, "Schedule RC.txt", orders, price, "o_custkey", "o_orderpriority"),
        head(1, "Schedule RI.txt", "IDRSSD", "RCON2", "RIAD1"),
        member(1, "Schedule RI.txt", orders.join(returned, "o_orderkey"), F.lit("9"), "items"),
        head(2, "Schedule RX.txt", "IDRSSD", "RCONX"),
        head(3, "empty.txt"),
    ]
    return reduce(DataFrame.union, parts)


SCHEDULES_SQL = f"""v AS ({VALUES_SQL}), returned AS (SELECT l_orderkey AS filer_id, count(*) AS items FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
    f AS (SELECT quarter, filer_id, 0 AS member_ordinal, 'RCON1' AS variable, price AS num_value, NULL::VARCHAR AS str_value FROM v WHERE price IS NOT NULL
        UNION ALL SELECT quarter, filer_id, 0, 'RCON2', customer::DOUBLE, NULL FROM v
        UNION ALL SELECT {YEAR_SQL}::VARCHAR || 'Q4', o_orderkey, 0, 'RCON3', NULL, o_orderpriority FROM orders
        UNION ALL SELECT quarter, filer_id, 1, 'RIAD1', items::DOUBLE, NULL FROM v JOIN returned USING (filer_id))"""


def archived_panel(spark: SparkSession, sf_dir: str) -> str:
    source, folder = shared_folder(spark, "archives"), shared_folder(spark, "panel")
    write_archives(schedule_lines(spark, sf_dir), source)
    update_bulk(spark, source, folder)
    return folder


@registered(f"WITH {SCHEDULES_SQL} SELECT quarter, filer_id, variable, num_value, str_value FROM f")
def zip_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of archives with several schedules; the first one's column counts where two have the same."""
    return read_panel(spark, archived_panel(spark, sf_dir)).facts.select("quarter", "filer_id", "variable", "num_value", "str_value")


@registered(f"""WITH {SCHEDULES_SQL} SELECT quarter, member_ordinal, variable, CASE WHEN variable = 'RCON3' THEN 'string' ELSE 'double' END AS dtype, count(*) AS n_values
    FROM f GROUP BY quarter, member_ordinal, variable""")
def zip_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of archives with several schedules, and which schedule each is taken from."""
    return read_panel(spark, archived_panel(spark, sf_dir)).catalog.select("quarter", "member_ordinal", "variable", "dtype", "n_values")


def written_panel(spark: SparkSession, sf_dir: str) -> str:
    source, folder = shared_folder(spark, "filings"), shared_folder(spark, "panel")
    write_named(filing_lines(spark, sf_dir), source)
    update_bulk(spark, source, folder)
    return folder


@registered(f"""SELECT quarter, filer_id, 'RCON1' AS variable, price AS num_value FROM ({VALUES_SQL}) WHERE price IS NOT NULL
    UNION ALL SELECT quarter, filer_id, 'RCON2', customer::DOUBLE FROM ({VALUES_SQL})""")
def bulk_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_panel(spark, written_panel(spark, sf_dir)).facts.select("quarter", "filer_id", "variable", "num_value")


@registered(f"""SELECT {YEAR_SQL}::VARCHAR || 'Q4' AS quarter, count(DISTINCT o_orderkey) AS num_banks, 2::BIGINT AS num_variables FROM orders GROUP BY 1""")
def panel_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = coverage_report(spark, written_panel(spark, sf_dir))
    return report.summary.select("quarter", "num_banks", "num_variables")


@registered(f"""SELECT 'FFIEC_031_041' AS entity_type, {YEAR_SQL}::VARCHAR || 'Q4' AS quarter, count(DISTINCT o_orderkey) AS num_banks,
    2::BIGINT AS num_variables, 0::BIGINT AS num_null_columns FROM orders GROUP BY 2""")
def wide_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = shared_folder(spark, "wide")
    export_wide(spark, written_panel(spark, sf_dir), wide)
    found = summarize_wide_files(spark, wide, check_null_columns=True)
    return found.select("entity_type", "quarter", "num_banks", "num_variables", "num_null_columns")


@registered(f"""SELECT {YEAR_SQL}::VARCHAR || 'Q4' AS quarter, count(DISTINCT o_orderkey) AS "All_num_banks", 2::BIGINT AS "All_num_variables"
    FROM orders GROUP BY 1""")
def wide_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report on wide files without entity folders."""
    wide = shared_folder(spark, "wide")
    export_wide(spark, written_panel(spark, sf_dir), wide)
    report = report_on(summarize_wide_files(spark, os.path.join(wide, ENTITY), entities=()))
    return report.quarters.select("quarter", "All_num_banks", "All_num_variables")


@registered(f"""SELECT f.quarter, v.variable, v.description, f.n AS records FROM
    (SELECT {YEAR_SQL}::VARCHAR || 'Q4' AS quarter, count(*) AS n FROM orders GROUP BY 1) f,
    (SELECT 'RCON' || r_regionkey::VARCHAR AS variable, r_name AS description FROM region WHERE r_regionkey IN (1, 2)
        UNION ALL SELECT c, '' FROM (VALUES ('RSSD_ID'), ('REPORTING_PERIOD')) t(c)) v""")
def published_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What another Parquet reader finds in the published files: fields, their own descriptions, and rows."""
    wide = shared_folder(spark, "published")
    words = table(spark, sf_dir, "region").select(F.concat(F.lit("RCON"), "r_regionkey").alias("Variable"), F.col("r_name").alias("Description"))
    export_wide(spark, written_panel(spark, sf_dir), wide, words.withColumn("ReportingForms", F.lit("")), published=True)

    def fields(batches):
        for files in batches:
            for name, content in zip(files["file_name"], files["content"]):
                file = pq.ParquetFile(io.BytesIO(content))
                for field in file.schema_arrow:
                    text = (field.metadata or {}).get(b"description", b"").decode()
                    yield pd.DataFrame([(name.removesuffix(".parquet"), field.name, text, file.metadata.num_rows)])

    files = read_files(spark, wide, "*.parquet", recursive=True).select("file_name", "content")
    return files.mapInPandas(fields, "quarter string, variable string, description string, records long")


@registered(f"""WITH y AS (SELECT DISTINCT {YEAR_SQL} AS y FROM orders), last AS (SELECT max(y) AS l FROM y),
    given AS (SELECT y, 'Bulk 1231' || y::VARCHAR || '.txt' AS file, y::VARCHAR || 'Q4' AS quarter,
        CASE WHEN y = l THEN 'out_of_range' WHEN y % 2 = 1 THEN 'empty' ELSE 'processed' END AS s1,
        CASE WHEN y < l AND y % 2 = 0 THEN 'skipped' WHEN y % 2 = 1 THEN 'empty' ELSE 'processed' END AS s2 FROM y, last),
    sizes AS (SELECT {YEAR_SQL} AS y, count(*) AS n FROM orders GROUP BY 1)
    SELECT 1 AS run, file, quarter, s1 AS state, CASE WHEN s1 = 'processed' THEN n ELSE 0 END AS records FROM given JOIN sizes USING (y)
    UNION ALL SELECT 2, file, quarter, s2, CASE WHEN s2 = 'processed' THEN n ELSE 0 END FROM given JOIN sizes USING (y)
    UNION ALL SELECT r.run, 'notes.txt', NULL, 'undated', 0 FROM (VALUES (1), (2)) r(run)""")
def update_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of two runs over full, header-only and undated files; the first run ends a year before the last."""
    source, folder = shared_folder(spark, "filings"), shared_folder(spark, "panel")
    lines = filing_lines(spark, sf_dir, rows=F.col("year") % 2 == 0)
    notes = spark.range(1).select(F.lit("notes.txt").alias("name"), F.lit(0).cast("bigint").alias("place"), F.lit("IDRSSD").alias("line"))
    write_named(lines.union(notes), source)
    last = table(spark, sf_dir, "orders").agg(F.make_date(F.max(F.year("o_orderdate")) - 1, F.lit(12), F.lit(31))).first()[0]
    update_bulk(spark, source, folder, end=last)
    first = spark.read.parquet(os.path.join(folder, "inputs"))
    seen = first.select(F.lit(1).alias("run"), "*").collect()
    update_bulk(spark, source, folder)
    log = spark.read.parquet(os.path.join(folder, "inputs"))
    started = max(r["recorded"] for r in seen)
    runs = log.withColumn("run", F.when(F.col("recorded") > F.lit(started), 2).otherwise(1))
    return runs.select("run", base_name(F.col("path")).alias("file"), "quarter", "state", "records")


@registered(f"""WITH v AS ({VALUES_SQL}), first AS (SELECT min(quarter) AS f FROM v)
    SELECT quarter, count(*) FILTER (quarter <> f OR customer % 2 = 0) AS filers, count(price) FILTER (quarter <> f) AS prices,
        count(*) FILTER (quarter <> f OR customer % 2 = 0) AS customers, CASE WHEN quarter = f THEN 'RCON2' ELSE 'RCON1,RCON2' END AS variables
    FROM v, first GROUP BY quarter, f""")
def forced_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forced run in which the first year keeps half of its filers, and loses all values of one column."""
    folder = written_panel(spark, sf_dir)
    source = shared_folder(spark, "corrected")
    year = table(spark, sf_dir, "orders").agg(F.min(F.year("o_orderdate"))).first()[0]
    corrected = filing_lines(spark, sf_dir, price=F.lit(""), rows=(F.col("year") == year) & (F.col("o_custkey") % 2 == 0))
    write_named(corrected.where(F.col("name").contains(str(year))), source)
    update_bulk(spark, source, folder, force=True)
    panel = read_panel(spark, folder)
    counts = panel.facts.groupBy("quarter").agg(
        F.count_if(F.col("variable") == "RCON1").alias("prices"), F.count_if(F.col("variable") == "RCON2").alias("customers")
    )
    columns = panel.catalog.groupBy("quarter").agg(F.array_join(F.array_sort(F.collect_set("variable")), ",").alias("variables"))
    filers = panel.filers.groupBy("quarter").agg(F.count("*").alias("filers"))
    return filers.join(counts, "quarter", "left").join(columns, "quarter", "left")


@registered(f"""SELECT b.files_per_batch, quarter, count(price) AS prices, round(sum(price), 2) AS total, 'a 1231' || substr(quarter, 1, 4) || '.txt' AS file
    FROM ({VALUES_SQL}) v, (VALUES (5), (1000)) b(files_per_batch) GROUP BY 1, 2""")
def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files for each quarter, in small batches and in one: the first by path stands for the quarter."""
    source = shared_folder(spark, "arriving")
    write_named(filing_lines(spark, sf_dir, prefix="a ").union(filing_lines(spark, sf_dir, prefix="b ", price=F.lit("1"))), source)
    found = []
    for size in (5, 1000):
        out = shared_folder(spark, "streamed")
        ingest_new_bulk(spark, source, out, shared_folder(spark, "checkpoint"), files_per_batch=size).awaitTermination()
        prices = read_panel(spark, out).facts.where("variable = 'RCON1'").groupBy("quarter")
        totals = prices.agg(F.count("*").alias("prices"), F.round(F.sum("num_value"), 2).alias("total"))
        used = read_inputs(spark, out).where("state = 'processed'").select("quarter", base_name(F.col("path")).alias("file"))
        found.append(totals.join(used, "quarter").withColumn("files_per_batch", F.lit(size)))
    return found[0].unionByName(found[1])


@registered(f"""SELECT filer_id AS RSSD_ID, last_day(make_date(substr(quarter, 1, 4)::INTEGER, 12, 1))::VARCHAR AS REPORTING_PERIOD,
    price AS "QUARTER", customer::DOUBLE AS "PERIOD" FROM ({VALUES_SQL})""")
def wide_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns called like the panel's own keys; one called like a lead column gives way to it."""
    source, folder = shared_folder(spark, "filings"), shared_folder(spark, "panel")
    lines = filing_lines(spark, sf_dir, columns=("Quarter", "Period", "REPORTING_PERIOD"))
    body = F.when(F.col("place") >= 0, F.concat("line", F.lit("\t7"))).otherwise(F.col("line"))
    write_named(lines.withColumn("line", body), source)
    update_bulk(spark, source, folder)
    wide = wide_panel(read_panel(spark, folder), ENTITY)
    return wide.withColumn("REPORTING_PERIOD", F.col("REPORTING_PERIOD").cast("string"))


@registered("SELECT p_brand AS Variable, min(p_type) AS Description, '' AS ReportingForms FROM part GROUP BY 1")
def stored_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "dictionary")
    words = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("Variable")).agg(F.min("p_type").alias("Description"))
    words.write.parquet(folder)  # without forms, as older dictionaries are
    return read_dictionary(spark, folder)

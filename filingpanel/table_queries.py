"""The operators applied to the star-schema test tables, each with equivalent SQL.

Analogues: a filer is a customer, its entity type follows from the nation's region (0 -> A,
1 and 2 -> B, 3 -> C, 4 -> none), a filing is an order, and its period is the order date's
quarter. Dates are returned as text, counts as BIGINT, sums and means rounded.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingpanel.constants import ARCHIVE_FIRST, ARCHIVE_LAST
from filingpanel.functions import periods, text
from filingpanel.operators import (
    columns,
    coverage,
    describe,
    dictionary,
    entities,
    gaps,
    inference,
    inventory,
    merge,
    prune,
    quarters,
    reshape,
    status,
)
from filingpanel.session import shared_folder, ship_package, staged
from filingpanel.sinks.panel import write_dictionary, write_partitioned, write_summary
from filingpanel.sources.delimited import read_delimited
from filingpanel.sources.dictionary import read_dictionary_csv
from filingpanel.sources.files import list_files
from filingpanel.streaming.incremental import append_new_rows

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

CODES = {"A": (0,), "B": (1, 2), "C": (3,)}
ENTITIES = tuple(CODES)
MAP_SQL = "(VALUES (0, 'A'), (1, 'B'), (2, 'B'), (3, 'C')) m(code, entity_type)"
JOIN_SQL = f"""JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN {MAP_SQL} ON n_regionkey = m.code"""
QUARTER_SQL = "(year(o_orderdate)::VARCHAR || 'Q' || quarter(o_orderdate)::VARCHAR)"
PERIOD_SQL = "last_day((date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH)::DATE)"
INDEX_SQL = "(year(o_orderdate) * 4 + quarter(o_orderdate) - 1)"


def _label_sql(index: str) -> str:
    return f"((({index}) // 4)::VARCHAR || 'Q' || (({index}) % 4 + 1)::VARCHAR)"


def registered(sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE_SQL[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)  # also for sessions that others have built
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def as_text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("date").cast("string")


def customer_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(c_custkey, c_nationkey, entity_type)``; customers of unmapped regions drop out."""
    regions = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    typed = entities.split_entities(regions, "n_regionkey", CODES).drop("n_regionkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return customers.join(typed, customers["c_nationkey"] == typed["n_nationkey"]).drop("n_nationkey")


def filer_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per filer and quarter. Orders are reduced to that before they meet the customers."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    filings = orders.groupBy(
        F.col("o_custkey").alias("filer_id"),
        periods.quarter_label("o_orderdate").alias("quarter"),
        periods.quarter_end("o_orderdate").alias("period"),
    ).agg(F.count("*").alias("n_orders"))
    typed = customer_entities(spark, sf_dir)
    return filings.join(typed, filings["filer_id"] == typed["c_custkey"]).drop("c_custkey", "c_nationkey")


def variable_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column catalog: a variable per priority and nation, filled by orders that are not pending."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    per_filer = orders.groupBy(
        "o_custkey", periods.quarter_label("o_orderdate").alias("quarter"), "o_orderpriority"
    ).agg(F.count_if(F.col("o_orderstatus") != "P").alias("n"))
    typed = customer_entities(spark, sf_dir)
    joined = per_filer.join(typed, per_filer["o_custkey"] == typed["c_custkey"])
    variable = F.concat_ws("_", "o_orderpriority", F.col("c_nationkey").cast("string"))
    return joined.groupBy("entity_type", "quarter", variable.alias("variable")).agg(F.sum("n").alias("n_values"))


ROSTER_SQL = f"""SELECT m.entity_type, {QUARTER_SQL} AS quarter, {PERIOD_SQL} AS period, o_custkey AS filer_id,
    count(*) AS n_orders FROM orders {JOIN_SQL} GROUP BY ALL"""
CATALOG_SQL = f"""SELECT m.entity_type, {QUARTER_SQL} AS quarter,
    o_orderpriority || '_' || c_nationkey::VARCHAR AS variable,
    count(*) FILTER (o_orderstatus <> 'P') AS n_values FROM orders {JOIN_SQL} GROUP BY ALL"""
SUMMARY_SQL = f"""SELECT f.entity_type, f.quarter, f.date, f.num_rows, f.num_banks,
    v.num_variables, v.num_non_null_vars, v.num_null_columns
    FROM (SELECT entity_type, quarter, min(period) AS date, count(*) AS num_rows,
            count(DISTINCT filer_id) AS num_banks FROM ({ROSTER_SQL}) GROUP BY ALL) f
    JOIN (SELECT entity_type, quarter, count(*) AS num_variables,
            count(*) FILTER (n_values > 0) AS num_non_null_vars,
            count(*) FILTER (n_values = 0) AS num_null_columns FROM ({CATALOG_SQL}) GROUP BY ALL) v
    USING (entity_type, quarter)"""


def summary_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.coverage_summary(filer_roster(spark, sf_dir), variable_catalog(spark, sf_dir))


# --- entity types and periods -------------------------------------------------------------


@registered(f"""SELECT c_custkey, m.entity_type FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN {MAP_SQL} ON n_regionkey = m.code""")
def entity_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_entities(spark, sf_dir).select("c_custkey", "entity_type")


@registered("""SELECT n_nationkey, n_name, r_name AS entity_type FROM nation JOIN region ON n_regionkey = r_regionkey
    WHERE r_name <> 'ASIA'""")
def entity_split_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = table(spark, sf_dir, "region").where(F.col("r_name") != "ASIA")
    mapping = regions.select(F.col("r_regionkey").alias("code"), F.col("r_name").alias("entity_type"))
    split = entities.split_by_table(table(spark, sf_dir, "nation"), "n_regionkey", mapping)
    return split.select("n_nationkey", "n_name", "entity_type")


@registered(f"""SELECT o_orderkey, m.entity_type FROM orders {JOIN_SQL}
    WHERE NOT (m.entity_type = 'A' AND o_orderdate > DATE '1998-12-31')""")
def entity_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("period")
    )
    typed = customer_entities(spark, sf_dir)
    joined = orders.join(typed, orders["o_custkey"] == typed["c_custkey"])
    kept = entities.apply_cutoff(joined, cutoff_entity="A", last=dt.date(1998, 12, 31))
    return kept.select("o_orderkey", "entity_type")


@registered("""SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS period FROM orders
    WHERE o_orderdate BETWEEN DATE '1996-03-31' AND DATE '1999-12-31'""")
def period_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    kept = entities.in_period_range(orders, "o_orderdate", dt.date(1996, 3, 31), dt.date(1999, 12, 31))
    return kept.select("o_orderkey", as_text("o_orderdate").alias("period"))


@registered("""SELECT o_orderkey, CAST(period AS VARCHAR) AS period FROM (SELECT o_orderkey,
        CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS period FROM orders)
    WHERE period IS NULL OR period BETWEEN DATE '1996-03-31' AND DATE '1999-12-31'""")
def period_range_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", dated.alias("period"))
    kept = entities.in_period_range(orders, "period", dt.date(1996, 3, 31), dt.date(1999, 12, 31), keep_undated=True)
    return kept.select("o_orderkey", as_text("period").alias("period"))


@registered(f"""SELECT o_orderkey, {QUARTER_SQL} AS quarter, {_label_sql(INDEX_SQL + ' + 1')} AS next_quarter,
    CAST({PERIOD_SQL} AS VARCHAR) AS period,
    CAST(CAST(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH AS DATE) AS VARCHAR) AS month_start,
    CAST(year(o_orderdate) AS BIGINT) AS year, CAST(quarter(o_orderdate) AS BIGINT) AS quarter_num FROM orders""")
def quarter_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    tagged = columns.attach_period(coverage.tag_quarter(orders, "o_orderdate"), "o_orderdate", name="period")
    tagged = columns.attach_period(tagged, "o_orderdate", periods.MONTH_START, "month_start")
    parts = coverage.with_quarter_parts(tagged, "o_orderdate")
    return parts.select(
        "o_orderkey",
        "quarter",
        periods.next_quarter_label("o_orderdate").alias("next_quarter"),
        as_text("period").alias("period"),
        as_text("month_start").alias("month_start"),
        F.col("year").cast("bigint").alias("year"),
        F.col("quarter_num").cast("bigint").alias("quarter_num"),
    )


@registered(f"""WITH span AS (SELECT min({INDEX_SQL}) - 4 AS a, max({INDEX_SQL}) + 4 AS b FROM orders),
    calendar AS (SELECT unnest(range(a, b + 1)) AS i FROM span),
    seen AS (SELECT {INDEX_SQL} AS i, count(*) AS n FROM orders GROUP BY 1)
    SELECT {_label_sql('calendar.i')} AS quarter,
        CAST(last_day(make_date((calendar.i // 4)::BIGINT, ((calendar.i % 4) * 3 + 3)::BIGINT, 1)) AS VARCHAR) AS period,
        coalesce(n, 0) AS orders FROM calendar LEFT JOIN seen ON calendar.i = seen.i""")
def quarter_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = table(spark, sf_dir, "orders").select("o_orderdate")
    span = dates.agg(
        F.add_months(periods.quarter_end(F.min("o_orderdate")), -12).alias("first"),
        F.last_day(F.add_months(periods.quarter_end(F.max("o_orderdate")), 12)).alias("last"),
    )
    calendar = quarters.explode_quarters(span, F.last_day("first"), F.col("last"))
    seen = coverage.tag_quarter(dates, "o_orderdate").groupBy("quarter").agg(F.count("*").alias("orders"))
    return calendar.join(seen, "quarter", "left").select(
        "quarter", as_text("period").alias("period"), F.coalesce("orders", F.lit(0)).alias("orders")
    )


@registered(f"""WITH calendar AS (SELECT d FROM (SELECT last_day(unnest(range(
            greatest(make_date(min(year(o_orderdate))::BIGINT - 25, 3, 1), DATE '1976-03-01'),
            least(make_date(max(year(o_orderdate))::BIGINT + 25, 12, 2), DATE '2021-06-02'),
            INTERVAL 3 MONTH))::DATE) AS d FROM orders)),
    files AS (SELECT DISTINCT 'call' || strftime({PERIOD_SQL}, '%y%m') || '.zip' AS file_name
        FROM orders WHERE o_orderstatus = 'F')
    SELECT year(d)::VARCHAR || 'Q' || quarter(d)::VARCHAR AS quarter, CAST(d AS VARCHAR) AS period,
        'call' || strftime(d, '%y%m') || '.zip' AS file_name,
        ('call' || strftime(d, '%y%m') || '.zip') IN (SELECT file_name FROM files) AS present FROM calendar""")
def archive_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderstatus")
    years = orders.agg(F.min(F.year("o_orderdate")).alias("a"), F.max(F.year("o_orderdate")).alias("b"))
    first = F.make_date(F.col("a") - 25, F.lit(3), F.lit(31))
    last = F.make_date(F.col("b") + 25, F.lit(12), F.lit(31))
    calendar = quarters.explode_quarters(
        years,
        periods.clamp(first, F.lit(ARCHIVE_FIRST), F.lit(ARCHIVE_LAST)),
        periods.clamp(last, F.lit(ARCHIVE_FIRST), F.lit(ARCHIVE_LAST)),
    )
    files = orders.where(F.col("o_orderstatus") == "F").select(
        periods.call_file_name(periods.quarter_end("o_orderdate")).alias("file_name")
    )
    manifest = quarters.expected_files(calendar, files)
    return manifest.select("quarter", as_text("period").alias("period"), "file_name", "present")


NAME_A_SQL = """SELECT o_orderkey, CASE o_orderpriority
        WHEN '1-URGENT' THEN 'call' || strftime(o_orderdate, '%y%m') || '.zip'
        WHEN '2-HIGH' THEN 'CALLP' || strftime(o_orderdate, '%y%m') || '.XPT'
        WHEN '3-MEDIUM' THEN 'my cal' || strftime(o_orderdate, '%y%m') || '-zip.zip'
        ELSE 'report' || strftime(o_orderdate, '%y%m') || '.zip' END AS name FROM orders"""


def _call_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.date_format("o_orderdate", "yyMM")
    priority = F.col("o_orderpriority")
    name = (
        F.when(priority == "1-URGENT", F.concat(F.lit("call"), stamp, F.lit(".zip")))
        .when(priority == "2-HIGH", F.concat(F.lit("CALLP"), stamp, F.lit(".XPT")))
        .when(priority == "3-MEDIUM", F.concat(F.lit("my cal"), stamp, F.lit("-zip.zip")))
        .otherwise(F.concat(F.lit("report"), stamp, F.lit(".zip")))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", name.alias("name"))


@registered(f"""WITH named AS ({NAME_A_SQL}), parts AS (SELECT o_orderkey, name,
        TRY_CAST(regexp_extract(lower(name), 'call?p?(\\d{{2}})(\\d{{2}})', 1) AS BIGINT) AS yy,
        TRY_CAST(regexp_extract(lower(name), 'call?p?(\\d{{2}})(\\d{{2}})', 2) AS BIGINT) AS mm FROM named)
    SELECT o_orderkey, name, CASE WHEN mm IN (3, 6, 9, 12) THEN CAST(last_day(make_date(
        CASE WHEN yy >= 76 THEN 1900 + yy ELSE 2000 + yy END, mm, 1)) AS VARCHAR) END AS period FROM parts""")
def name_period_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    period = periods.period_from_call_name("name")
    return _call_names(spark, sf_dir).select("o_orderkey", "name", as_text(period).alias("period"))


NAME_B_SQL = """SELECT o_orderkey, CASE o_orderstatus
        WHEN 'F' THEN 'CDR Call Bulk All Schedules ' || strftime(o_orderdate, '%m%d%Y') || '.zip'
        WHEN 'O' THEN 'Call_' || strftime(o_orderdate, '%Y%m%d') || '.txt'
        ELSE 'Call_' || strftime(o_orderdate, '%y%m%d') || '.txt' END AS name FROM orders"""
PARSED_B_SQL = f"""SELECT o_orderkey, name, CASE
        WHEN substr(d, 1, 2)::INT BETWEEN 1 AND 12 AND substr(d, 3, 2)::INT BETWEEN 1 AND 31
            AND substr(d, 5, 4)::INT BETWEEN 1985 AND 2030
        THEN make_date(substr(d, 5, 4)::BIGINT, ceil(substr(d, 1, 2)::INT / 3.0)::BIGINT * 3, 1)
        WHEN substr(d, 1, 4)::INT BETWEEN 1985 AND 2030 AND substr(d, 5, 2)::INT BETWEEN 1 AND 12
            AND substr(d, 7, 2)::INT BETWEEN 1 AND 31
        THEN make_date(substr(d, 1, 4)::BIGINT, ceil(substr(d, 5, 2)::INT / 3.0)::BIGINT * 3, 1) END AS m
    FROM (SELECT o_orderkey, name, coalesce(nullif(regexp_extract(name, '(\\d{{8}})', 1), ''), '00000000') AS d
        FROM ({NAME_B_SQL}))"""


def _bulk_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = F.col("o_orderstatus")
    name = (
        F.when(
            state == "F",
            F.concat(F.lit("CDR Call Bulk All Schedules "), F.date_format("o_orderdate", "MMddyyyy"), F.lit(".zip")),
        )
        .when(state == "O", F.concat(F.lit("Call_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".txt")))
        .otherwise(F.concat(F.lit("Call_"), F.date_format("o_orderdate", "yyMMdd"), F.lit(".txt")))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", name.alias("name"))


@registered(f"""SELECT o_orderkey, name, CAST(last_day(m) AS VARCHAR) AS period, CAST(m AS VARCHAR) AS month_start,
    year(m)::VARCHAR || 'Q' || quarter(m)::VARCHAR AS quarter FROM ({PARSED_B_SQL}) WHERE m IS NOT NULL""")
def name_period_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = _bulk_names(spark, sf_dir).withColumn("end", periods.period_from_bulk_name("name"))
    return dated.where(F.col("end").isNotNull()).select(
        "o_orderkey",
        "name",
        as_text("end").alias("period"),
        as_text(periods.reporting_period("end", periods.MONTH_START)).alias("month_start"),
        periods.quarter_label("end").alias("quarter"),
    )


@registered(f"SELECT o_orderkey, name FROM ({PARSED_B_SQL}) WHERE m IS NULL")
def undated_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bulk_names(spark, sf_dir).where(periods.period_from_bulk_name("name").isNull())


# --- dictionary -----------------------------------------------------------------------------


@registered("SELECT p_partkey, upper(p_type || p_size::VARCHAR) AS variable FROM part")
def variable_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = dictionary.variable_key(F.col("p_type"), F.col("p_size"))
    return table(spark, sf_dir, "part").select("p_partkey", key.alias("variable"))


@registered("""SELECT p_partkey, p_brand FROM part
    WHERE p_brand IN ('Brand#1', 'Brand#4', 'Brand#9', 'Brand#12', 'Brand#16', 'Brand#17', 'Brand#21', 'Brand#25')""")
def prefix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = [f"Brand#{n}" for n in (1, 4, 9, 12, 16, 17, 21, 25)]
    parts = table(spark, sf_dir, "part").where(dictionary.has_prefix(F.col("p_brand"), brands))
    return parts.select("p_partkey", "p_brand")


@registered("""SELECT substr(p_type, 1, 2) AS prefix, count(*) AS variables,
    count(*) FILTER (p_size > 20) AS with_forms FROM part
    WHERE substr(p_type, 1, 2) IN ('EC', 'ST', 'PR', 'SM') GROUP BY 1""")
def prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    forms = F.when(F.col("p_size") > 20, F.col("p_brand")).otherwise(F.lit(""))
    known = table(spark, sf_dir, "part").select(F.col("p_type").alias("Variable"), forms.alias("ReportingForms"))
    return dictionary.prefix_counts(known, ["EC", "ST", "PR", "SM", "XX"])


FLAG_SQL = "CASE WHEN l_quantity > 10 THEN l_returnflag || l_linestatus END"


def _forms_by(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    form = F.when(F.col("l_quantity") > 10, F.concat("l_returnflag", "l_linestatus"))
    lines = table(spark, sf_dir, "lineitem").select(key, form.alias("form"))
    return lines.groupBy(key).agg(dictionary.joined_forms(F.col("form")).alias("forms"))


@registered(f"""SELECT l_partkey, coalesce(string_agg(DISTINCT {FLAG_SQL}, ',' ORDER BY {FLAG_SQL}), '') AS forms
    FROM lineitem GROUP BY l_partkey""")
def forms_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _forms_by(spark, sf_dir, "l_partkey")


@registered("""SELECT o_custkey, o_orderpriority, o_orderkey, CAST(end_date AS VARCHAR) AS end_date FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY end_date DESC NULLS FIRST, o_orderkey) AS r
        FROM (SELECT o_custkey, o_orderpriority, o_orderkey,
            CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) END AS end_date FROM orders)) WHERE r = 1""")
def latest_definition(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate").cast("date"))
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_orderkey", end.alias("end_date"))
    latest = dictionary.keep_latest(
        orders, "o_custkey", "end_date", ["o_orderpriority", "o_orderkey"], [F.col("o_orderkey")]
    )
    return latest.withColumn("end_date", as_text("end_date"))


CLEAN_SQL = """trim(regexp_replace(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(html,
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&copy;', chr(169)), '&middot;', chr(183)),
    '&amp;?', '&', 'g'), '<[^>]+>', '', 'g'),
    '[\\s\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+', ' ', 'g'))"""


@registered(f"SELECT page_id, {CLEAN_SQL} AS description FROM pages")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", text.clean_text(F.col("html")).alias("description"))


@registered("""SELECT doc_id, description FROM (SELECT doc_id,
    CASE lang WHEN 'en' THEN '' WHEN 'de' THEN NULL ELSE text END AS description FROM documents) WHERE length(description) > 0""")
def nonempty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    lang = F.col("lang")
    description = F.when(lang == "en", F.lit("")).when(lang != "de", F.col("text"))
    documents = table(spark, sf_dir, "documents").select("doc_id", description.alias("description"))
    return dictionary.drop_empty(documents, "description")


@registered("""SELECT Description, ReportingForms, count(*) AS lines, round(sum(l_quantity), 2) AS quantity FROM (
        SELECT coalesce(p_type, '') AS Description, coalesce(p_brand, '') AS ReportingForms, l_quantity
        FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size <= 25) ON l_partkey = p_partkey) GROUP BY 1, 2""")
def dictionary_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").where(F.col("p_size") <= 25)
    known = part.select(
        F.concat(F.lit("PART"), F.col("p_partkey").cast("string")).alias("Variable"),
        F.col("p_type").alias("Description"),
        F.col("p_brand").alias("ReportingForms"),
    )
    lines = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("q")
    )
    named = lines.withColumn("variable", F.concat(F.lit("part"), F.col("l_partkey").cast("string")))
    found = dictionary.lookup(named, known, "variable", ["Description", "ReportingForms"])
    return found.groupBy("Description", "ReportingForms").agg(
        F.sum("n").alias("lines"), F.round(F.sum("q"), 2).alias("quantity")
    )


@registered(f"""SELECT l_orderkey, forms FROM (SELECT l_orderkey, list({FLAG_SQL}) AS l,
        coalesce(string_agg(DISTINCT {FLAG_SQL}, ',' ORDER BY {FLAG_SQL}), '') AS forms
    FROM lineitem GROUP BY l_orderkey) WHERE list_has_any(l, ['AF', 'RO'])""")
def form_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    allowed = F.array(F.lit("AF"), F.lit("RO"))
    return _forms_by(spark, sf_dir, "l_orderkey").where(prune.forms_overlap(F.col("forms"), allowed))


@registered("""SELECT o_orderkey, o_orderpriority FROM orders
    WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag IN ('A', 'R'))""")
def form_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return prune.on_form(orders, "o_orderkey", table(spark, sf_dir, "lineitem"), "l_orderkey", "l_returnflag", ["A", "R"])


DATE_TEXT_SQL = """CASE o_orderpriority
    WHEN '1-URGENT' THEN strftime(o_orderdate, '%-m/%-d/%Y') || ' 12:00:00 AM'
    WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y-%m-%d') WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%m/%d/%Y')
    WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, ' %Y%m%d ') ELSE 'since ' || strftime(o_orderdate, '%Y') END"""


def _date_text() -> Column:
    priority = F.col("o_orderpriority")
    return (
        F.when(priority == "1-URGENT", F.concat(F.date_format("o_orderdate", "M/d/yyyy"), F.lit(" 12:00:00 AM")))
        .when(priority == "2-HIGH", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(priority == "3-MEDIUM", F.date_format("o_orderdate", "MM/dd/yyyy"))
        .when(priority == "4-NOT SPECIFIED", F.date_format("o_orderdate", " yyyyMMdd "))
        .otherwise(F.concat(F.lit("since "), F.date_format("o_orderdate", "yyyy")))
    )


@registered(f"""SELECT o_orderkey, {DATE_TEXT_SQL} AS written, CASE WHEN o_orderpriority <> '5-LOW'
    THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS parsed FROM orders""")
def tolerant_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("written", _date_text())
    return orders.select("o_orderkey", "written", as_text(text.parse_date(F.col("written"))).alias("parsed"))


DICTIONARY_SQL = """WITH raw AS (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'RCON' WHEN '2-HIGH' THEN 'RCFD'
            WHEN '3-MEDIUM' THEN 'RIAD' WHEN '4-NOT SPECIFIED' THEN 'BHCK' ELSE 'RCOA' END AS m,
            'k' || o_custkey::VARCHAR AS code,
            CASE WHEN o_totalprice > 450000 THEN '' ELSE 'Order ' || o_orderkey::VARCHAR || ' & total' END AS name,
            CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS ended,
            'FORM ' || year(o_orderdate)::VARCHAR AS form, o_orderkey FROM orders),
    kept AS (SELECT upper(m || code) AS v, * FROM raw WHERE m <> 'BHCK'),
    latest AS (SELECT v, name FROM (SELECT v, name, row_number() OVER (PARTITION BY v
        ORDER BY ended DESC NULLS FIRST, CASE WHEN name = '' THEN '' ELSE '&lt;b&gt;' || name END) AS r FROM kept) WHERE r = 1),
    forms AS (SELECT v, string_agg(DISTINCT form, ',' ORDER BY form) AS f FROM kept GROUP BY v)
    SELECT v AS Variable, name AS Description, f AS ReportingForms FROM latest JOIN forms USING (v) WHERE name <> ''"""


def _dictionary_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority, key = F.col("o_orderpriority"), F.col("o_orderkey").cast("string")
    mnemonic = (
        F.when(priority == "1-URGENT", "RCON")
        .when(priority == "2-HIGH", "RCFD")
        .when(priority == "3-MEDIUM", "RIAD")
        .when(priority == "4-NOT SPECIFIED", "BHCK")
        .otherwise("RCOA")
    )
    named = F.concat(F.lit("&lt;b&gt;Order&nbsp; "), key, F.lit("&lt;/b&gt; \n &amp; total"))
    return table(spark, sf_dir, "orders").select(
        mnemonic.alias("Mnemonic"),
        F.concat(F.lit("k"), F.col("o_custkey").cast("string")).alias("Item Code"),
        F.when(F.col("o_totalprice") > 450000, F.lit("")).otherwise(named).alias("Item Name"),
        F.when(F.col("o_orderstatus") != "O", F.date_format("o_orderdate", "M/d/yyyy h:mm:ss a")).alias("End Date"),
        F.concat(F.lit("FORM "), F.year("o_orderdate").cast("string")).alias("Reporting Form"),
    )


@registered(DICTIONARY_SQL)
def dictionary_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionary.build_dictionary(_dictionary_export(spark, sf_dir))


@registered(DICTIONARY_SQL)
def dictionary_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from an export in CSV files, through the stored dictionary's CSV."""
    export, folder = shared_folder(spark, "export"), shared_folder(spark, "dictionary")
    writer = _dictionary_export(spark, sf_dir).write.option("header", True).option("quoteAll", True)
    writer.option("escape", '"').csv(export)
    raw = read_dictionary_csv(spark, export, preamble=0)
    stored, _ = write_dictionary(dictionary.build_dictionary(raw), folder)
    reader = spark.read.schema("Variable string, Description string, ReportingForms string")
    return reader.option("header", True).option("escape", '"').csv(stored)


# --- merging schedules ------------------------------------------------------------------------


def _schedules(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    customers = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.round(F.sum("o_totalprice"), 2).alias("balance"), F.count("*").alias("n_orders")
    )
    parts = table(spark, sf_dir, "part")  # their keys reach beyond those of customers
    return [
        customers.select(F.col("c_custkey").alias("filer_id"), F.col("c_acctbal").alias("balance"), "c_name"),
        orders.withColumnRenamed("o_custkey", "filer_id"),
        parts.select(
            F.col("p_partkey").alias("filer_id"), F.col("p_retailprice").alias("balance"), "p_brand",
            F.lit(None).cast("bigint").alias("n_orders"),
        ),
    ]


SCHEDULES_SQL = """a AS (SELECT c_custkey AS filer_id, c_acctbal AS balance, c_name FROM customer),
    b AS (SELECT o_custkey AS filer_id, round(sum(o_totalprice), 2) AS balance_b, count(*) AS n_orders FROM orders GROUP BY 1),
    c AS (SELECT p_partkey AS filer_id, p_retailprice AS balance_c, p_brand FROM part)"""
MERGE_SQL = f"""WITH {SCHEDULES_SQL} SELECT filer_id, a.balance, a.c_name, b.n_orders, c.p_brand
    FROM a FULL JOIN b USING (filer_id) FULL JOIN c USING (filer_id)"""


@registered(MERGE_SQL)
def schedule_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_schedules(_schedules(spark, sf_dir), "filer_id")


@registered(MERGE_SQL)
def schedule_merge_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_unique_schedules(_schedules(spark, sf_dir), "filer_id")


@registered(f"""WITH {SCHEDULES_SQL} SELECT filer_id, coalesce(a.balance, b.balance_b, c.balance_c) AS balance, a.c_name,
    b.n_orders, c.p_brand FROM a FULL JOIN b USING (filer_id) FULL JOIN c USING (filer_id)""")
def schedule_merge_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_schedules(_schedules(spark, sf_dir), "filer_id", coalesce=True)


@registered(f"""WITH {SCHEDULES_SQL} SELECT 0::BIGINT AS member_ordinal, filer_id, 'balance' AS variable, balance AS num_value FROM a
    UNION ALL SELECT 1, filer_id, 'n_orders', n_orders::DOUBLE FROM b""")
def schedule_merge_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = _schedules(spark, sf_dir)
    numeric = [["balance"], ["balance", "n_orders"], ["balance", "n_orders"]]
    long, headers = [], []
    for ordinal, (member, variables) in enumerate(zip(members, numeric)):
        tagged = reshape.to_long(member, ["filer_id"], variables)
        long.append(tagged.withColumn("member_ordinal", F.lit(ordinal).cast("bigint")))
        headers += [(ordinal, variable) for variable in variables]
    catalog = spark.createDataFrame(headers, "member_ordinal bigint, variable string")
    kept = merge.keep_first_member(merge.union_sources(long), catalog, ["variable"])
    return kept.select("member_ordinal", "filer_id", "variable", "num_value")


@registered("SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def processed_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return merge.without_processed(documents, table(spark, sf_dir, "labels"), ["doc_id"])


@registered("""SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""")
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
    )
    return merge.union_sources([customers, suppliers])


@registered("SELECT c_nationkey AS nationkey FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier")
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nationkey"))
    return merge.column_difference(customers, table(spark, sf_dir, "supplier").select("s_nationkey"))


# --- columns, types and pruning -----------------------------------------------------------------

def _sparse_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as a wide filing: some columns filled in part, some not at all."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        F.col("l_returnflag").alias("flag"),
        F.col("l_suppkey").alias("rssd9001"),
        F.when(F.col("l_quantity") > 25, F.col("l_quantity")).alias("rcon_quantity"),
        F.when(F.col("l_discount") > 0.05, F.col("l_extendedprice")).alias("rcfd_price"),
        F.when(F.col("l_tax") > 1, F.col("l_tax")).alias("riad_tax"),
        F.when(F.col("l_discount") > 1, F.col("l_discount")).alias("rcoa_discount"),
        F.when(F.col("l_returnflag") == "A", F.lit(float("nan"))).alias("rcfa_ratio"),
    )


SPARSE_SQL = """SELECT l_returnflag AS flag, l_suppkey AS rssd9001, CASE WHEN l_quantity > 25 THEN l_quantity END AS rcon_quantity,
    CASE WHEN l_discount > 0.05 THEN l_extendedprice END AS rcfd_price, CASE WHEN l_tax > 1 THEN l_tax END AS riad_tax,
    CASE WHEN l_discount > 1 THEN l_discount END AS rcoa_discount, NULL AS rcfa_ratio FROM lineitem"""
_VARIABLES = ("rcon_quantity", "rcfd_price", "riad_tax", "rcoa_discount", "rcfa_ratio")
PROFILE_SQL = " UNION ALL ".join(
    f"SELECT flag, '{v}' AS variable, count({v}) AS n_values FROM ({SPARSE_SQL}) GROUP BY flag" for v in _VARIABLES
)


@registered(f"SELECT flag, variable, n_values, n_values = 0 AS all_null FROM ({PROFILE_SQL})")
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prune.profile_columns(_sparse_lines(spark, sf_dir), _VARIABLES, ["flag"])


def _form_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variables on forms, derived from the part table: the two tax-like variables and the price."""
    parts = table(spark, sf_dir, "part")
    form = F.concat(F.lit("FORM "), F.col("p_type"))
    variable = (
        F.when(F.col("p_type") == "PROMO", "RIAD_TAX")
        .when(F.col("p_type") == "LARGE", "RCOA_DISCOUNT")
        .when(F.col("p_type") == "SMALL", "RCFD_PRICE")
    )
    rows = parts.select(variable.alias("Variable"), form.alias("form")).where(F.col("Variable").isNotNull())
    forms = rows.groupBy("Variable").agg(dictionary.joined_forms(F.col("form")).alias("ReportingForms"))
    return forms.withColumn("Description", F.concat(F.lit("Total of "), F.lower("Variable")))


@registered(f"""SELECT upper(variable) AS variable, CAST(n AS BIGINT) AS n_values FROM (
        SELECT variable, sum(n_values) AS n FROM ({PROFILE_SQL}) GROUP BY 1
        UNION ALL SELECT 'rssd9001', count(*) FROM lineitem)
    WHERE n > 0 OR upper(variable) IN (SELECT 'RIAD_TAX' FROM part WHERE p_type = 'PROMO')""")
def form_or_data_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = columns.upper_columns(_sparse_lines(spark, sf_dir).drop("flag"))
    pruned = prune.prune_columns(lines, ["FORM PROMO", "FORM SMALL"], _form_dictionary(spark, sf_dir))
    ordered = columns.order_columns(pruned, ["RSSD9001"], "sorted")
    return prune.profile_columns(ordered, ordered.columns).drop("all_null")


@registered(f"""SELECT entity_type, quarter, variable, CAST(n_values AS BIGINT) AS n_values FROM ({CATALOG_SQL})
    WHERE n_values > 0 OR variable IN (SELECT '1-URGENT_' || s_nationkey::VARCHAR FROM supplier)""")
def catalog_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("1-URGENT_"), F.col("s_nationkey").cast("string")).alias("Variable"), F.lit("FORM X").alias("f")
    )
    forms = suppliers.groupBy("Variable").agg(dictionary.joined_forms(F.col("f")).alias("ReportingForms"))
    return prune.prune_catalog(variable_catalog(spark, sf_dir), forms, allowed=F.array(F.lit("FORM X"), F.lit("FORM Y")))


def _part_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    wide = parts.select(
        "p_partkey",
        F.col("p_brand").alias("brand"),
        F.col("p_size").cast("string").alias("size"),
        F.col("p_retailprice").cast("string").alias("price"),
        F.when(F.col("p_size") != 50, F.col("p_size").cast("string")).otherwise("50d").alias("mixed"),
        F.when(F.col("p_size") < 25, F.lit("NA")).otherwise(F.col("p_size").cast("string")).alias("gappy"),
    )
    long = wide.unpivot(["p_partkey"], ["brand", "size", "price", "mixed", "gappy"], "variable", "raw")
    return long.withColumn("raw", text.na_to_null(F.col("raw"))).where(F.col("raw").isNotNull())


PART_TEXT_SQL = """SELECT 'brand' AS variable, count(*) AS n_values, count(*) AS n_text FROM part
    UNION ALL SELECT 'size', count(*), 0 FROM part UNION ALL SELECT 'price', count(*), 0 FROM part
    UNION ALL SELECT 'mixed', count(*), count(*) FILTER (p_size = 50) FROM part
    UNION ALL SELECT 'gappy', count(*) FILTER (p_size >= 25), 0 FROM part"""


@registered(f"SELECT variable, n_values, n_text, n_text = 0 AS is_numeric FROM ({PART_TEXT_SQL})")
def numeric_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inference.numeric_verdicts(_part_texts(spark, sf_dir), ["variable"])


@registered("""SELECT p_partkey, 'brand' AS variable, NULL::DOUBLE AS num_value, p_brand AS str_value FROM part
    UNION ALL SELECT p_partkey, 'size', p_size::DOUBLE, NULL FROM part
    UNION ALL SELECT p_partkey, 'price', p_retailprice, NULL FROM part
    UNION ALL SELECT p_partkey, 'mixed', NULL, p_size::VARCHAR || CASE WHEN p_size = 50 THEN 'd' ELSE '' END FROM part
    UNION ALL SELECT p_partkey, 'gappy', p_size::DOUBLE, NULL FROM part WHERE p_size >= 25""")
def typed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _part_texts(spark, sf_dir)
    verdicts = inference.numeric_verdicts(cells, ["variable"])
    return inference.typed_values(cells, verdicts, ["variable"]).select("p_partkey", "variable", "num_value", "str_value")


ID_TEXT_SQL = """split_part(p_brand, '#', 2) || CASE p_type WHEN 'STANDARD' THEN '' WHEN 'ECONOMY' THEN '.7 '
    WHEN 'PROMO' THEN 'e1' WHEN 'LARGE' THEN 'd' WHEN 'SMALL' THEN '%' ELSE ' of ' || p_name END"""


@registered(f"""SELECT p_partkey, written, CAST(trunc(CAST(written AS DOUBLE)) AS BIGINT) AS filer_id
    FROM (SELECT p_partkey, p_type, {ID_TEXT_SQL} AS written FROM part) WHERE p_type IN ('STANDARD', 'ECONOMY', 'PROMO')""")
def coerce_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_type")
    suffix = (
        F.when(kind == "STANDARD", F.lit(""))
        .when(kind == "ECONOMY", F.lit(".7 "))
        .when(kind == "PROMO", F.lit("e1"))
        .when(kind == "LARGE", F.lit("d"))
        .when(kind == "SMALL", F.lit("%"))
        .otherwise(F.concat(F.lit(" of "), F.col("p_name")))
    )
    written = F.concat(F.split_part("p_brand", F.lit("#"), F.lit(2)), suffix)
    parts = table(spark, sf_dir, "part").select("p_partkey", written.alias("written"))
    return parts.withColumn("filer_id", text.parse_filer_id(F.col("written"))).where(F.col("filer_id").isNotNull())


@registered("""SELECT '2001-06-30' AS REPORTING_PERIOD, c_custkey AS RSSD_ID, c_custkey AS "RSSD9001",
    c_acctbal AS "RCON_BALANCE", c_mktsegment AS "RCON_SEGMENT" FROM customer""")
def column_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("rcon_segment"), F.col("c_custkey").alias("RSSD9001"), F.col("c_acctbal").alias("rcon_balance")
    )
    dated = columns.attach_period(columns.attach_filer_id(customers), F.lit(dt.date(2001, 5, 2)))
    ordered = columns.order_columns(columns.upper_columns(dated), ["REPORTING_PERIOD", "RSSD_ID"], "sorted")
    return ordered.withColumn("REPORTING_PERIOD", as_text("REPORTING_PERIOD"))


MEASURES = {"quantity": "l_quantity", "price": "l_extendedprice", "discount": "l_discount", "tax": "l_tax"}


@registered(
    "SELECT l_suppkey AS filer_id, "
    + ", ".join(f"round(sum({c}), 2) AS {v}" for v, c in MEASURES.items())
    + " FROM lineitem GROUP BY 1"
)
def long_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("filer_id"), *[F.col(c).alias(v) for v, c in MEASURES.items()]
    )
    long = reshape.to_long(lines, ["filer_id"], list(MEASURES))
    summed = long.groupBy("filer_id", "variable").agg(
        F.sum("num_value").alias("num_value"), F.max("str_value").alias("str_value")
    )
    wide = reshape.pivot_values(summed, ["filer_id"], dict.fromkeys(MEASURES, "double"))
    return wide.select("filer_id", *[F.round(v, 2).alias(v) for v in MEASURES])


WIDE = {"F": "double", "O": "double", "top": "string"}


@registered(f"""SELECT r.filer_id, r.quarter, CAST(r.period AS VARCHAR) AS period,
        round(sum(o_totalprice) FILTER (o_orderstatus = 'F'), 2) AS "F", round(sum(o_totalprice) FILTER (o_orderstatus = 'O'), 2) AS "O",
        max(o_orderpriority) FILTER (o_orderstatus <> 'P') AS top
    FROM (SELECT DISTINCT o_custkey AS filer_id, {QUARTER_SQL} AS quarter, {PERIOD_SQL} AS period FROM orders) r
    JOIN orders o ON o.o_custkey = r.filer_id AND {QUARTER_SQL} = r.quarter GROUP BY ALL""")
def panel_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("filer_id"),
        periods.quarter_label("o_orderdate").alias("quarter"),
        periods.quarter_end("o_orderdate").alias("period"),
        "o_orderstatus",
        "o_orderpriority",
        "o_totalprice",
    )
    keys = ("filer_id", "quarter", "period")
    filed = orders.where(F.col("o_orderstatus") != "P")
    nothing = F.lit(None).cast("string")
    numbers = filed.groupBy(*keys, F.col("o_orderstatus").alias("variable")).agg(
        F.sum("o_totalprice").alias("num_value"), F.first(nothing).alias("str_value")
    )
    texts = filed.groupBy(*keys, F.lit("top").alias("variable")).agg(
        F.max(F.lit(None).cast("double")).alias("num_value"), F.max("o_orderpriority").alias("str_value")
    )
    wide = reshape.to_wide(numbers.unionByName(texts), orders.select(*keys).distinct(), WIDE, keys)
    return wide.select(
        "filer_id", "quarter", as_text("period").alias("period"), F.round("F", 2).alias("F"), F.round("O", 2).alias("O"), "top"
    )


@registered(f"""SELECT variable, description, CAST(n AS BIGINT) AS n_values FROM (
        SELECT upper(variable) AS variable, sum(n_values) AS n FROM ({PROFILE_SQL}) GROUP BY 1) p
    JOIN (SELECT DISTINCT CASE p_type WHEN 'PROMO' THEN 'RIAD_TAX' WHEN 'LARGE' THEN 'RCOA_DISCOUNT' ELSE 'RCFD_PRICE' END AS v,
        'Total of ' || lower(v) AS description FROM part WHERE p_type IN ('PROMO', 'LARGE', 'SMALL')) d ON p.variable = d.v""")
def described_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = columns.upper_columns(_sparse_lines(spark, sf_dir))
    known = _form_dictionary(spark, sf_dir)
    described = describe.describe_columns(lines, describe.descriptions_for(lines, known))
    texts = describe.column_descriptions(described)
    profile = prune.profile_columns(described, list(texts)).drop("all_null")
    listed = spark.createDataFrame(list(texts.items()), "variable string, description string")
    return profile.join(listed, "variable")


# --- coverage -----------------------------------------------------------------------------------


@registered(f"""SELECT entity_type, quarter, CAST(date AS VARCHAR) AS date, num_rows, num_banks, num_variables, num_non_null_vars,
    num_null_columns, CAST(year(date) AS BIGINT) AS year, CAST(quarter(date) AS BIGINT) AS quarter_num FROM ({SUMMARY_SQL})""")
def quarter_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = coverage.with_quarter_parts(summary_table(spark, sf_dir))
    return summary.withColumns(
        {"date": as_text("date"), "year": F.col("year").cast("bigint"), "quarter_num": F.col("quarter_num").cast("bigint")}
    )


@registered(f"""SELECT entity_type, quarter, CAST(date AS VARCHAR) AS date, num_banks, num_variables,
    CAST(year(date) AS BIGINT) AS year, CAST(quarter(date) AS BIGINT) AS quarter_num FROM ({SUMMARY_SQL})""")
def summary_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "summary")
    write_summary(summary_table(spark, sf_dir), folder)
    stored = spark.read.option("header", True).csv(folder)
    counts = ("num_banks", "num_variables", "year", "quarter_num")
    return stored.select("entity_type", "quarter", "date", *[F.col(c).cast("bigint").alias(c) for c in counts])


PIVOT_SQL = ", ".join(
    f"max(CASE WHEN entity_type = '{e}' THEN {v} END) AS \"{e}_{v}\"" for e in ENTITIES for v in ("num_banks", "num_variables")
)


@registered(f"SELECT quarter, CAST(min(date) AS VARCHAR) AS date, {PIVOT_SQL} FROM ({SUMMARY_SQL}) GROUP BY quarter")
def quarter_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.pivot_quarters(summary_table(spark, sf_dir), ENTITIES).withColumn("date", as_text("date"))


@registered(f"""SELECT entity_type, count(*) AS quarters, round(avg(num_banks), 6) AS avg_filers, round(avg(num_variables), 6) AS avg_variables,
    CAST(min(date) AS VARCHAR) AS first_date, CAST(max(date) AS VARCHAR) AS last_date FROM ({SUMMARY_SQL}) GROUP BY 1""")
def entity_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = coverage.entity_statistics(summary_table(spark, sf_dir))
    return stats.withColumns(
        {
            "avg_filers": F.round("avg_filers", 6),
            "avg_variables": F.round("avg_variables", 6),
            "first_date": as_text("first_date"),
            "last_date": as_text("last_date"),
        }
    )


_COUNTS = ("num_banks", "num_variables", "num_non_null_vars", "num_null_columns")


@registered(
    "SELECT count(*) AS quarters, CAST(min(date) AS VARCHAR) AS first_date, CAST(max(date) AS VARCHAR) AS last_date, "
    + ", ".join(f"round(avg({c}), 6) AS {c}_avg, min({c}) AS {c}_min, max({c}) AS {c}_max" for c in _COUNTS)
    + f" FROM ({SUMMARY_SQL})"
)
def overall_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = coverage.overall_statistics(summary_table(spark, sf_dir))
    return stats.withColumns(
        {
            "first_date": as_text("first_date"),
            "last_date": as_text("last_date"),
            **{f"{c}_avg": F.round(f"{c}_avg", 6) for c in _COUNTS},
        }
    )


STATUS_SQL = """SELECT o_orderpriority AS entity_type, CASE o_orderstatus WHEN 'F' THEN 'processed' WHEN 'O' THEN 'skipped'
    ELSE 'error' END AS state, o_custkey AS records, o_orderkey AS columns FROM orders"""


def _status(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = F.when(F.col("o_orderstatus") == "F", "processed").when(F.col("o_orderstatus") == "O", "skipped").otherwise("error")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("entity_type"),
        state.alias("state"),
        F.col("o_custkey").alias("records"),
        F.col("o_orderkey").alias("columns"),
    )


@registered(f"""SELECT entity_type, count(*) FILTER (state = 'processed') AS processed, count(*) FILTER (state = 'skipped') AS skipped,
    count(*) FILTER (state = 'error') AS errors, CAST(coalesce(sum(records) FILTER (state = 'processed'), 0) AS BIGINT) AS records,
    CAST(sum(columns) FILTER (state = 'processed') // nullif(count(*) FILTER (state = 'processed'), 0) AS BIGINT) AS avg_columns
    FROM ({STATUS_SQL}) GROUP BY 1""")
def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.run_statistics(_status(spark, sf_dir))


@registered(f"SELECT state, count(*) AS files FROM ({STATUS_SQL}) GROUP BY 1")
def run_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.state_counts(_status(spark, sf_dir))


GAPS_SQL = f"""SELECT o_custkey, {_label_sql('i + 1')} AS missing_quarter, n - 1 + CASE WHEN nxt > i + 1 THEN 1 ELSE 0 END AS entries,
        CAST(coalesce(nxt - i - 1, 0) AS BIGINT) AS missing, i FROM (
        SELECT o_custkey, i, n, lead(i) OVER (PARTITION BY o_custkey ORDER BY i) AS nxt FROM (
            SELECT o_custkey, {INDEX_SQL} AS i, count(*) AS n FROM orders GROUP BY 1, 2))
    WHERE n - 1 + CASE WHEN nxt > i + 1 THEN 1 ELSE 0 END > 0"""


def _filer_gaps(spark: SparkSession, sf_dir: str, expand: bool = False) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    return gaps.find_gaps(orders, "o_orderdate", ["o_custkey"], expand)


@registered(f"SELECT o_custkey, missing_quarter, entries, missing FROM ({GAPS_SQL})")
def gap_first_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filer_gaps(spark, sf_dir).withColumn("missing", F.col("missing").cast("bigint"))


@registered(f"""SELECT o_custkey, {_label_sql('q')} AS missing_quarter FROM (
    SELECT o_custkey, unnest(range(i + 1, i + 1 + missing)) AS q FROM ({GAPS_SQL}))""")
def gap_all_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filer_gaps(spark, sf_dir, expand=True)


@registered(f"""SELECT o_custkey, array_to_string(list_slice(flatten(list(
        list_transform(range(entries), lambda x: missing_quarter) ORDER BY i)), 1, 10), ', ') AS preview,
    CAST(greatest(sum(entries) - 10, 0) AS BIGINT) AS more FROM ({GAPS_SQL}) GROUP BY 1""")
def gap_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.preview_gaps(_filer_gaps(spark, sf_dir), ["o_custkey"])


@registered(f"""SELECT entity_type, {_label_sql('i + 1')} AS missing_quarter, CAST(1 AS BIGINT) AS entries, nxt - i - 1 AS missing FROM (
    SELECT entity_type, i, lead(i) OVER (PARTITION BY entity_type ORDER BY i) AS nxt FROM (
        SELECT DISTINCT o_orderpriority || ' ' || (o_custkey % 500)::VARCHAR AS entity_type, {INDEX_SQL} AS i FROM orders))
    WHERE nxt > i + 1""")
def gap_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = F.concat_ws(" ", "o_orderpriority", F.col("o_custkey") % 500)
    filed = table(spark, sf_dir, "orders").select(group.alias("entity_type"), periods.quarter_end("o_orderdate").alias("period"))
    found = gaps.find_gaps(filed.distinct(), "period", ["entity_type"])
    return found.withColumn("missing", F.col("missing").cast("bigint"))


@registered("""SELECT c_nationkey, array_to_string(list_slice(list(c_name ORDER BY c_acctbal DESC, c_custkey), 1, 5), ', ') AS preview,
    CAST(greatest(count(*) - 5, 0) AS BIGINT) AS more FROM customer GROUP BY 1""")
def first_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    order = [F.col("c_acctbal").desc(), F.col("c_custkey")]
    return gaps.preview_first(customers, ["c_nationkey"], F.col("c_name"), order, 5)


# --- sources and sinks ----------------------------------------------------------------------------


@registered("""SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderpriority ELSE 'Other' END AS folder,
    CAST(count(DISTINCT o_orderpriority) AS BIGINT) AS files, sum(length(o_orderkey::VARCHAR || ';' || o_orderstatus) + 1) / 1048576 AS size_mb
    FROM orders GROUP BY 1""")
def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    lines = orders.select("o_orderpriority", F.concat_ws(";", "o_orderkey", "o_orderstatus").alias("line"))
    folder = shared_folder(spark, "inventory")
    # One file for each priority, in a folder of its name.
    lines.repartition("o_orderpriority").sortWithinPartitions("o_orderpriority").write.partitionBy("o_orderpriority").text(folder)
    listed = list_files(spark, folder, "*.txt", recursive=True)
    known = [f"o_orderpriority={p}" for p in ("1-URGENT", "2-HIGH")]
    group = F.regexp_replace(inventory.folder_of(F.col("path"), known), "^o_orderpriority=", "")
    return inventory.size_by(listed, group, "folder")


@registered("""SELECT o_orderkey AS filer_id, 'RCON_PRICE' AS variable, o_totalprice AS num_value, NULL AS str_value FROM orders
    UNION ALL SELECT o_orderkey, 'RCON_FILER', o_custkey::DOUBLE, NULL FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT o_orderkey, 'RCFD_NOTE', NULL, '"' || o_orderpriority || '"' || chr(9) || chr(10) || o_orderstatus FROM orders""")
def delimited_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    note = F.concat(F.lit('"'), "o_orderpriority", F.lit('"\t\n'), "o_orderstatus")
    schedule = table(spark, sf_dir, "orders").select(
        F.col("o_totalprice").alias("rcon_price"),
        F.col("o_orderkey").alias("IDRSSD"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string")).otherwise("N/A").alias("rcon_filer"),
        note.alias("rcfd_note"),
    )
    folder = shared_folder(spark, "schedules")
    writer = schedule.write.option("sep", "\t").option("header", True).option("escape", '"')
    writer.option("maxRecordsPerFile", 10_000).csv(folder)
    # Written once: the verdicts and the values both start from the decoded rows.
    rows = staged(read_delimited(spark, folder, pattern="*.csv"), "decoded").where(F.col("row_no") >= 0)
    cells = rows.select("path", "filer_id", F.explode("cells").alias("c")).select("path", "filer_id", "c.variable", "c.raw")
    verdicts = inference.numeric_verdicts(cells, ["path", "variable"])
    typed = inference.typed_values(cells, verdicts, ["path", "variable"])
    return typed.select("filer_id", "variable", "num_value", "str_value")


@registered("SELECT doc_id, text FROM documents")
def bytes_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    latin1 = F.encode("text", "ISO-8859-1")
    content = F.when(F.col("lang").isin("de", "fr"), latin1).otherwise(F.encode("text", "UTF-8"))
    return table(spark, sf_dir, "documents").select("doc_id", text.decode_bytes(content).alias("text"))


@registered(f"""SELECT o_orderpriority AS entity_type, {QUARTER_SQL} AS quarter, count(*) AS "rows", round(sum(o_totalprice), 2) AS total
    FROM orders GROUP BY ALL""")
def partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("entity_type"),
        periods.quarter_label("o_orderdate").alias("quarter"),
        "o_orderstatus",
        "o_totalprice",
    )
    folder = shared_folder(spark, "partitions")
    write_partitioned(orders.where(F.col("entity_type") != "5-LOW"), folder)
    # Replaces the two entity types' quarters and adds those of the last one; the others stay.
    write_partitioned(orders.where(F.col("entity_type").isin("1-URGENT", "5-LOW")), folder)
    stored = spark.read.parquet(folder)
    return stored.groupBy("entity_type", "quarter").agg(
        F.count("*").alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@registered(f"""SELECT {QUARTER_SQL} AS quarter, count(*) AS "rows", round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = os.path.join(sf_dir, "*orders.parquet")  # a pattern may match a file as well as a folder
    schema = table(spark, sf_dir, "orders").schema
    out, checkpoint = shared_folder(spark, "stream"), shared_folder(spark, "stream-checkpoint")

    def tagged(rows: DataFrame) -> DataFrame:
        return coverage.tag_quarter(rows, "o_orderdate").select("o_orderkey", "o_totalprice", "quarter")

    for _ in range(2):  # The second run finds no new file and must add nothing.
        append_new_rows(spark, source, schema, tagged, out, checkpoint, ("quarter",)).awaitTermination()
    stored = spark.read.parquet(out)
    return stored.groupBy("quarter").agg(F.count("*").alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("total"))

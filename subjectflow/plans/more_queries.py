"""Queries for operators that the others do not reach: merges, metadata, rows of reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from subjectflow.operators import compare, longitudinal, merges, picks, spec, subject, summary, survival
from subjectflow.plans.analogs import exposure, raw_results, subjects, table, with_views
from subjectflow.plans.quality_queries import _CATALOG, CUSTOMER_SPEC, catalog
from subjectflow.plans.registry import query
from subjectflow.session import scratch_path
from subjectflow.sources import splits, tables


@query(
    "merge_mixed_keys",
    """SELECT o_orderkey, c_name AS name, c_nationkey AS siteid FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def merge_mixed_keys(spark, sf_dir):
    """A merge whose key is a 64-bit number on one side, a 32-bit one in a decimal on the other."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("usubjid"))
    c = subjects(spark, sf_dir).select(F.col("usubjid").cast("int").cast("decimal(12,1)").alias("usubjid"), "name", "siteid")
    return merges.merge_vars(o, c, ["usubjid"], ["name", "siteid"]).drop("usubjid")


@query(
    "merge_null_keys",
    """WITH s AS (SELECT c_custkey, CASE WHEN c_nationkey % 4 > 0 THEN c_nationkey END AS k FROM customer),
       n AS (SELECT CASE WHEN n_nationkey > 0 THEN n_nationkey END AS k, n_name FROM nation)
       SELECT c_custkey, n_name FROM s LEFT JOIN n ON s.k IS NOT DISTINCT FROM n.k""",
)
def merge_null_keys(spark, sf_dir):
    """A merge in which a missing key matches a missing key."""
    s = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_nationkey") % 4 > 0, F.col("c_nationkey")).alias("k"))
    n = table(spark, sf_dir, "nation").select(F.nullif("n_nationkey", F.lit(0)).alias("k"), "n_name")
    return merges.merge_vars(s, n, ["k"], ["n_name"], null_safe=True).drop("k")


@query(
    "natural_join",
    """SELECT n_nationkey AS key, s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey < 3""",
)
def natural_join(spark, sf_dir):
    """Inner join on every shared column name."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("key"), "s_suppkey")
    n = table(spark, sf_dir, "nation").filter("n_regionkey < 3").select(F.col("n_nationkey").alias("key"), "n_name")
    return merges.natural_join(s, n)


@query("spec_lookup", _CATALOG + " SELECT dataset, variable, type, label FROM catalog WHERE upper(dataset) = 'BRAND#7'")
def spec_lookup(spark, sf_dir):
    """The entries of a catalogue that describe one dataset, whatever the case."""
    return spec.select_dataset(catalog(spark, sf_dir), "brand#7").select("dataset", "variable", "type", "label")


@query(
    "text_file_lines",
    """SELECT row_number() OVER (ORDER BY n_nationkey) AS line_no, n_name AS line FROM nation""",
)
def text_file_lines(spark, sf_dir):
    """Numbered lines of a report file."""
    path = scratch_path(spark, "lines")
    table(spark, sf_dir, "nation").coalesce(1).sortWithinPartitions("n_nationkey").select("n_name").write.text(path)
    return tables.read_lines(spark, path).select("line_no", "line")


@query(
    "report_line_numbers",
    """SELECT CAST(c_nationkey AS VARCHAR) AS nation, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS line_no,
         c_custkey || ' ' || c_name AS line FROM customer""",
)
def report_line_numbers(spark, sf_dir):
    """Numbered lines of one file per nation; the files grow with the table and are read by byte ranges."""
    path = scratch_path(spark, "reports")
    line = F.concat_ws(" ", F.col("c_custkey").cast("string"), "c_name").alias("value")
    files = table(spark, sf_dir, "customer").repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey")
    files.select("c_nationkey", line).write.partitionBy("c_nationkey").text(path)
    nation = F.regexp_extract("path", "c_nationkey=([^/]*)", 1).alias("nation")
    return splits.numbered_lines(spark, f"{path}/*").select(nation, "line_no", "line")


@query(
    "column_labels",
    """SELECT v.variable, v.label, v.display_format, CASE v.variable WHEN 'c_mktsegment' THEN a WHEN 'c_custkey' THEN b ELSE c END AS n_filled
       FROM (SELECT COUNT(c_mktsegment) AS a, COUNT(c_custkey) AS b, COUNT(c_acctbal) AS c FROM customer),
         (VALUES ('c_mktsegment', 'Market segment', NULL), ('c_custkey', 'Customer key', NULL), ('c_acctbal', 'Balance', '8.2')) v(variable, label, display_format)""",
)
def column_labels(spark, sf_dir):
    """Labels and formats that a specification attached, with the filled cells of each column."""
    c = spec.conform(table(spark, sf_dir, "customer"), CUSTOMER_SPEC)
    held = compare.schema_frame(spark, {"customer": c}).select(F.col("name").alias("variable"), "label", "display_format")
    return held.join(compare.filled_cells(c), "variable")


@query("sorted_position", "SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS row_no FROM customer")
def sorted_position(spark, sf_dir):
    """Position of each row after the specification's sort."""
    placed = spec.conform(table(spark, sf_dir, "customer"), CUSTOMER_SPEC)
    return picks.number_rows(placed, CUSTOMER_SPEC.keys, unique=True).select("c_custkey", "row_no")


@query(
    "tied_position",
    """SELECT event_type, CAST(floor(value) AS BIGINT) AS v, COUNT(*) AS n, MIN(p) AS first_no, MAX(p) AS last_no
       FROM (SELECT event_type, value, row_number() OVER (ORDER BY event_type DESC, CASE WHEN CAST(floor(value) AS BIGINT) % 7 > 0 THEN CAST(floor(value) AS BIGINT) END NULLS LAST, CAST(floor(value) AS BIGINT)) AS p FROM events)
       GROUP BY 1, 2""",
)
def tied_position(spark, sf_dir):
    """The span of positions of rows that tie, in an order down and up with missing values last."""
    v = F.floor("value")
    e = table(spark, sf_dir, "events").select("event_id", "event_type", v.alias("v"), F.when(v % 7 > 0, v).alias("w"))
    placed = picks.number_rows(e, ["-event_type", "w", "v"])
    return placed.groupBy("event_type", "v").agg(F.count("*").alias("n"), F.min("row_no").alias("first_no"), F.max("row_no").alias("last_no"))


@query(
    "pad_row",
    """WITH c AS (SELECT o_orderpriority AS label, COUNT(*) AS n, row_number() OVER (ORDER BY o_orderpriority) AS ord FROM orders GROUP BY 1)
       SELECT label, n, ord FROM c UNION ALL SELECT '', NULL, MAX(ord) + 1 FROM c""",
)
def pad_row(spark, sf_dir):
    """A blank row after the rows of a report table."""
    counts = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("label")).agg(F.count("*").alias("n"))
    numbered = picks.number_rows(counts, ["label"], "ord").select("label", "n", "ord")
    return summary.pad_rows(numbered, 1, "ord")


@query(
    "pivot_roundtrip",
    """SELECT user_id AS usubjid, event_type AS name, CAST(COUNT(*) AS BIGINT) AS value FROM events GROUP BY 1, 2
       UNION ALL SELECT u, t, 0 FROM (SELECT DISTINCT user_id AS u FROM events), (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view')) l(t)
       WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = u AND event_type = t)""",
)
def pivot_roundtrip(spark, sf_dir):
    """Counts spread to one column per event type and gathered again, gaps filled."""
    from subjectflow.plans.analogs import PARAMS

    counts = raw_results(spark, sf_dir).groupBy("usubjid", "paramcd").agg(F.count("*").alias("n"))
    wide = summary.pivot_wide(counts, ["usubjid"], "paramcd", PARAMS, "n", fill=0)
    return summary.pivot_long(wide, ["usubjid"], PARAMS)


@query(
    "single_characteristic",
    "SELECT user_id AS usubjid, MAX(value) AS level FROM events WHERE event_type = 'view' GROUP BY 1",
)
def single_characteristic(spark, sf_dir):
    """One characteristic per subject out of a test table."""
    return subject.characteristic(raw_results(spark, sf_dir), ["usubjid"], "paramcd", "view", "aval", "level")


@query(
    "pooled_sites_fixed",
    with_views("subject", """
      SELECT usubjid, CASE WHEN siteid IN (3, 7, 11) THEN '900' ELSE CAST(siteid AS VARCHAR) END AS sitegr1 FROM subject"""),
)
def pooled_sites_fixed(spark, sf_dir):
    """Sites of a fixed list go to one group."""
    s = subjects(spark, sf_dir)
    return s.select("usubjid", subject.site_group(F.col("siteid").cast("string"), ["3", "7", "11"]).alias("sitegr1"))


@query(
    "text_result",
    """SELECT event_id AS seq, CASE WHEN value > 20 THEN value END AS aval, CASE WHEN value > 20 THEN 'n' || CAST(floor(value) AS BIGINT) END AS avalc FROM events""",
)
def text_result(spark, sf_dir):
    """The text form of a result, only where there is a number."""
    r = raw_results(spark, sf_dir).select("seq", F.when(F.col("aval") > 20, F.col("aval")).alias("aval"), F.concat(F.lit("n"), F.floor("aval").cast("string")).alias("text"))
    return r.select("seq", "aval", longitudinal.text_result("aval", "text").alias("avalc"))


@query(
    "censor_date",
    with_views("exposure", """
      SELECT seq, CASE WHEN status = 'P' THEN exstdt WHEN status <> 'P' THEN exendt END AS eos2dt FROM exposure"""),
)
def censor_date(spark, sf_dir):
    """The date a subject leaves: of one reason the start, of any other the end."""
    ex = exposure(spark, sf_dir)
    return ex.select("seq", survival.censor_date("status", F.col("exstdt"), F.col("exendt"), "P").alias("eos2dt"))

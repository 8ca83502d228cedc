"""The given tables seen as subject data: Spark frames and the matching SQL views.

Subjects come from ``customer``, exposure from ``orders``, long results and
occurrences from ``events``. Every frame is a lazy projection of a whole table.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subjectflow.functions.dates import study_day
from subjectflow.operators.longitudinal import baseline_record
from subjectflow.operators.merges import merge_vars
from subjectflow.operators.ranges import visit_of_day, windows

ARMS = ["Placebo", "Low Dose", "High Dose"]
ARM_NUMBERS = {"Placebo": 0, "Low Dose": 54, "High Dose": 81}
SEGMENT_ARM = {
    "BUILDING": "Placebo", "AUTOMOBILE": "Low Dose", "MACHINERY": "High Dose", "FURNITURE": "Screen Failure",
}
SEGMENT_CODE = {"BUILDING": "Pbo", "AUTOMOBILE": "Lo", "MACHINERY": "Hi", "HOUSEHOLD": "", "FURNITURE": "Scrnfail"}
WINDOWS = windows([
    ("Baseline", 0, "<=1", None, 1, 1),
    ("Week 1", 1, "2-8", 2, 8, 5),
    ("Week 2", 2, "9-15", 9, 15, 12),
    ("Week 3", 3, ">15", 16, None, 20),
])
EXPECTED_VISITS = [(0, "Baseline"), (1, "Week 1"), (2, "Week 2"), (3, "Week 3")]
PARAMS = ["click", "error", "purchase", "signup", "view"]


_opened = threading.local()


def forget_tables() -> None:
    """Start a new query: tables opened for the last one are dropped."""
    _opened.tables = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; within one query it is listed and its schema read only once."""
    tables = getattr(_opened, "tables", None)
    if tables is None:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    path = f"{sf_dir}/{name}.parquet"
    if path not in tables:
        tables[path] = spark.read.parquet(path)
    return tables[path]


def _mapped(column: str, pairs: dict):
    chain = F
    for key, value in pairs.items():
        chain = chain.when(F.col(column) == key, F.lit(value))
    return chain.otherwise(F.lit(None))


def subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    arm = _mapped("c_mktsegment", SEGMENT_ARM)
    return c.select(
        F.col("c_custkey").alias("usubjid"),
        F.col("c_nationkey").alias("siteid"),
        arm.alias("arm"),
        _mapped("c_mktsegment", SEGMENT_CODE).alias("armcd"),
        F.when(arm == "Placebo", 0).when(arm == "Low Dose", 54).when(arm == "High Dose", 81).alias("armn"),
        (F.lit(50) + F.col("c_custkey") % 40).cast("int").alias("age"),
        F.col("c_acctbal").alias("measure"),
        F.col("c_name").alias("name"),
    )


def exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    start = F.col("o_orderdate").cast("date")
    return o.select(
        F.col("o_custkey").alias("usubjid"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderpriority").alias("trt"),
        F.col("o_totalprice").alias("dose"),
        start.alias("exstdt"),
        F.when(F.col("o_orderkey") % 7 != 0, F.date_add(start, (F.col("o_orderkey") % 30).cast("int"))).alias("exendt"),
        F.col("o_orderstatus").alias("status"),
    )


def raw_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("usubjid"),
        F.col("event_type").alias("paramcd"),
        F.col("value").alias("aval"),
        F.col("ts").cast("date").alias("adt"),
        F.col("event_id").alias("seq"),
        F.col("props"),
        F.col("ts"),
    )


def reference_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First sign-up date per subject."""
    rows = raw_results(spark, sf_dir).filter("paramcd = 'signup'")
    return rows.groupBy("usubjid").agg(F.min("adt").alias("trtsdt"))


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long results with the study day; one row per event."""
    rows = raw_results(spark, sf_dir).drop("props", "ts")
    dated = merge_vars(rows, reference_dates(spark, sf_dir), ["usubjid"], ["trtsdt"], unique=True)
    return dated.withColumn("ady", study_day("adt", "trtsdt")).withColumns({"lo": F.lit(10.0), "hi": F.lit(100.0)})


def windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results with their analysis visit (AVISIT, AVISITN and window attributes)."""
    return visit_of_day(results(spark, sf_dir), WINDOWS, "ady")


def baselined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windowed results; the last baseline record is flagged and its value is on all rows."""
    return baseline_record(
        windowed(spark, sf_dir), ["usubjid", "paramcd"], ["adt"], ["seq"], {"base": "aval"}, "ablfl",
        where=F.col("AVISITN") == 0,
    )


def occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_results(spark, sf_dir)
    k = F.get_json_object("props", "$.k").cast("int")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    cut = F.when(F.col("seq") % 10 == 1, F.substring(iso, 1, 4)).when(F.col("seq") % 10 == 0, F.substring(iso, 1, 7)).otherwise(iso)
    return rows.select(
        "usubjid",
        F.col("seq").alias("aeseq"),
        F.col("paramcd").alias("class"),
        F.concat("paramcd", F.lit("_"), (k % 5).cast("string")).alias("term"),
        F.when(F.col("aval") > 100, "Y").otherwise("N").alias("serious"),
        cut.alias("startdtc"),
        F.col("adt"),
        F.col("aval"),
    )


def steady(c):
    """Six decimals for comparison with SQL; the offset keeps exact ties from falling
    either way with the order of a floating-point sum."""
    return F.round((F.col(c) if isinstance(c, str) else c) + F.lit(3e-10), 6)


# --------------------------------------------------------------- the same in SQL
_VIEWS = {
    "subject": (
        [],
        """SELECT c_custkey AS usubjid, c_nationkey AS siteid,
             CASE c_mktsegment WHEN 'BUILDING' THEN 'Placebo' WHEN 'AUTOMOBILE' THEN 'Low Dose'
               WHEN 'MACHINERY' THEN 'High Dose' WHEN 'FURNITURE' THEN 'Screen Failure' END AS arm,
             CASE c_mktsegment WHEN 'BUILDING' THEN 'Pbo' WHEN 'AUTOMOBILE' THEN 'Lo' WHEN 'MACHINERY' THEN 'Hi'
               WHEN 'HOUSEHOLD' THEN '' WHEN 'FURNITURE' THEN 'Scrnfail' END AS armcd,
             CASE c_mktsegment WHEN 'BUILDING' THEN 0 WHEN 'AUTOMOBILE' THEN 54 WHEN 'MACHINERY' THEN 81 END AS armn,
             CAST(50 + c_custkey % 40 AS INTEGER) AS age, c_acctbal AS measure, c_name AS name
           FROM customer""",
    ),
    "exposure": (
        [],
        """SELECT o_custkey AS usubjid, o_orderkey AS seq, o_orderpriority AS trt, o_totalprice AS dose,
             CAST(o_orderdate AS DATE) AS exstdt,
             CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER) END AS exendt,
             o_orderstatus AS status
           FROM orders""",
    ),
    "trtref": (
        [],
        "SELECT user_id AS usubjid, MIN(CAST(ts AS DATE)) AS trtsdt FROM events WHERE event_type = 'signup' GROUP BY 1",
    ),
    "results": (
        ["trtref"],
        """SELECT e.user_id AS usubjid, e.event_type AS paramcd, e.value AS aval, CAST(e.ts AS DATE) AS adt,
             e.event_id AS seq, r.trtsdt, CAST(CAST(e.ts AS DATE) - r.trtsdt
               + CASE WHEN CAST(e.ts AS DATE) >= r.trtsdt THEN 1 ELSE 0 END AS INTEGER) AS ady,
             CAST(10 AS DOUBLE) AS lo, CAST(100 AS DOUBLE) AS hi
           FROM events e LEFT JOIN trtref r ON e.user_id = r.usubjid""",
    ),
    "windowed": (
        ["results"],
        """SELECT *, CASE WHEN ady <= 1 THEN 'Baseline' WHEN ady BETWEEN 2 AND 8 THEN 'Week 1'
               WHEN ady BETWEEN 9 AND 15 THEN 'Week 2' WHEN ady >= 16 THEN 'Week 3' END AS avisit,
             CASE WHEN ady <= 1 THEN 0 WHEN ady BETWEEN 2 AND 8 THEN 1 WHEN ady BETWEEN 9 AND 15 THEN 2
               WHEN ady >= 16 THEN 3 END AS avisitn,
             CASE WHEN ady <= 1 THEN 1 WHEN ady BETWEEN 2 AND 8 THEN 5 WHEN ady BETWEEN 9 AND 15 THEN 12
               WHEN ady >= 16 THEN 20 END AS awtarget
           FROM results""",
    ),
    "baselined": (
        ["windowed"],
        """SELECT *, CASE WHEN avisitn = 0 AND ROW_NUMBER() OVER (PARTITION BY usubjid, paramcd, avisitn
               ORDER BY adt DESC, seq DESC) = 1 THEN 'Y' END AS ablfl
           FROM windowed""",
    ),
    "based": (
        ["baselined"],
        """SELECT *, MAX(CASE WHEN ablfl = 'Y' THEN aval END) OVER (PARTITION BY usubjid, paramcd) AS base
           FROM baselined""",
    ),
    "occurrence": (
        [],
        """SELECT user_id AS usubjid, event_id AS aeseq, event_type AS class,
             event_type || '_' || CAST(CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 5 AS VARCHAR) AS term,
             CASE WHEN value > 100 THEN 'Y' ELSE 'N' END AS serious,
             CASE WHEN event_id % 10 = 1 THEN substr(strftime(ts, '%Y-%m-%dT%H:%M:%S'), 1, 4)
               WHEN event_id % 10 = 0 THEN substr(strftime(ts, '%Y-%m-%dT%H:%M:%S'), 1, 7)
               ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS startdtc,
             CAST(ts AS DATE) AS adt, value AS aval
           FROM events""",
    ),
}


def with_views(names: str, body: str) -> str:
    """``body`` preceded by the named views and whatever they rest on."""
    done: list[str] = []

    def add(name: str) -> None:
        for needed in _VIEWS[name][0]:
            add(needed)
        if name not in done:
            done.append(name)

    for name in names.split():
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({_VIEWS[n][1]})" for n in done) + ("" if body.lstrip().startswith(",") else "\n") + body

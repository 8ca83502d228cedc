"""Cleaning, formatting, metadata, comparison and file-format queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from subjectflow.functions import cells, formats
from subjectflow.operators import compare, rules, spec
from subjectflow.plans.analogs import table
from subjectflow.plans.registry import query
from subjectflow.session import scratch_path
from subjectflow.sources import dataset_json, tables


# ------------------------------------------------------------------- cells and text
@query(
    "blank_na",
    """SELECT doc_id, CASE WHEN lang = 'en' THEN NULL ELSE lang END AS lang_na, CASE WHEN lang = 'en' THEN '' ELSE lang END AS lang_blank,
         n_chars FROM documents""",
)
def blank_na(spark, sf_dir):
    """Blank to null and null to blank over all text columns."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("lang") != "en", F.col("lang")).otherwise("").alias("lang_na"), "n_chars")
    nulls = cells.blanks_to_null(d)
    # the second step sees text columns only, so the first result travels beside it in a struct
    both = nulls.select("doc_id", F.col("lang_na").alias("lang_blank"), "n_chars", F.struct("lang_na").alias("_kept"))
    return cells.nulls_to_blank(both).select("doc_id", "_kept.lang_na", "lang_blank", "n_chars")


@query(
    "rounding",
    """SELECT p_partkey, p_size / 2.0 AS x, floor(p_size / 2.0 + 0.5) AS half_up, -floor(p_size / 2.0 + 0.5) AS half_up_negative,
         CASE WHEN p_size % 2 = 0 THEN p_size / 2.0 WHEN (p_size // 2) % 2 = 0 THEN p_size // 2 ELSE p_size // 2 + 1 END AS half_even,
         CASE WHEN p_size % 2 = 0 THEN p_size * 2.5 WHEN floor(p_size * 2.5) % 2 = 0 THEN floor(p_size * 2.5)
           ELSE floor(p_size * 2.5) + 1 END / CAST(10 AS DOUBLE) AS half_even1,
         p_size * CAST(1e18 AS DOUBLE) AS half_up_large, -p_size * CAST(1e18 AS DOUBLE) AS half_up_large_negative
       FROM part""",
)
def rounding(spark, sf_dir):
    """Half-up and half-even rounding of halves, of quarters at one digit, and of values beyond whole numbers."""
    p = table(spark, sf_dir, "part")
    x = F.col("p_size") / F.lit(2.0)
    return p.select(
        "p_partkey", x.alias("x"), cells.round_half_up(x).alias("half_up"), cells.round_half_up(-x).alias("half_up_negative"),
        cells.round_half_even(x).alias("half_even"),
        cells.round_half_even(F.col("p_size") / F.lit(4.0), 1).alias("half_even1"),
        cells.round_half_up(F.col("p_size") * F.lit(1e18), 2).alias("half_up_large"),
        cells.round_half_up(-F.col("p_size") * F.lit(1e18), 2).alias("half_up_large_negative"),
    )


@query(
    "title_case",
    """SELECT p_partkey, array_to_string(list_transform(
           regexp_extract_all(lower(p_type || '-' || p_brand || '(' || p_size || ') ' || p_name), '[a-z0-9]+|[^a-z0-9]+'),
           lambda w: upper(w[1]) || w[2:]), '') AS param FROM part""",
)
def title_case(spark, sf_dir):
    """Title case with word breaks at dashes, brackets and blanks."""
    p = table(spark, sf_dir, "part")
    text = F.concat("p_type", F.lit("-"), "p_brand", F.lit("("), F.col("p_size").cast("string"), F.lit(") "), "p_name")
    return p.select("p_partkey", cells.title_case(text).alias("param"))


@query(
    "format_stats",
    """WITH s AS (SELECT p_brand, COUNT(*) AS n, AVG(p_retailprice) + 0.00001 AS mean, STDDEV_SAMP(p_retailprice) AS sd,
         MIN(p_size) AS lo, MAX(p_size) AS hi, COUNT(*) / 4000.0 + 0.0000001 AS p FROM part GROUP BY 1)
       SELECT p_brand, printf('%6.2f', mean) AS num, printf('%5.1f (%5.2f)', mean, sd) AS est,
         printf('%5.2f (%5.2f,%5.2f)', mean, mean - sd, mean + sd) AS ci,
         CASE WHEN p < 0.001 THEN '<0.001' ELSE printf('%7.3f', p) END AS pval,
         rpad(printf('%8.3f', p), 12, ' ') AS padded, printf('%3.0f (%3.0f;%3.0f)', CAST(n AS DOUBLE), CAST(lo AS DOUBLE), CAST(hi AS DOUBLE)) AS masked
       FROM s""",
)
def format_stats(spark, sf_dir):
    """Fixed-width number, estimate, interval, p-value and mask formats."""
    s = table(spark, sf_dir, "part").groupBy("p_brand").agg(
        F.count("*").alias("n"), (F.avg("p_retailprice") + 0.00001).alias("mean"), F.stddev_samp("p_retailprice").alias("sd"),
        F.min("p_size").alias("lo"), F.max("p_size").alias("hi"), (F.count("*") / 4000.0 + 0.0000001).alias("p"),
    ).withColumns({"lower": F.col("mean") - F.col("sd"), "upper": F.col("mean") + F.col("sd")})
    return s.select(
        "p_brand", formats.fmt_num("mean", 2).alias("num"), formats.fmt_est("mean", "sd").alias("est"),
        formats.fmt_ci("mean", "lower", "upper").alias("ci"), formats.fmt_pval("p").alias("pval"),
        formats.num_fmt("p", 3, 12, 4).alias("padded"), formats.masked("xxx (xxx;xxx)", "n", "lo", "hi").alias("masked"),
    )


@query(
    "visitnum_clean",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber % 2 = 0 THEN l_linenumber + 0.5
         ELSE CAST(l_linenumber AS DOUBLE) + 0.25 END AS visitnum FROM lineitem""",
)
def visitnum_clean(spark, sf_dir):
    """Numbers printing three or more decimals lose their stray digits; others stay."""
    li = table(spark, sf_dir, "lineitem")
    noisy = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_linenumber") + 0.5000000001).otherwise(F.col("l_linenumber") + 0.25)
    return li.select("l_orderkey", "l_linenumber", "l_partkey", cells.clean_precision(noisy).alias("visitnum"))


# ------------------------------------------------------------------- specification
_CATALOG = """WITH catalog AS (SELECT p_brand AS dataset, 'V' || p_partkey || CASE WHEN p_size % 3 = 0 THEN 'DTC' WHEN p_size % 3 = 1 THEN 'DT' ELSE '' END AS variable,
         CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS INTEGER) END AS key_seq,
         CASE p_type WHEN 'ECONOMY' THEN 'integer' WHEN 'STANDARD' THEN 'float' ELSE 'text' END AS type,
         CASE p_size % 4 WHEN 0 THEN 8 WHEN 1 THEN 20 WHEN 2 THEN 200 END AS length, p_name AS label,
         CASE WHEN p_size % 7 = 0 THEN 'DATE9.' WHEN p_size % 7 = 1 THEN 'DATETIME20.' END AS format FROM part)"""


def catalog(spark, sf_dir):
    """A variable catalogue with one entry per part."""
    size = F.col("p_size")
    suffix = F.when(size % 3 == 0, "DTC").when(size % 3 == 1, "DT").otherwise("")
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("dataset"),
        F.concat(F.lit("V"), F.col("p_partkey").cast("string"), suffix).alias("variable"),
        F.when(size % 2 == 0, size).alias("key_seq"),
        F.when(F.col("p_type") == "ECONOMY", "integer").when(F.col("p_type") == "STANDARD", "float").otherwise("text").alias("type"),
        F.when(size % 4 == 0, 8).when(size % 4 == 1, 20).when(size % 4 == 2, 200).alias("length"),
        F.col("p_name").alias("label"),
        F.when(size % 7 == 0, "DATE9.").when(size % 7 == 1, "DATETIME20.").alias("format"),
    )


@query(
    "column_descriptors",
    _CATALOG + """, d AS (SELECT 'IT.' || dataset || '.' || variable AS "itemOID", variable AS name, label,
         CASE WHEN format = 'DATE9.' THEN 'date' WHEN format = 'DATETIME20.' THEN 'datetime' WHEN variable LIKE '%DTC' AND length = 8 THEN 'date'
           WHEN variable LIKE '%DTC' AND length = 20 THEN 'datetime' WHEN type = 'text' THEN 'string' ELSE type END AS "dataType",
         length AS l, key_seq AS "keySequence", format AS "displayFormat" FROM catalog)
       SELECT "itemOID", name, label, "dataType", CASE WHEN "dataType" = 'string' THEN l END AS length, "keySequence", "displayFormat",
         CASE WHEN "displayFormat" IN ('DATE9.', 'DATETIME20.') THEN 'integer' END AS "targetDataType" FROM d""",
)
def column_descriptors(spark, sf_dir):
    """Column descriptors of every dataset of a variable catalogue."""
    c = catalog(spark, sf_dir)
    return spec.column_descriptors(c.select("dataset", "variable", "key_seq"), c.select("variable", "type", "length", "label", "format"))


@query(
    "column_profile",
    """WITH l AS (SELECT max(length(c_name)) AS a, max(length(c_mktsegment)) AS b FROM customer)
       SELECT position, name, data_type, CAST(CASE name WHEN 'c_name' THEN a WHEN 'c_mktsegment' THEN b END AS INTEGER) AS length
       FROM l, (VALUES (1, 'c_custkey', 'integer'), (2, 'c_name', 'string'), (3, 'c_nationkey', 'integer'), (4, 'c_acctbal', 'float'),
         (5, 'c_mktsegment', 'string')) v(position, name, data_type)""",
)
def column_profile(spark, sf_dir):
    """Data type and longest text of every column, in one pass."""
    return spec.profile_columns(table(spark, sf_dir, "customer")).select("position", "name", "data_type", "length")


CUSTOMER_SPEC = spec.TableSpec(
    "CUST", "Customers",
    (
        spec.ColumnSpec("c_mktsegment", label="Market segment", length=10, codelist=("BUILDING", "AUTOMOBILE", "MACHINERY")),
        spec.ColumnSpec("c_custkey", "integer", label="Customer key", key=1),
        spec.ColumnSpec("c_acctbal", "float", label="Balance", format="8.2"),
        spec.ColumnSpec("absent", label="Not in the data"),
    ),
)


@query("conform", "SELECT COALESCE(NULLIF(c_mktsegment, 'BUILDING'), '') AS c_mktsegment, c_custkey, c_acctbal FROM customer")
def conform(spark, sf_dir):
    """Columns of the specification only, in its order, labelled, nulls to blank."""
    c = table(spark, sf_dir, "customer").withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return spec.conform(c, CUSTOMER_SPEC)


@query(
    "codelist_check",
    """SELECT 'c_mktsegment' AS variable, c_mktsegment AS value, COUNT(*) AS n_rows FROM customer
       WHERE c_mktsegment NOT IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY') GROUP BY 2""",
)
def codelist_check(spark, sf_dir):
    """Values outside the controlled terms, with counts."""
    return spec.codelist_check(table(spark, sf_dir, "customer"), CUSTOMER_SPEC)


@query(
    "codelist_offenders",
    """SELECT 'n_name' AS variable, 'NATION_' || s_nationkey AS value, COUNT(*) AS n_rows FROM supplier
       WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3) GROUP BY 2""",
)
def codelist_offenders(spark, sf_dir):
    """Values missing from a codelist table."""
    s = table(spark, sf_dir, "supplier").select(F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string")).alias("n_name"))
    allowed = table(spark, sf_dir, "nation").filter("n_regionkey < 3").select(F.col("n_name").alias("code"))
    return compare.codelist_offenders(s, "n_name", allowed)


@query(
    "conformance_rules",
    _CATALOG + """, f AS (SELECT dataset, unnest([CASE WHEN label LIKE 'red%' THEN 'AD0018' END,
           CASE WHEN variable LIKE '%DT' AND format IS NULL THEN 'AD0041A' END, CASE WHEN type = 'float' THEN 'SD0059' END]) AS rule FROM catalog
         UNION ALL SELECT DISTINCT dataset, 'AD0320' FROM catalog WHERE dataset LIKE '%1')
       SELECT rule, dataset, COUNT(*) AS n FROM f WHERE rule IS NOT NULL GROUP BY 1, 2""",
)
def conformance_rules(spark, sf_dir):
    """Conformance rule violations per rule and dataset of a variable catalogue."""
    c = catalog(spark, sf_dir)
    columns = c.select("dataset", F.col("variable").alias("name"), "type", "label", F.col("format").alias("display_format"))
    standard = c.select(
        F.col("variable").alias("name"),
        F.when(F.col("label").startswith("red"), "Standard label").otherwise(F.col("label")).alias("label"),
        F.when(F.col("type") == "float", "integer").otherwise(F.col("type")).alias("type"),
    )
    datasets = c.select("dataset").distinct().select(
        "dataset", F.lit("Label").alias("label"), F.when(F.col("dataset").endswith("1"), "Other").otherwise("Label").alias("standard_label")
    )
    return compare.conformance(columns, standard, datasets)


#: Rules as rows: id, table, test, message.
_RULES = [
    ("OR01", "orders", "o_orderstatus <> 'F' OR o_orderpriority <> '1-URGENT'", "urgent orders are not final"),
    ("OR02", "orders", "o_totalprice < 100000 OR o_custkey % 2 = 0", "large orders come from even customers"),
    ("OR03", "orders", "o_orderkey IS NOT NULL", "orders have a key"),
    ("LI01", "lineitem", "l_extendedprice >= 100 * l_quantity", "lines have a least price"),
    ("LI02", "lineitem", "l_returnflag <> 'R' OR l_discount <= l_tax", "returned lines have no discount above their tax"),
    ("CU01", "customer", "c_acctbal > 0 OR c_mktsegment IN ('BUILDING', 'MACHINERY')", "balances below zero are for some segments"),
]


@query(
    "rule_table",
    " UNION ALL ".join(
        f"SELECT '{i}' AS rule, '{t}' AS dataset, '{m}' AS message, COUNT(*) FILTER (NOT ({x})) AS n FROM {t}" for i, t, x, m in _RULES
    ),
)
def rule_table(spark, sf_dir):
    """Cross-column rules from a table of rules, all tables read once each."""
    given = rules.rules_of(spark.createDataFrame(_RULES, "id string, scope string, test string, message string"))
    return rules.check_rules({t: table(spark, sf_dir, t) for t in ("orders", "lineitem", "customer")}, given, clean=True)


@query(
    "rule_violations",
    " UNION ALL ".join(f"SELECT '{i}' AS rule, '{m}' AS message, o_orderkey FROM orders WHERE NOT ({x})" for i, t, x, m in _RULES if t == "orders"),
)
def rule_violations(spark, sf_dir):
    """Each order with the rules that it violates."""
    mine = [rules.Rule(*r) for r in _RULES if r[1] == "orders"]
    return rules.violations(table(spark, sf_dir, "orders"), mine, ["o_orderkey"])


@query(
    "variable_labels",
    """WITH wanted AS (SELECT DISTINCT CASE p_size % 5 WHEN 0 THEN 'c_custkey' WHEN 1 THEN 'o_orderkey' WHEN 2 THEN 'c_name'
           WHEN 3 THEN 'o_totalprice' ELSE 'unknown' END AS variable, p_brand AS dataset FROM part)
       SELECT variable, dataset, CASE variable WHEN 'c_custkey' THEN 'Customer key' WHEN 'o_orderkey' THEN 'Order key' WHEN 'c_name' THEN 'Name' END AS label
       FROM wanted""",
)
def variable_labels(spark, sf_dir):
    """Labels of a (variable, dataset) list taken from all tables' schemas."""
    labels = {"c_custkey": "Customer key", "c_name": "Name", "o_orderkey": "Order key"}
    sources = {}
    for name in ("customer", "orders"):
        df = table(spark, sf_dir, name)
        sources[name] = df.select(*[F.col(c).alias(c, metadata={"label": labels[c]} if c in labels else {}) for c in df.columns])
    names = ["c_custkey", "o_orderkey", "c_name", "o_totalprice", "unknown"]
    pick = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("p_size") % 5 + 1).cast("int"))
    wanted = table(spark, sf_dir, "part").select(pick.alias("variable"), F.col("p_brand").alias("dataset")).distinct()
    return compare.variable_labels(wanted, sources)


# ------------------------------------------------------------------- comparison
def _copies(spark, sf_dir):
    """Customers and a deterministically changed copy."""
    c = table(spark, sf_dir, "customer")
    changed = c.filter("c_nationkey <> 3").withColumns({
        "c_acctbal": F.when(F.col("c_nationkey") == 5, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")),
        "c_mktsegment": F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_mktsegment")),
    })
    extra = c.filter("c_nationkey = 7").withColumn("c_custkey", -F.col("c_custkey") - 1)
    return c, changed.unionByName(extra)


_COPY_SQL = """WITH changed AS (SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_nationkey = 5 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_nationkey <> 3
         UNION ALL SELECT -c_custkey - 1, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_nationkey = 7),
       diffs AS (SELECT b.c_custkey, 'c_acctbal' AS variable FROM customer b JOIN changed c ON b.c_custkey = c.c_custkey WHERE b.c_acctbal <> c.c_acctbal
         UNION ALL SELECT b.c_custkey, 'c_mktsegment' FROM customer b JOIN changed c ON b.c_custkey = c.c_custkey
           WHERE b.c_mktsegment IS DISTINCT FROM c.c_mktsegment)"""


@query(
    "dataset_compare",
    _COPY_SQL + """SELECT 'variable' AS part, variable AS item, COUNT(*) AS n FROM diffs GROUP BY 2
       UNION ALL SELECT 'rows', 'only in base', COUNT(*) FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM changed)
       UNION ALL SELECT 'rows', 'only in compare', COUNT(*) FROM changed WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)
       UNION ALL SELECT 'status', 'fail', COUNT(*) FROM diffs""",
)
def dataset_compare(spark, sf_dir):
    """Keyed comparison of a table and a changed copy: counts per variable, lone rows, status."""
    base, changed = _copies(spark, sf_dir)
    found = compare.compare_datasets(base, changed, ["c_custkey"]).found
    # every kind of finding counts itself, and a differing cell also counts for the status; zeros are always there
    kinds = {"BASE": "only in base", "COMPARE": "only in compare"}
    rows = F.array_compact(F.array(
        *[F.when(F.col("side") == side, F.struct(F.lit("rows").alias("part"), F.lit(item).alias("item"))) for side, item in kinds.items()],
        F.when(F.col("side") == "DIFF", F.struct(F.lit("variable").alias("part"), F.col("variable").alias("item"))),
        F.when(F.col("side") == "DIFF", F.struct(F.lit("status").alias("part"), F.lit(None).cast("string").alias("item"))),
    ))
    counted = found.select(F.explode(rows).alias("_e"), F.lit(1).alias("_n")).select("_e.*", "_n")
    zeros = spark.createDataFrame([("rows", item, 0) for item in kinds.values()] + [("status", None, 0)], "part string, item string, _n int")
    out = counted.unionByName(zeros).groupBy("part", "item").agg(F.sum("_n").alias("n"))
    status = F.when(F.col("n") > 0, "fail").otherwise("pass")
    return out.select("part", F.when(F.col("part") == "status", status).otherwise(F.col("item")).alias("item"), "n")


@query("dataset_differences", _COPY_SQL + "SELECT c_custkey, variable FROM diffs")
def dataset_differences(spark, sf_dir):
    """Every differing cell of the keyed comparison."""
    base, changed = _copies(spark, sf_dir)
    return compare.value_differences(base, changed, ["c_custkey"]).select("c_custkey", "variable")


@query(
    "position_compare",
    """WITH b AS (SELECT ROW_NUMBER() OVER (ORDER BY o_orderkey) AS row_no, o_totalprice, o_orderstatus FROM orders),
         c AS (SELECT ROW_NUMBER() OVER (ORDER BY o_orderkey) AS row_no, CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
           o_orderstatus FROM orders)
       SELECT b.row_no, 'o_totalprice' AS variable FROM b JOIN c USING (row_no) WHERE b.o_totalprice <> c.o_totalprice""",
)
def position_compare(spark, sf_dir):
    """Comparison by row position in a given order, for tables without keys."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    doubled = o.withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") * 2).otherwise(F.col("o_totalprice")))
    found = compare.compare_datasets(o, doubled, order=["o_orderkey"], unique=True)
    return found.differences.select("row_no", "variable")


@query(
    "schema_compare",
    """SELECT v.variable, v.attribute, v.base, v.compare, CASE v.variable WHEN 'c_name' THEN a WHEN 'c_nationkey' THEN b WHEN 'c_acctbal' THEN c END AS base_filled,
         CASE v.variable WHEN 'extra' THEN n WHEN 'c_nationkey' THEN b WHEN 'c_acctbal' THEN c END AS compare_filled
       FROM (SELECT COUNT(*) AS n, COUNT(c_name) AS a, COUNT(c_nationkey) AS b, COUNT(c_acctbal) AS c FROM customer),
         (VALUES ('c_name', 'column', 'present', NULL), ('c_nationkey', 'type', 'int', 'string'), ('c_acctbal', 'label', NULL, 'Balance'),
           ('extra', 'column', NULL, 'present')) v(variable, attribute, base, compare)""",
)
def schema_compare(spark, sf_dir):
    """Schema differences of a table and a changed copy, with the cells they affect."""
    c = table(spark, sf_dir, "customer")
    changed = c.select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("c_nationkey"), F.col("c_acctbal").alias("c_acctbal", metadata={"label": "Balance"}),
        "c_mktsegment", F.lit(1).alias("extra"),
    )
    base_filled = compare.filled_cells(c).withColumnRenamed("n_filled", "base_filled")
    compare_filled = compare.filled_cells(changed).withColumnRenamed("n_filled", "compare_filled")
    out = compare.compare_schemas(c, changed).join(base_filled, "variable", "left").join(compare_filled, "variable", "left")
    return out


_LINES_SQL = """WITH a AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents),
       b AS (SELECT doc_id, line_no, CASE WHEN line_no = 2 AND lang = 'de' THEN line || '!' ELSE line END AS line FROM
         (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents)
         WHERE NOT (lang = 'fr' AND line_no > 3))"""


@query(
    "text_diff",
    _LINES_SQL + """SELECT doc_id, CAST(COUNT(*) FILTER (a.line IS DISTINCT FROM b.line) AS BIGINT) AS n_differences,
         CASE WHEN COUNT(*) FILTER (a.line IS DISTINCT FROM b.line) <= 1 THEN 'pass' ELSE 'fail' END AS status
       FROM a FULL JOIN b USING (doc_id, line_no) GROUP BY doc_id""",
)
def text_diff(spark, sf_dir):
    """Line-by-line text comparison; one differing line passes."""
    d = table(spark, sf_dir, "documents")
    base = compare.text_lines(d, ["doc_id"])
    other = compare.text_lines(d, ["doc_id", "lang"]).filter(~((F.col("lang") == "fr") & (F.col("line_no") > 3)))
    line = F.when((F.col("line_no") == 2) & (F.col("lang") == "de"), F.concat("line", F.lit("!"))).otherwise(F.col("line"))
    other = other.withColumn("line", line).drop("lang")
    return compare.text_status(base, other, ["doc_id"])


@query(
    "parse_fenced_csv",
    """WITH r AS (SELECT conv_id, turn, unnest(['a' || turn, 'b' || conv_id]) AS variable, role AS dataset FROM conversations)
       SELECT conv_id, turn, variable, dataset FROM r""",
)
def parse_fenced_csv(spark, sf_dir):
    """Variable and dataset pairs out of fenced comma-separated answers."""
    c = table(spark, sf_dir, "conversations")
    head = F.when(F.col("turn") % 2 == 0, "Variable,Dataset\n").otherwise("")
    answer = F.concat(
        F.lit("```csv\n"), head, F.lit("a"), F.col("turn").cast("string"), F.lit(","), "role",
        F.lit("\nb"), F.col("conv_id").cast("string"), F.lit(","), "role", F.lit("\n```"),
    )
    return compare.parse_fenced_pairs(c.select("conv_id", "turn", answer.alias("text")), ["conv_id", "turn"])


# ------------------------------------------------------------------- file formats
@query(
    "dsjson_roundtrip",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, o_orderkey % 2 = 0 AS even,
         CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_orderdate AS DATE) END AS day, CAST(o_totalprice AS DECIMAL(18, 2)) AS exact FROM orders""",
)
def dsjson_roundtrip(spark, sf_dir):
    """Orders with integer, boolean, date, decimal and null cells, written as line-delimited Dataset-JSON and read back."""
    path = scratch_path(spark, "orders")
    o = table(spark, sf_dir, "orders").withColumns({
        "even": F.col("o_orderkey") % 2 == 0, "day": F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderdate").cast("date")),
        "exact": F.col("o_totalprice").cast("decimal(18,2)"),
    })
    dataset_json.write_dataset_ndjson(o, path, "orders", "Orders")
    back = dataset_json.read_dataset_ndjson(spark, path, decimals_as_floats=False)
    return back.withColumns({"o_totalprice": F.col("o_totalprice").cast("double"), "exact": F.col("exact").cast("decimal(18,2)")})


@query("dsjson_standard_file", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def dsjson_standard_file(spark, sf_dir):
    """A line-delimited file whose first line is the metadata: all parts of a written table taken as one."""
    path = scratch_path(spark, "supplier")
    dataset_json.write_dataset_ndjson(table(spark, sf_dir, "supplier"), path, "supplier", "Suppliers")
    return dataset_json.read_ndjson_file(spark, f"{path}/*")


@query("dsjson_classic", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def dsjson_classic(spark, sf_dir):
    """A classic Dataset-JSON object (one line, all cells text) read back. The format puts a table into one object."""
    key = F.col("n_nationkey").cast("string")
    key = F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit(" "), key)).when(F.col("n_nationkey") % 3 == 1, F.concat(key, F.lit(".0"))).otherwise(F.concat(key, F.lit("e0")))
    n = table(spark, sf_dir, "nation").select(F.array(key, "n_name", F.col("n_regionkey").cast("string")).alias("r"))
    column = lambda name, kind: F.struct(F.lit(f"IT.{name}").alias("itemOID"), F.lit(name).alias("name"), F.lit(name).alias("label"), F.lit(kind).alias("dataType"))
    columns = F.array(column("n_nationkey", "integer"), column("n_name", "string"), column("n_regionkey", "decimal"))
    whole = n.agg(F.to_json(F.struct(F.lit("1.1.0").alias("datasetJSONVersion"), columns.alias("columns"), F.collect_list("r").alias("rows"))).alias("value"))
    path = scratch_path(spark, "nation")
    whole.write.text(path)
    back = dataset_json.read_dataset_json(spark, path)
    return back.withColumns({"n_nationkey": F.col("n_nationkey").cast("int"), "n_regionkey": F.col("n_regionkey").cast("int")})


#: Rows of one classic object: whoever writes the format holds an object whole.
_OBJECT_ROWS = 50_000


@query("dsjson_classic_split", """SELECT o_orderkey, o_custkey, o_totalprice, '] ' || o_orderpriority || ' ["' AS note FROM orders""")
def dsjson_classic_split(spark, sf_dir):
    """Orders as classic Dataset-JSON objects, one per range of keys, read back by byte ranges of the files."""
    cells = F.array(
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".0")), F.col("o_custkey").cast("string"), F.col("o_totalprice").cast("string"),
        F.concat(F.lit("] "), "o_orderpriority", F.lit(' ["')),
    )
    kinds = {"o_orderkey": "integer", "o_custkey": "integer", "o_totalprice": "decimal", "note": "string"}
    columns = F.array(*[F.struct(F.lit(f"IT.{n}").alias("itemOID"), F.lit(n).alias("name"), F.lit(n).alias("label"), F.lit(k).alias("dataType")) for n, k in kinds.items()])
    rows = table(spark, sf_dir, "orders").select(F.floor(F.col("o_orderkey") / _OBJECT_ROWS).alias("part"), cells.alias("r"))
    whole = F.to_json(F.struct(F.lit("1.1.0").alias("datasetJSONVersion"), columns.alias("columns"), F.collect_list("r").alias("rows")))
    path = scratch_path(spark, "orders-classic")
    rows.groupBy("part").agg(whole.alias("value")).write.partitionBy("part").text(path)
    return dataset_json.read_dataset_json_split(spark, f"{path}/*")


_ALL = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


_CELL = """CASE typeof(COLUMNS('(.*)')) WHEN 'DOUBLE' THEN CAST(CAST(floor(TRY_CAST(CAST(COLUMNS('(.*)') AS VARCHAR) AS DOUBLE) * 1000) AS BIGINT) AS VARCHAR)
      WHEN 'TIMESTAMP' THEN strftime(TRY_CAST(CAST(COLUMNS('(.*)') AS VARCHAR) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f')
      WHEN 'FLOAT[]' THEN array_to_string(list_transform(TRY_CAST(CAST(COLUMNS('(.*)') AS VARCHAR) AS FLOAT[]), lambda x: CAST(floor(CAST(x AS DOUBLE) * 1000) AS BIGINT)), ',')
      ELSE CAST(COLUMNS('(.*)') AS VARCHAR) END"""


@query(
    "batch_convert",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS dataset, variable, n_filled, digest FROM (UNPIVOT (SELECT COUNT(COLUMNS('(.*)')) AS '\\1' FROM {t}) ON COLUMNS(*) INTO NAME variable VALUE n_filled)
          JOIN (UNPIVOT (SELECT CAST(coalesce(sum(CAST('0x' || md5({_CELL})[1:8] AS BIGINT)), 0) AS BIGINT) AS '\\1' FROM {t}) ON COLUMNS(*) INTO NAME variable VALUE digest) USING (variable)"""
        for t in _ALL
    ),
)
def batch_convert(spark, sf_dir):
    """All tables converted to line-delimited Dataset-JSON and read back: filled cells and a digest of every column."""
    target = scratch_path(spark, "batch")
    given = {n: table(spark, sf_dir, n) for n in _ALL}
    tables.convert_folder(spark, {**given, "extra.ts": given["part"]}, target)
    out = None
    for name, df in tables.load_tables(spark, target, given, "dataset-ndjson").items():
        lists = {f.name: F.from_json(f.name, f.dataType) for f in given[name].schema if f.dataType.typeName() == "array"}  # the format has no lists
        part = compare.cell_digests(df.withColumns(lists)).select(F.lit(name).alias("dataset"), "variable", "n_filled", "digest")
        out = part if out is None else out.unionByName(part)
    return out


@query("define_labels", "SELECT CAST(p_partkey AS VARCHAR) AS oid, p_name AS label FROM part")
def define_labels(spark, sf_dir):
    """Dataset names and labels out of a metadata XML file."""
    path = scratch_path(spark, "define")
    groups = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("_OID"), F.col("p_name").alias("_Label"))
    groups.write.format("xml").option("rootTag", "MetaDataVersion").option("rowTag", "ItemGroupDef").save(path)
    return tables.define_labels(spark, path)

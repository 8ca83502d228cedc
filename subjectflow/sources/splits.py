"""Large text files read split by split, with what came before a place in its file.

Spark's text reader cuts a file into byte ranges and gives every record to one of them. Each
record knows its file, the start of its range (``block``) and its order there (``at``); totals
per range, one row each, are added up along the file and carried into the ranges. So lines get
their numbers, and the pieces of one big JSON object their place in it, without any task that
sees the file whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subjectflow.operators.joins import lookup_join
from subjectflow.operators.scans import scan
from subjectflow.session import scratch_path


def records(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """``path``, ``file``, ``block``, ``at``, ``value``: the records between separators of text files."""
    return spark.read.option("lineSep", separator).text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value",
    )


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``path``, ``file``, ``line_no``, ``line`` of text files; a carriage return before the line feed is dropped.

    The number is the place in the range plus the lines of earlier ranges: a join with one row
    per range, no shuffle of the lines. An empty file has no line.
    """
    found = records(spark, path, "\n")
    ranges = found.groupBy("path", "block").agg(F.min("at").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("path", "block", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    number = F.col("_before") + F.col("at") - F.col("_first") + 1
    return lookup_join(found, ranges, ["path", "block"], "inner").select("path", "file", number.alias("line_no"), F.regexp_replace("value", r"\r$", "").alias("line"))


def _quotes(text: Column) -> Column:
    """Quotes that begin or end a string: those that no backslash escapes."""
    return F.length(F.regexp_replace(F.regexp_replace(text, r"(?s)\\.", ""), '[^"]', ""))


def _opened(text: Column) -> Column:
    """Opening brackets outside of strings; the text may end in the middle of a string."""
    plain = F.regexp_replace(F.regexp_replace(text, r"(?s)\\.", ""), r'(?s)"[^"]*("|$)', "")
    return F.length(F.regexp_replace(plain, r"[^\[]", ""))


def json_elements(spark: SparkSession, path: str) -> DataFrame:
    """The arrays of JSON objects in ``path``, one object per file: ``path``, ``n``, ``text``, ``depth``, ``outer``.

    Files are cut behind every ``]``, and whether that bracket closes an array or stands in a
    string, how deep it lies and how many outermost arrays were closed before are running sums
    over the pieces. An element is the text up to and with a closing bracket, ``n`` its place in
    the file, ``depth`` the arrays still open behind it and ``outer`` the number of the
    outermost array it belongs to. The result is written to the shared folder.
    """
    # a piece ends where a string may not: an escape never reaches over a bracket
    pieces = records(spark, path, "]").drop("file").withColumn("quotes", _quotes(F.col("value")) % 2)
    order, by = ["at"], ["path"]
    pieces = scan(pieces, by, "block", order, {"quoted": ("sum", F.col("quotes"))}, exclusive=True).withColumn("inside", F.col("quoted") % 2 == 1)
    seen = F.when(F.col("inside"), F.concat(F.lit('"'), "value")).otherwise(F.col("value"))
    closes = ((F.col("quoted") + F.col("quotes")) % 2 == 0).cast("long")
    pieces = pieces.withColumn("closes", closes).withColumn("delta", _opened(seen) - F.col("closes"))
    pieces = scan(pieces, by, "block", order, {"n": ("sum", F.col("closes")), "before": ("sum", F.col("delta"))}, exclusive=True)
    pieces = pieces.withColumn("depth", F.col("before") + F.col("delta"))
    ended = ((F.col("closes") == 1) & (F.col("depth") == 0)).cast("long")
    pieces = scan(pieces, by, "block", order, {"outer": ("sum", ended)}, exclusive=True)
    # a string that holds brackets comes in several pieces
    parts = F.array_sort(F.collect_list(F.struct("block", "at", "value")))
    elements = pieces.groupBy("path", "n").agg(parts.alias("_p"), F.max(F.struct("block", "at", "depth", "outer")).alias("_last"))
    text = F.concat(F.array_join(F.transform("_p", lambda p: p["value"]), "]"), F.lit("]"))
    out = elements.select("path", "n", text.alias("text"), F.col("_last.depth").alias("depth"), F.col("_last.outer").alias("outer"))
    target = scratch_path(spark, "json-elements")
    out.write.parquet(target)
    return spark.read.schema(out.schema).parquet(target)


def rows_of(elements: DataFrame, key: str) -> DataFrame:
    """``path``, ``n``, ``row`` (JSON text): the arrays within the outermost array under ``key``."""
    begins = rf'"{key}"\s*:\s*\['
    mine = elements.filter(F.col("text").rlike(begins)).groupBy("path").agg(F.min("outer").alias("outer"))
    inner = lookup_join(elements.filter("depth = 1"), mine, ["path", "outer"], "inner")
    first = F.regexp_extract("text", rf"(?s)^.*?{begins}\s*(\[.*)$", 1)
    row = F.when(F.col("text").rlike(begins), first).otherwise(F.regexp_replace("text", r"(?s)^[^\[]*", ""))
    return inner.select("path", "n", row.alias("row"))


def whole_array(elements: DataFrame, key: str) -> DataFrame:
    """``path``, ``array`` (JSON text): an outermost array that is known to be small, such as a file's metadata."""
    begins = rf'"{key}"\s*:\s*'
    mine = elements.filter(F.col("text").rlike(begins + r"\[")).groupBy("path").agg(F.min("outer").alias("outer"))
    parts = lookup_join(elements, mine, ["path", "outer"], "inner").groupBy("path").agg(F.array_sort(F.collect_list(F.struct("n", "text"))).alias("_p"))
    text = F.array_join(F.transform("_p", lambda p: p["text"]), "")
    return parts.select("path", F.regexp_extract(text, rf"(?s)^.*?{begins}(\[.*)$", 1).alias("array"))

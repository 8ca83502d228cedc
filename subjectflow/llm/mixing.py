"""Mixing sources to target weights: capped water-filling, then seeded repetitions.

Every source has a weight and may be used at most ``MAX_EPOCHS`` times. Its target is
``min(cap, level * weight)``; the level at which the targets fill the budget is found in
one ordered pass over the sources: what capped sources can't take is shared again by weight
until no target is above its cap.

A source's documents are taken ``floor(target / size)`` times whole, and a seeded part of
them once more. The part is cut by hash order (md5 of seed, id and text, a fixed shuffle): words
are first added up per hash bucket, which finds the bucket that the cut falls into; only
the documents of that bucket are ordered. One more document, whose size fits the gap best,
closes it. So no source is ever ordered as a whole, a source may hold any share of all
rows, reruns agree, and what is taken differs from the target by little.

A null text has size 0; null is a source of its own, the last one. A null id is an id like any
other; rows are told apart by id and text, so neither many null ids nor a repeated id fall
into one bucket. Rows that repeat both are ties: any of them may win, and as many are sampled as
the mix takes. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subjectflow.llm.common import WORD, fresh, stored

MAX_EPOCHS = 3
SEED = "mix"
#: Documents of a source per hash bucket, about.
PER_BUCKET = 256
#: Sources up to which their targets are sent to every executor; more are joined by a shuffle.
BROADCAST_SOURCES = 20_000


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``size`` (words of the whole text), ``mark`` (of id and text) and ``h`` (place in the seeded shuffle, below 2^32)."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size"), _mark().alias("mark")).withColumn("h", _place(F.col("mark")))


def _mark() -> Column:
    """md5 of seed, id and text."""
    text = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    return F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text).cast("binary"))


def _place(mark: Column) -> Column:
    """Place of a document in the seeded shuffle: 32 bits of its mark."""
    return F.conv(F.substring(mark, 1, 8), 16, 10).cast("long")


def targets(sized: DataFrame, epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: ``source``, ``n``, ``source_size``, ``target``.

    Sources by code point, null last, weigh 1, 2, 3, repeating; the budget is all words. The
    windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = sized.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    per = per.withColumn("weight", (F.row_number().over(by_name) - 1) % 3 + 1).withColumn("cap", F.col("source_size") * epochs)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tightest = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = tightest.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weights = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    per = per.withColumn("level", left / weights)
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    level = F.first(fits, ignorenulls=True).over(tightest.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.least(F.col("cap").cast("double"), F.coalesce(level * F.col("weight"), F.col("cap").cast("double")))
    return per.select("source", "n", "source_size", target.alias("target"))


def plan(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sizes of the documents with their bucket, one row per source with its cut).

    A cut: ``whole`` repetitions of everything; ``cut``, the bucket in which the seeded part
    ends; ``need``, the words still wanted from that bucket.
    """
    sized = stored(sizes(docs), "mix-sizes")
    per = stored(targets(sized), "mix-targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    per = per.withColumn("whole", whole).withColumn("part", F.col("target") - F.col("whole") * F.col("source_size"))
    per = per.withColumn("buckets", F.ceil(F.col("n") / PER_BUCKET).cast("long"))
    placed = _with_source(sized, per.select("source", "buckets")).withColumn("bucket", _bucket())
    filled = placed.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    # running sums over the buckets of a source: one row per 256 documents
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    filled = filled.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    cuts = (
        _with_source(filled, per.select("source", "part")).filter((F.col("before") <= F.col("part")) & (F.col("part") < F.col("before") + F.col("words")))
        .select("source", F.col("bucket").alias("cut"), (F.col("part") - F.col("before")).alias("need"))
    )
    per = per.join(cuts.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s", "part")
    return sized, stored(per, "mix-cuts")


def _bucket():
    return F.floor(F.col("h") * F.col("buckets") / F.lit(1 << 32)).cast("long")


def _small(df: DataFrame) -> DataFrame:
    """Broadcast only if the rows are counted and few; else the join shuffles."""
    return F.broadcast(df) if df.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES else df


def _with_source(df: DataFrame, per_source: DataFrame) -> DataFrame:
    """Add columns of the source table; null sources match."""
    other = [c for c in per_source.columns if c != "source"]
    right = per_source.select(F.col("source").alias("_s"), *other)
    return df.join(_small(right), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")


def _in_cut(sized: DataFrame, per: DataFrame) -> DataFrame:
    """Documents of the buckets that the cuts fall into, with ``extra``: 1 if taken once more.

    The windows run over one bucket of each source (about ``PER_BUCKET`` documents).
    """
    rows = _with_source(sized, per).withColumn("bucket", _bucket()).filter(F.col("bucket") == F.col("cut"))
    order = [F.col("h"), F.col("doc_id"), F.col("size")]
    of_source = Window.partitionBy("source")
    running = of_source.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.sum("size").over(running)).withColumn("within", F.col("upto") <= F.col("need"))
    gap = F.col("need") - F.coalesce(F.max(F.when(F.col("within"), F.col("upto"))).over(of_source), F.lit(0))
    rows = rows.withColumn("gap", gap).withColumn("miss", F.when(~F.col("within") & (F.col("size") > 0), F.abs(F.col("gap") - F.col("size"))))
    best = F.row_number().over(of_source.orderBy(F.col("miss").asc_nulls_last(), *order))
    return rows.withColumn("extra", (F.col("within") | ((best == 1) & F.coalesce(F.col("miss") < F.col("gap"), F.lit(False)))).cast("int"))


def mix(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``times`` (how often the document is taken), ``taken`` (words)."""
    sized, per = plan(docs)
    rows = _with_source(sized, per).withColumn("bucket", _bucket())
    # a source without a cut takes no part (it has no words, or its target is a whole multiple)
    outer = rows.filter(~F.coalesce(F.col("bucket") == F.col("cut"), F.lit(False)))
    outer = outer.withColumn("extra", F.coalesce((F.col("bucket") < F.col("cut")).cast("int"), F.lit(0)))
    times = (F.col("whole") + F.col("extra")).alias("times")
    columns = ["doc_id", "size", "source_size", "target", times, (times * F.col("size")).alias("taken")]
    return _in_cut(sized, per).select(*columns).unionByName(outer.select(*columns))


def sample(docs: DataFrame) -> DataFrame:
    """The mix as documents: each row as often as it is taken, columns unchanged.

    Texts are not shuffled for the decision: whole repetitions and the cut come from the
    source's row; only marks of the cut's bucket (some hundred per source) are looked up. Of
    rows with the same id and text the cut may take a part; only these are numbered.
    """
    n, mark, bucket, won, equal, s, whole, buckets, cut, by, place = fresh(docs, "n", "mark", "bucket", "won", "equal", "s", "whole", "buckets", "cut", "by", "place")
    sized, per = plan(docs)
    in_cut = _in_cut(sized, per).groupBy("source", "mark").agg(F.sum("extra").alias(won), F.count("*").alias(equal))
    in_cut = stored(in_cut.filter(F.col(won) > 0).select(F.col("source").alias(by), F.col("mark").alias(place), won, equal), "mix-closing")
    right = per.select(F.col("source").alias(s), F.col("whole").alias(whole), F.col("buckets").alias(buckets), F.col("cut").alias(cut))
    source = F.col("source").cast("string")
    rows = docs.withColumn(mark, _mark()).join(_small(right), source.eqNullSafe(F.col(s)), "left")
    rows = rows.withColumn(bucket, F.floor(_place(F.col(mark)) * F.col(buckets) / F.lit(1 << 32)).cast("long"))
    rows = rows.join(_small(in_cut), (F.col(mark) == F.col(place)) & source.eqNullSafe(F.col(by)) & (F.col(bucket) == F.col(cut)), "left")
    more = F.when(F.col(bucket) < F.col(cut), 1).when(F.col(won) == F.col(equal), 1).otherwise(0)
    in_part = F.coalesce(F.col(won) < F.col(equal), F.lit(False))
    # one group of equal rows at most is cut in a source, and one more closes its gap
    numbered = rows.filter(in_part).withColumn(n, F.row_number().over(Window.partitionBy(s, mark).orderBy(F.lit(1))))
    numbered = numbered.withColumn(n, (F.col(n) <= F.col(won)).cast("int"))
    rows = rows.filter(~in_part).withColumn(n, F.coalesce(more, F.lit(0))).unionByName(numbered)
    times = (F.coalesce(F.col(whole), F.lit(0)) + F.col(n)).cast("int")
    return rows.withColumn(n, F.explode(F.array_repeat(F.lit(1), times))).select(*docs.columns)


#: The same mix in DuckDB's SQL.
ORACLE_SQL = """
WITH s AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         ('0x' || md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')))[1:8])::BIGINT AS h FROM documents),
p AS (SELECT source, count(*) AS n, sum(size)::BIGINT AS source_size FROM s GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, source_size * 3 AS cap FROM p),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM w),
f AS (SELECT *, (SELECT arg_min(level, (cap / weight, source)) FROM l WHERE level * weight <= cap) AS fill FROM l),
t AS (SELECT source, n, source_size, least(cap::DOUBLE, coalesce(fill * weight, cap::DOUBLE)) AS target FROM f),
c AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole, ceil(n / 256)::BIGINT AS buckets FROM t),
d AS (SELECT s.*, c.source_size, c.target, c.whole, c.target - c.whole * c.source_size AS part, floor(s.h * c.buckets / 4294967296)::BIGINT AS bucket
      FROM s JOIN c ON s.source IS NOT DISTINCT FROM c.source),
b AS (SELECT source, bucket, part, sum(size) AS words FROM d GROUP BY ALL),
r AS (SELECT *, coalesce(sum(words) OVER (PARTITION BY source ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM b),
k AS (SELECT source, bucket AS cut, part - before AS need FROM r WHERE before <= part AND part < before + words),
e AS (SELECT d.*, k.cut, k.need FROM d LEFT JOIN k ON d.source IS NOT DISTINCT FROM k.source),
i AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto FROM e WHERE bucket = cut),
g AS (SELECT *, need - coalesce(max(CASE WHEN upto <= need THEN upto END) OVER (PARTITION BY source), 0) AS gap FROM i),
m AS (SELECT *, CASE WHEN upto > need AND size > 0 THEN abs(gap - size) END AS miss FROM g),
o AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY miss NULLS LAST, h, doc_id, size) AS best FROM m),
u AS (SELECT doc_id, size, source_size, target, whole + CASE WHEN upto <= need OR (best = 1 AND coalesce(miss < gap, false)) THEN 1 ELSE 0 END AS times FROM o
      UNION ALL SELECT doc_id, size, source_size, target, whole + CASE WHEN bucket < cut THEN 1 ELSE 0 END FROM e WHERE cut IS NULL OR bucket <> cut)
SELECT doc_id, size, source_size, target, times, times * size AS taken FROM u
"""

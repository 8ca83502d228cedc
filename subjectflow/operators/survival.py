"""Time-to-event records, Kaplan-Meier curves and risk tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subjectflow.functions.cells import col
from subjectflow.operators.scans import ranged, scan


@dataclass(frozen=True)
class EventSource:
    """Where an event date comes from: table, row condition, date, constants to carry."""

    dataset: str
    date: str | Column
    where: Column | None = None
    values: Mapping[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class CensorSource(EventSource):
    """Where a censoring date comes from."""


def time_to_event(
    subjects: DataFrame, start_date: str, events: Sequence[EventSource], censors: Sequence[CensorSource],
    datasets: Mapping[str, DataFrame], by: Sequence[str], values: Mapping[str, object] | None = None,
) -> DataFrame:
    """One record per subject: the earliest event (CNSR 0), else the latest censor date (CNSR 1).

    All candidates go through one minimum per subject: events sort before censors,
    events by rising date, censors by falling date, then by source order. The date is
    not allowed before the start date. Subjects without any date are left out.
    """
    names = list(dict.fromkeys(n for s in [*events, *censors] for n in s.values))
    candidates = None
    for censored, sources in ((0, events), (1, censors)):
        for position, source in enumerate(sources):
            frame = datasets[source.dataset]
            if source.where is not None:
                frame = frame.filter(source.where)
            date = col(source.date).cast("date")
            rank = F.unix_date(date)
            part = frame.filter(date.isNotNull()).select(
                *by,
                F.struct(
                    F.lit(censored).alias("CNSR"),
                    (-rank if censored else rank).alias("rank"),
                    F.lit(position).alias("source"),
                    date.alias("ADT"),
                    *[_constant(source.values.get(n)).alias(n) for n in names],
                ).alias("_c"),
            )
            candidates = part if candidates is None else candidates.union(part)
    chosen = candidates.groupBy(*by).agg(F.min("_c").alias("_c"))
    out = subjects.select(*by, F.col(start_date).cast("date").alias("STARTDT")).join(chosen, list(by), "inner")
    adt = F.when(F.col("STARTDT").isNotNull(), F.greatest(F.col("_c.ADT"), F.col("STARTDT")))
    out = out.select(*by, "STARTDT", adt.alias("ADT"), F.col("_c.CNSR").alias("CNSR"), *[F.col(f"_c.{n}").alias(n) for n in names])
    for name, value in (values or {}).items():
        out = out.withColumn(name, _constant(value))
    return out


def _constant(value) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(value)


_NORMAL_975 = 1.959963984540054  # fixed value: 97.5 % point of the normal distribution


def km_curve(df: DataFrame, by: str, time: str = "AVAL", event: Column | None = None) -> DataFrame:
    """Kaplan-Meier estimate per arm at every observed time.

    ``event`` is the event test (default ``CNSR = 0``). Rows collapse to one per arm and
    time. The times of an arm are cut into ranges and the numbers at risk, the product and
    the Greenwood sum are carried from range to range (``scans.scan``), so times may be as
    many and as fine as the rows. The confidence limits use the log transform; they are null
    once survival is zero.
    """
    test = F.coalesce((F.col("CNSR") == 0) if event is None else event, F.lit(False))
    counts = (
        df.filter(F.col(time).isNotNull() & F.col(by).isNotNull())
        .groupBy(by, F.col(time).alias("time"))
        .agg(F.count_if(test).alias("n_event"), F.count_if(~test).alias("n_censor"))
    )
    placed = ranged(counts, [by], "time", "_range")
    risk = scan(placed, [by], "_range", ["time"], {"n_risk": ("sum", F.col("n_event") + F.col("n_censor"))}, backwards=True)
    kept = F.lit(1.0) - F.col("n_event") / F.col("n_risk")
    spread = F.coalesce(F.col("n_event") / (F.col("n_risk") * F.nullif(F.col("n_risk") - F.col("n_event"), F.lit(0))), F.lit(0.0))
    curve = scan(risk, [by], "_range", ["time"], {"surv": ("product", kept), "_g": ("sum", spread)})
    error = F.when(F.col("surv") > 0, F.sqrt("_g"))
    width = F.exp(F.lit(_NORMAL_975) * error)
    return curve.select(
        by, "time", "n_risk", "n_event", "n_censor", "surv",
        error.alias("std_err"),
        (F.col("surv") / width).alias("lower"),
        F.when(error.isNotNull(), F.least(F.lit(1.0), F.col("surv") * width)).alias("upper"),
    )


def risk_table(df: DataFrame, by: str, times: Sequence[int], time: str = "AVAL") -> DataFrame:
    """Number at risk per arm at fixed times: one conditional count per time, one pass."""
    at = [F.count_if(F.col(time) >= t).alias(f"_t{t}") for t in times]
    counted = df.filter(F.col(time).isNotNull() & F.col(by).isNotNull()).groupBy(by).agg(*at)
    rows = F.array(*[F.struct(F.lit(t).alias("time"), F.col(f"_t{t}").alias("n_risk")) for t in times])
    return counted.select(by, F.explode(rows).alias("_e")).select(by, "_e.time", "_e.n_risk")


def censor_date(decode: str, death: Column, end: Column, code: str = "DEATH") -> Column:
    """Date at which a subject without the event leaves: of death, else of the end; null if the reason is."""
    return F.when(F.col(decode) == code, death).when(F.col(decode) != code, end)

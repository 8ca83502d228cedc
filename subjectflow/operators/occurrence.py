"""Derivations on occurrence records: emergent flag, custom query, first occurrences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subjectflow.functions.cells import contains_any, if_else
from subjectflow.operators.picks import flag_first_nested


def treatment_emergent(start: str, end: str | None, treatment_start: str) -> Column:
    """'Y' when the occurrence starts on or after the first dose.

    A missing start counts as emergent unless the end lies before the first dose.
    """
    s, t = F.col(start), F.col(treatment_start)
    test = s >= t
    if end is not None:
        e = F.col(end)
        test = F.when(s.isNull(), e.isNull() | (e >= t)).otherwise(test)
    return F.when(t.isNotNull() & test, "Y")


def custom_query(
    term: str, group: str, terms: Sequence[str], group_text: str, excluded: Sequence[str], name: str
) -> Column:
    """Query name for terms holding one of ``terms``, or for terms of the group that are
    not ``excluded``; the exclusions guard the group test only."""
    in_group = F.col(group).contains(group_text) & ~contains_any(term, excluded)
    return if_else(contains_any(term, terms) | in_group, F.lit(name), F.lit(None).cast("string"))


def occurrence_flags(
    df: DataFrame, subject: str, group: str, term: str, start: str, seq: str, emergent: Column, serious: Column,
    queried: Column, names: Sequence[str] = ("AOCCFL", "AOCCSFL", "AOCCPFL", "AOCC02FL", "AOCC03FL", "AOCC04FL", "AOCC01FL"),
) -> DataFrame:
    """Seven first-occurrence flags among emergent records: any, per group, per term; the
    same three among serious ones; and any within the custom query."""
    any_, per_group, per_term, s_any, s_group, s_term, q_any = names
    return flag_first_nested(
        df,
        levels=[[subject], [subject, group], [subject, group, term]],
        order=[start],
        row_key=[subject, seq],
        conditions={"em": emergent, "se": emergent & serious, "cq": emergent & queried},
        flags={
            any_: (0, "em"), per_group: (1, "em"), per_term: (2, "em"),
            s_any: (0, "se"), s_group: (1, "se"), s_term: (2, "se"), q_any: (0, "cq"),
        },
        where=emergent,
    )

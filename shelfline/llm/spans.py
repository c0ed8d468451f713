"""Positions of pattern hits in whole texts, with built-in functions only.

A pattern is searched as ``([\\s\\S]*?)(?:(P)|\\z)``: the gap before each hit and the hit
itself. Gaps and hits are added up to positions in code points, so hits are leftmost and
do not overlap, as a regular expression search finds them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"
HITS = "array<struct<start:int,gap:string,hit:string>>"


def hits(text: Column, pattern: str, gate: Column | None = None) -> Column:
    """Hits of ``pattern`` (no capturing groups) as structs of start, end of the gap before, hit.

    ``gate`` may say cheaply that a text has none.
    """
    whole = F.lit(rf"([\s\S]*?)(?:({pattern})|\z)")
    pairs = F.arrays_zip(
        F.regexp_extract_all(text, whole, F.lit(1)).alias("gap"),
        F.regexp_extract_all(text, whole, F.lit(2)).alias("hit"),
    )

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        one = F.array(F.struct(start.alias("start"), F.right(pair["gap"], F.lit(60)).alias("gap"), pair["hit"].alias("hit")))
        return F.struct(
            (start + F.length(pair["hit"])).alias("at"),
            F.when(pair["hit"] == "", state["out"]).otherwise(F.concat(state["out"], one)).alias("out"),
        )

    empty = F.array().cast(HITS)
    found = F.aggregate(
        pairs,
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        step,
        lambda state: state["out"],
    )
    some = text.rlike(pattern) if gate is None else gate & text.rlike(pattern)
    return F.when(some, found).otherwise(empty)


def spans(found: Column, kind: str, rank: int) -> Column:
    """Spans of hits, to be sorted by start and then by the rank of their kind."""
    return F.transform(
        found,
        lambda h: F.struct(
            h["start"].alias("start"),
            F.lit(rank).alias("rank"),
            (h["start"] + F.length(h["hit"])).alias("end"),
            F.lit(kind).alias("kind"),
        ),
    ).cast(SPAN)


def ordered(*parts: Column) -> Column:
    return F.array_sort(reduce(lambda a, b: F.concat(a, b), parts))


def listed(found: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def count_of(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")


def replaced(text: Column, found: Column, label) -> Column:
    """``text`` with every span, overlapping ones together, replaced by ``label(span)``."""

    def step(state: Column, s: Column) -> Column:
        inside = s["start"] < state["at"]
        before = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(inside, state["out"]).otherwise(F.concat(state["out"], F.array(before, label(s)))).alias("out"),
        )

    done = F.aggregate(
        found,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        step,
        lambda state: F.concat(F.array_join(state["out"], ""), F.substring(text, state["at"] + 1, F.length(text))),
    )
    return F.when(F.size(found) > 0, done).otherwise(text)

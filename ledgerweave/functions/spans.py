"""All matches of a pattern with their offsets, without leaving the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def matches(c: Column, pattern: str) -> Column:
    """``array<struct<at int, hit string>>``: every match, ``at`` counting from 0.

    Between the matches stand the pieces of the text split at the pattern, so a match begins where the
    pieces and matches before it end; one running sum over both gives all places. A pattern that looks around or matches nothing
    has other pieces than matches, which is an error.
    """
    hits = F.regexp_extract_all(c, F.lit(pattern), F.lit(0))
    pieces = F.transform(F.split(c, pattern, -1), lambda p: F.length(p))
    empty = F.array().cast("array<struct<at:int,hit:string>>")
    start = F.struct(F.lit(0).alias("end"), empty.alias("found"))

    def place(acc: Column, x: Column) -> Column:
        at = acc["end"] + x["piece"]
        return F.struct((at + F.length(x["hit"])).alias("end"), F.concat(acc["found"], F.array(F.struct(at.alias("at"), x["hit"].alias("hit")))).alias("found"))

    both = F.zip_with(F.slice(pieces, F.lit(1), F.size(hits)), hits, lambda p, h: F.struct(p.alias("piece"), h.alias("hit")))
    fits = F.size(hits) == F.size(pieces) - 1
    return F.when(c.isNull() | (F.size(hits) == 0), F.when(c.isNotNull(), empty)).when(fits, F.aggregate(both, start, place, lambda acc: acc["found"])).otherwise(F.raise_error(F.lit(f"matches of {pattern!r} cannot be placed")).cast("array<struct<at:int,hit:string>>"))


def nearest(spans: Column, at: Column) -> Column:
    """The span of ``array<struct<at, hit, label, rank>>`` that begins nearest to ``at``; the least rank, then the earlier one on ties."""
    order = lambda s: F.struct(F.abs(s["at"] - at).alias("d"), s["rank"].alias("rank"), s["at"].alias("at"), s["hit"].alias("hit"), s["label"].alias("label"))
    return F.array_min(F.transform(spans, order))


def places(c: Column, word: str) -> Column:
    """``array<struct<at int, hit string>>`` of a word, found as a substring."""
    return matches(c, _quoted(word))


def _quoted(word: str) -> str:
    return "".join(x if x.isalnum() or x == " " else f"\\{x}" for x in word)

"""Variant spellings of names typed by people (problem 1).

Each distinct name of a district is taken apart (type words, phase, side, numbers, name proper), and its canonical
rewritings - nickname, initial, legal form, token order, one letter or one word left out - are exploded. Names of one kind that share a
rewriting meet by equi-join; a pair's score is the rarity of its rarest shared rewriting among all names. Names of a rewriting that is not
``RARE`` meet by the rarest word of one of them instead. Pairs are checked word by word. A name with a place word left out is the longer name if only one project has such a longer name. Statements
that two names are one (overrides) are edges like the others, so that they hold for every spelling of their names.
Components of the graph over names are the projects.

Defined cases: rows without a district number take the number that most rows with their district name
have, and are in no pair if there is none; rows that state no project are in no pair; equal names are in
no pair with each other; repeated rows pair like others; empty tables give no pair; withdrawn and null overrides count
for nothing; very long names are handled whole; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerweave.functions.ids import district_number, truthy
from ledgerweave.llm.project_names import alike, dropped, forms_of, is_no_project, met_by, parts_of
from ledgerweave.operators.components import connected_components
from ledgerweave.operators.joins import salted_join
from ledgerweave.session import cut, spread

#: Least score of a rewriting by which all its names meet. The score is 1 - log(names with the rewriting) / log(all names and PRIOR more): 1 for a rewriting of one name, near 0 for one of all.
#: At one half no rewriting brings more pairs than there are names (and PRIOR more), whatever their number; names of a more frequent one meet by words (``_by_words``).
RARE, PRIOR = 0.5, 1000

_STRINGS = T.ArrayType(T.StringType())
_PARTS = T.StructType([T.StructField("block", T.StringType()), T.StructField("words", _STRINGS), T.StructField("initials", _STRINGS), T.StructField("forms", _STRINGS)])


@F.pandas_udf(_PARTS)
def _parts(names: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in names:
        rows = [None if is_no_project(n) else parts_of(n) for n in batch]
        yield pd.DataFrame(
            {
                "block": [p and p.block for p in rows],
                "words": [p and list(p.words) for p in rows],
                "initials": [p and list(p.initials) for p in rows],
                "forms": [p and forms_of(list(p.words), list(p.initials), not p.block.endswith("|")) for p in rows],
            }
        )


@F.pandas_udf(T.StringType())
def _checked(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
    """``alike`` where the words of two names of one block pair up; ``short`` where one lacks a word of the other and the two are not
    reported in the same year; else null."""
    for lw, li, rw, ri, numbered, together in batches:
        out = []
        for a, ai, b, bi, n, t in zip(lw, li, rw, ri, numbered, together, strict=True):
            a, ai, b, bi = list(a), list(ai), list(b), list(bi)
            if alike(a, ai, b, bi, bool(n)) is not None:
                out.append("alike")
            else:
                out.append("short" if not t and dropped(a, b) else None)
        yield pd.Series(out, dtype=object)


_MET_BY = T.StructType([T.StructField("each", T.ArrayType(_STRINGS)), T.StructField("together", _STRINGS), T.StructField("whole", _STRINGS)])


@F.pandas_udf(_MET_BY)
def _met_by(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for words, initials in batches:
        yield pd.DataFrame([met_by(list(w), list(i)) for w, i in zip(words, initials, strict=True)], columns=["each", "together", "whole"])


def _by_words(parsed: DataFrame, often: DataFrame) -> DataFrame:
    """``(group, a, b, score)``: all pairs of names that share one of the rewritings of ``often`` ``(key, group, name, score)`` and may pass the check.

    Of each name the word that the fewest names of its kind may have is held against all words of those names (``met_by``): a pair that passes the
    check shares a key, however many names have its rewriting.
    """
    hot = often.groupBy("group", "name").agg(F.collect_set(F.struct("score", "key")).alias("hot"))
    met = cut(spread(parsed.join(hot, ["group", "name"])).select("group", "block", "name", "hot", _met_by("words", "initials").alias("m")))
    key = F.unhex(F.md5(F.concat_ws("\u0001", F.coalesce("group", F.lit("\u0002")), "block", "k"))).alias("k")
    exploded = lambda c: met.select("group", "block", "name", F.explode(c).alias("k"))
    whole = cut(exploded(F.concat("m.whole", "m.together")).select(key, "group", F.col("name").alias("b")))
    words = met.select("group", "block", "name", F.posexplode("m.each").alias("i", "ks")).select("group", "block", "name", "i", F.explode("ks").alias("k")).select(key, "group", "name", "i")
    cost = words.join(whole.groupBy("k").agg(F.count(F.lit(1)).alias("n")), "k", "left").groupBy("group", "name", "i").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"))
    rarest = cost.groupBy("group", "name").agg(F.min(F.struct("n", "i")).alias("r")).select("group", "name", F.col("r.i").alias("i"))
    chosen = words.join(rarest, ["group", "name", "i"]).select("k", F.col("name").alias("a")).unionByName(exploded("m.together").select(key, F.col("name").alias("a")))
    pairs = salted_join(chosen, whole, ["k"]).filter("a <> b").select("group", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    of = lambda n: met.select("group", F.col("name").alias(n), F.col("hot").alias(f"{n}h"))
    shared = pairs.join(of("a"), ["group", "a"]).join(of("b"), ["group", "b"]).select("group", "a", "b", F.array_max(F.array_intersect("ah", "bh")).alias("s"))
    return shared.filter("s is not null").select("group", "a", "b", F.col("s.score").alias("score"))


def _district_of(rows: DataFrame) -> DataFrame:
    """Rows ``(.., number, district, ..)`` with a null number filled from the rows of the same district name."""
    key = F.upper(F.trim("district"))
    known = rows.filter("number is not null and trim(district) <> ''").groupBy(key.alias("_d"), "number").agg(F.count(F.lit(1)).alias("_n"))
    first = known.groupBy("_d").agg(F.max_by("number", F.struct("_n", "number")).alias("_number"))
    return rows.withColumn("_d", key).join(first, "_d", "left").withColumn("number", F.coalesce("number", "_number")).drop("_d", "_number")


def _only_longer(short: DataFrame, alike: DataFrame) -> DataFrame:
    """Of pairs ``(group, a, b, score, shorter, longer, places)`` those whose shorter name can be one project only.

    Longer names that are spellings of each other are one project, so that their number does not count. Where a shorter name shares a place with a
    longer one, it is judged in each such place by itself, else over the whole group.
    """
    node = lambda c: F.concat_ws("\u0001", "group", c)
    spelt = connected_components(alike.select(node("a").alias("a"), node("b").alias("b"))).select(F.col("node").alias("_n"), "component")
    known = short.withColumn("_n", node("longer")).join(spelt, "_n", "left").withColumn("project", F.coalesce("component", "_n")).drop("_n", "component")
    at = known.withColumn("place", F.explode_outer("places")).drop("places")
    by_place = at.groupBy("group", "shorter", "place").agg(F.min("project").alias("lo"), F.max("project").alias("hi"))
    placed = by_place.groupBy("group", "shorter").agg(F.max(F.col("place").isNotNull()).alias("placed"))
    sure = by_place.join(placed, ["group", "shorter"]).filter("lo = hi and placed = (place is not null)").select("group", "shorter", "lo", F.col("place").alias("_p"))
    one = at.join(sure, ["group", "shorter"]).filter("place <=> _p and project = lo")
    return one.select("group", "a", "b", "score").distinct()


def name_links(names: DataFrame) -> DataFrame:
    """``(group, a, b, score)``: names of a group that are one; input ``(group, name, years)``, distinct, and ``places`` if a group has several.

    Names are compared only through shared forms, of which none is left out for being frequent.
    """
    if "places" not in names.columns:
        names = names.withColumn("places", F.array().cast("array<string>"))
    # cut before the filter, which would else run the parsing on every row below the grouping
    parsed = cut(spread(names).withColumn("_p", _parts("name"))).filter("_p.block is not null")
    parsed = parsed.select("group", "name", "years", "places", F.col("_p.block").alias("block"), F.col("_p.words").alias("words"), F.col("_p.initials").alias("initials"), F.col("_p.forms").alias("forms"))
    key = F.unhex(F.md5(F.concat_ws("\u0001", F.coalesce("group", F.lit("\u0002")), "block", "form")))  # 128 bits
    forms = parsed.select("group", "block", "name", F.explode("forms").alias("form")).select(key.alias("key"), "group", "name")
    # a name has a form once
    total = F.broadcast(parsed.agg(F.count(F.lit(1)).alias("all")))  # one row
    counts = forms.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").crossJoin(total)
    score = 1 - F.log("n") / F.log(F.col("all") + PRIOR)
    shared = cut(forms.join(counts.select("key", score.alias("score")), "key"))
    rare, often = shared.filter(F.col("score") >= RARE), shared.filter(F.col("score") < RARE)
    left = rare.select("key", "group", F.col("name").alias("a"), "score")
    right = rare.select("key", F.col("name").alias("b"))
    pairs = salted_join(left, right, ["key"]).filter("a < b").select("group", "a", "b", "score")
    if not often.isEmpty():
        pairs = pairs.unionByName(_by_words(parsed, often))
    pairs = pairs.groupBy("group", "a", "b").agg(F.max("score").alias("score"))
    side = lambda n: parsed.select("group", F.col("name").alias(n), "block", F.col("words").alias(f"{n}w"), F.col("initials").alias(f"{n}i"), F.col("years").alias(f"{n}y"), F.col("places").alias(f"{n}p"))
    both = pairs.join(side("a"), ["group", "a"]).join(side("b").drop("block"), ["group", "b"])
    numbered = F.element_at(F.split("block", r"\|"), 4) != ""
    checked = both.withColumn("how", _checked("aw", "ai", "bw", "bi", numbered, F.arrays_overlap("ay", "by"))).filter("how is not null")
    fewer = F.size("aw") < F.size("bw")
    checked = cut(checked.select("group", "a", "b", "score", "how", F.when(fewer, F.col("a")).otherwise(F.col("b")).alias("shorter"), F.when(fewer, F.col("b")).otherwise(F.col("a")).alias("longer"), F.array_intersect("ap", "bp").alias("places")))
    alike_pairs = checked.filter("how = 'alike'").select("group", "a", "b", "score")
    return alike_pairs.unionByName(_only_longer(checked.filter("how = 'short'"), alike_pairs))


def statements(overrides: DataFrame) -> DataFrame:
    """``(group, a, b)`` of active overrides: the raw name, the canonical name, and the name in the canonical id."""
    slug = F.nullif(F.trim(F.regexp_replace(F.regexp_replace(F.col("canonical_project_id"), r"^proj_T-\d+_", ""), "-", " ")), F.lit(""))
    blank = lambda c: F.when(F.trim(c) != "", F.col(c))
    rows = overrides.filter(truthy(F.col("active"))).select(
        district_number(F.col("tif_number")).alias("group"), blank("raw_project_name").alias("raw"), blank("canonical_project_name").alias("canonical"), F.when(F.col("canonical_project_id").rlike(r"^proj_T-\d+_"), slug).alias("slug")
    )
    edges = F.array(F.struct(F.col("raw").alias("a"), F.col("canonical").alias("b")), F.struct(F.col("raw").alias("a"), F.col("slug").alias("b")), F.struct(F.col("canonical").alias("a"), F.col("slug").alias("b")))
    return rows.filter("group is not null").select("group", F.explode(edges).alias("e")).select("group", "e.*").filter("a is not null and b is not null").distinct()


def projects(annual: DataFrame, overrides: DataFrame) -> DataFrame:
    """``(annual_row_id, name, project)``; rows of one project have one id, rows of a name alone in its project are left out."""
    rows = annual.select("annual_row_id", district_number(F.col("tif_number")).alias("number"), F.col("tif_district").alias("district"), F.col("project_name").alias("name"), F.col("report_year").alias("year"))
    rows = cut(_district_of(rows.filter("trim(name) <> ''")).filter("number is not null").select("annual_row_id", F.col("number").alias("group"), "name", "year"))
    said = statements(overrides)
    stated = said.select("group", F.explode(F.array("a", "b")).alias("name")).withColumn("year", F.lit(None).cast("int"))
    names = rows.select("group", "name", "year").unionByName(stated).groupBy("group", "name").agg(F.collect_set("year").alias("years"))
    links = name_links(names).select("group", "a", "b").unionByName(said)
    node = lambda c: F.concat_ws("\u0001", "group", c)
    components = connected_components(links.select(node("a").alias("a"), node("b").alias("b")))
    return rows.withColumn("node", node("name")).join(components, "node").select("annual_row_id", "name", F.col("component").alias("project"))


def same_project_pairs(annual: DataFrame, overrides: DataFrame) -> DataFrame:
    """``(annual_row_id_a, annual_row_id_b)`` of rows of one project whose names differ as strings.

    The names of a project are paired first, whatever their rows; then each pair of names goes to its rows.
    """
    rows = cut(projects(annual, overrides).distinct())
    names = rows.select("project", "name").distinct()
    both = names.withColumnRenamed("name", "na").join(names.withColumnRenamed("name", "nb"), "project").filter("na < nb")
    a = rows.select("project", F.col("name").alias("na"), F.col("annual_row_id").alias("ia"))
    b = rows.select("project", F.col("name").alias("nb"), F.col("annual_row_id").alias("ib"))
    pairs = both.join(a, ["project", "na"]).join(b, ["project", "nb"])
    return pairs.select(F.least("ia", "ib").alias("annual_row_id_a"), F.greatest("ia", "ib").alias("annual_row_id_b"))

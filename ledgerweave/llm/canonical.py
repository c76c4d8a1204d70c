"""Mapping free-entered values to a canonical list by a prefix-filtered set-similarity join (problem 4).

Every name becomes a set of tokens: letter pairs of its place words, whole street numbers, one token for
its kind words, or only the district number where one is written. Tokens are ordered by global rarity;
two sets that reach the Jaccard threshold share a token of their rarest prefixes, so only prefixes are
joined. Length and position filters come with the join, then Jaccard is computed exactly, an exact check of the words follows, and
the entry of the greatest Jaccard is kept.

Defined cases: null and blank names are not mapped by ``map_names`` (``mapped`` reports them as
``unmatched``); a name that denotes no listed entry has the empty number; equal best entries of different
districts are decided by the smaller number; repeated rows get equal answers; an empty list maps
everything to no entry; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerweave.llm.district_names import near, words_of
from ledgerweave.session import cut, spread

#: Jaccard similarity that a candidate has at least; one typo in a six-letter word keeps more.
THRESHOLD = 0.4
#: Rounding of products of the threshold must not cost a pair that reaches it exactly.
SLACK = 1e-9
#: Edits allowed in each place word.
EDITS = 1

_PARSED = T.StructType([T.StructField("number", T.StringType()), T.StructField("stems", T.ArrayType(T.StringType())), T.StructField("kinds", T.StringType())])


@F.pandas_udf(_PARSED)
def _parsed(names: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in names:
        rows = [words_of(n) for n in batch]
        yield pd.DataFrame({"number": [r[0] for r in rows], "stems": [r[1] for r in rows], "kinds": [" ".join(r[2]) for r in rows]})


@F.pandas_udf(T.IntegerType())
def _edits(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
    """Edits between the place words of two names, each paired with its nearest; null where a pair has more than EDITS.

    Numbers, and words that are themselves words of the place vocabulary, must be equal.
    """
    for raw, own, listed in batches:
        out = []
        for a, o, b in zip(raw, own, listed, strict=True):
            out.append(_pairing(list(a), set(o if o is not None else ()), list(b)))
        yield pd.Series(out, dtype="Int32")


def _pairing(a: list[str], own: set[str], b: list[str]) -> int | None:
    if len(a) != len(b):
        return None
    left, total = [x for x in b if x not in a], 0
    for word in (x for x in a if x not in b):
        if word.isdigit() or word in own:
            return None
        best = min(((near(word, x), x) for x in left if not x.isdigit()), default=(9, ""))
        if best[0] > EDITS:
            return None
        total += best[0]
        left.remove(best[1])
    return total


def _tokens(number: Column, stems: Column, kinds: Column) -> Column:
    grams = F.flatten(
        F.transform(
            stems,
            lambda w: F.when(w.rlike(r"^\d+$"), F.array(F.concat(F.lit("n:"), w))).otherwise(
                F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substr(F.concat(F.lit("^"), w, F.lit("$")), i.cast("int"), F.lit(2)))
            ),
        )
    )
    words = F.when(kinds != "", F.array_append(grams, F.concat(F.lit("k:"), kinds))).otherwise(grams)
    return F.array_distinct(F.when(number.isNotNull(), F.array(F.concat(F.lit("#"), number))).otherwise(words))


def _named(df: DataFrame, name: str) -> DataFrame:
    parsed = df.withColumn("_p", _parsed(F.col(name)))
    return parsed.select(*df.columns, F.col("_p.stems").alias("stems"), F.col("_p.kinds").alias("kinds"), _tokens(F.col("_p.number"), F.col("_p.stems"), F.col("_p.kinds")).alias("tokens"))


def _own_words(stems: DataFrame, listed: DataFrame) -> DataFrame:
    """``(word)`` of ``stems`` that are words of the place vocabulary.

    Listed words share beginnings and ends; a beginning is one of the vocabulary if at least three letters follow it somewhere, an
    end likewise. A word made of both is a word of its own, so its likeness to a listed one is no typo.
    """
    def splits(words: DataFrame) -> DataFrame:
        at = F.explode(F.sequence(F.lit(3), F.length("word") - 2)).alias("i")
        cut = words.filter("length(word) > 4").select("word", at)
        return cut.select("word", F.expr("substr(word, 1, i)").alias("head"), F.expr("substr(word, i + 1)").alias("tail"))

    known = splits(listed)
    heads = known.groupBy("head").agg(F.countDistinct(F.substring("tail", 1, 1)).alias("n")).filter("n >= 3").select("head")
    tails = known.groupBy("tail").agg(F.countDistinct(F.expr("substr(head, -1)")).alias("n")).filter("n >= 3").select("tail")
    return splits(stems).join(heads, "head", "left_semi").join(tails, "tail", "left_semi").select("word").distinct()


#: Distinct tokens up to this number are ranked in one dictionary that all tasks have; more are ranked by a join.
RANKED = 1_000_000
#: Prefix rows of the right side up to this number are sent to all tasks; more are joined by a shuffle.
SENT = 1_000_000


def _ranked(sides: DataFrame) -> DataFrame:
    """``(side, id, set)``: each set as an array in the global order of its tokens, rarest first; whole numbers stand for the tokens where they can be ranked at once."""
    exploded = sides.select("side", "id", F.explode("tokens").alias("token"))
    frequency = cut(exploded.groupBy("token").agg(F.count(F.lit(1)).alias("f")))
    if frequency.count() > RANKED:
        both = exploded.join(frequency, "token").groupBy("side", "id").agg(F.array_sort(F.collect_set(F.struct("f", "token"))).alias("x"))
        return both.select("side", "id", F.transform("x", lambda x: x["token"]).alias("set"))
    order = [r.token for r in frequency.orderBy("f", "token").collect()]
    ranks = sides.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(order)})

    @F.pandas_udf("array<int>")
    def as_set(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([sorted({ranks.value[t] for t in tokens}) for tokens in batch], dtype=object)

    return sides.select("side", "id", as_set("tokens").alias("set"))


def similarity_join(left: DataFrame, right: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(lid, rid, jaccard)`` of sets with at least that Jaccard; inputs ``(lid, tokens)`` and ``(rid, tokens)``.

    The token order is by frequency over both sides, rarest first, then by the token. Prefix tokens are joined; sizes and positions leave out
    pairs before Jaccard is computed, and what is below the threshold never leaves the join's task.
    """
    sides = left.select(F.col("lid").alias("id"), F.lit(0).alias("side"), "tokens").unionByName(right.select(F.col("rid").alias("id"), F.lit(1).alias("side"), "tokens"))
    ordered = cut(_ranked(sides.filter("size(tokens) > 0")))
    n = F.size("set")
    prefix = ordered.select("side", "id", "set", F.posexplode(F.slice("set", F.lit(1), n - F.ceil(n * threshold - SLACK).cast("int") + 1)).alias("at", "token"))
    a = prefix.filter("side = 0").select(F.col("id").alias("lid"), F.col("set").alias("ls"), F.col("at").alias("la"), "token")
    b = cut(prefix.filter("side = 1").select(F.col("id").alias("rid"), F.col("set").alias("rs"), F.col("at").alias("ra"), "token"))
    la, lb = F.size("ls"), F.size("rs")
    # at the first shared token, what is left of the shorter set bounds the overlap
    most = F.least(la - F.col("la"), lb - F.col("ra"))
    both = F.size(F.array_intersect("ls", "rs"))
    return (
        a.join(F.broadcast(b) if b.count() <= SENT else b, "token")
        .filter((la >= threshold * lb - SLACK) & (lb >= threshold * la - SLACK))
        .filter(most + F.least("la", "ra") >= threshold / (1 + threshold) * (la + lb) - SLACK)
        .select("lid", "rid", (both / (la + lb - both)).alias("jaccard"))
        .filter(F.col("jaccard") >= threshold - SLACK)
        .distinct()
    )


def listed_names(universe: DataFrame) -> DataFrame:
    """``(name, tif_number)``: canonical names, variants, and the number itself as a name."""
    names = F.array_distinct(F.array_compact(F.concat(F.array("canonical_tif_district", "tif_number"), F.coalesce(F.split("district_name_variants", r"\s*;\s*"), F.array()))))
    rows = universe.select("tif_number", F.explode(names).alias("name"))
    return rows.filter("tif_number is not null and trim(name) <> ''").distinct()


def map_names(names: DataFrame, universe: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(name, tif_number, jaccard, edits)`` for each distinct non-blank ``name`` that denotes a listed entry."""
    raw = cut(_named(spread(names.filter(F.col("name").rlike(r"\S")).select("name").distinct()), "name")).withColumnRenamed("name", "lid")  # parsed once, used five times
    listed = cut(_named(listed_names(universe), "name")).withColumn("rid", F.concat_ws("\u0001", "tif_number", "name"))
    pairs = similarity_join(raw, listed, threshold)
    words = lambda d: d.select(F.explode("stems").alias("word")).filter(~F.col("word").rlike(r"^\d+$")).distinct()
    own = _own_words(words(raw), words(listed))
    own_of = raw.select("lid", F.explode("stems").alias("word")).join(own, "word").groupBy("lid").agg(F.collect_set("word").alias("own"))
    checked = (
        pairs.join(raw.select("lid", F.col("stems").alias("ls"), F.col("kinds").alias("lk"), F.col("tokens").alias("lt")), "lid")
        .join(listed.select("rid", "tif_number", F.col("stems").alias("rs"), F.col("kinds").alias("rk"), F.col("tokens").alias("rt")), "rid")
        .join(own_of, "lid", "left")
        .withColumn("edits", F.when(F.col("lt")[0].startswith("#"), F.when(F.col("lt")[0] == F.col("rt")[0], 0)).when(F.col("lk") == F.col("rk"), _edits("ls", "own", "rs")))
        .filter("edits is not null")
    )
    # the most similar entry, edits only break ties
    best = Window.partitionBy("lid").orderBy(F.desc("jaccard"), "edits", "tif_number")
    return checked.withColumn("_r", F.row_number().over(best)).filter("_r = 1").select(F.col("lid").alias("name"), "tif_number", "jaccard", "edits")


def found(candidates: DataFrame, universe: DataFrame) -> DataFrame:
    """``(district_candidate_id, tif_number)`` of each row whose name is not blank and not exactly canonical."""
    exact = universe.select(F.col("canonical_tif_district").alias("name")).distinct()
    rows = candidates.select("district_candidate_id", F.col("district_name_raw").alias("name")).filter(F.col("name").rlike(r"\S")).join(exact, "name", "left_anti")
    return rows.join(map_names(rows, universe), "name", "left").select("district_candidate_id", F.coalesce("tif_number", F.lit("")).alias("tif_number"))


def mapped(candidates: DataFrame, universe: DataFrame) -> DataFrame:
    """``(district_candidate_id, matched_canonical_tif_district, district_match_status, jaccard)`` of every row.

    Status: ``exact`` equal to a canonical name, ``strong_fuzzy`` its words without an edit, ``fuzzy_review`` with edits, ``unmatched``.
    """
    canonical = universe.groupBy("tif_number").agg(F.min("canonical_tif_district").alias("canonical"))
    rows = candidates.select("district_candidate_id", F.col("district_name_raw").alias("name"))
    named = rows.join(map_names(rows, universe).join(canonical, "tif_number"), "name", "left")
    status = F.when(F.col("canonical").isNull(), "unmatched").when(F.col("name") == F.col("canonical"), "exact").when(F.col("edits") == 0, "strong_fuzzy").otherwise("fuzzy_review")
    return named.select("district_candidate_id", F.col("canonical").alias("matched_canonical_tif_district"), status.alias("district_match_status"), F.round("jaccard", 4).alias("jaccard"))

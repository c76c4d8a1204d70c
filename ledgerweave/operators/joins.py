"""Joins that a plain equi-join does not say: first match, as-of, windows of pages, containment, pairing, comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerweave.functions.text import norm_text
from ledgerweave.operators.rank import first_per_key


def first_match(left: DataFrame, right: DataFrame, keys: Sequence[str], order: Sequence[Column], flag: str = "matched") -> DataFrame:
    """Left join with the first right row of each key; empty keys match each other, ``flag`` is 0 or 1.

    The join is left to the optimizer: a right side known to be small is broadcast, else both are shuffled on the key.
    """
    once = first_per_key(right, keys, order).withColumn(flag, F.lit(1))
    return left.join(once, list(keys), "left").withColumn(flag, F.coalesce(flag, F.lit(0)))


def as_of_year(facts: DataFrame, intervals: DataFrame, key: str, year: str, start: str, end: str, repealed: str, area: str, order: str) -> DataFrame:
    """Each fact with the best interval of its key.

    Valid are intervals with start <= year <= end (null start is 0, null end is open). The best valid one has the greatest start, then area; if none
    is valid, the best of all is one not repealed, then of greatest start and area. Ties keep the first by ``order``. A fact
    without any interval stays with nulls; ``as_of`` says ``valid``, ``fallback`` or ``none``. Facts are made
    distinct on ``(key, year)`` before the join, so that its rows do not grow with repeated facts.
    """
    wanted = facts.select(key, year).distinct()
    cols = [c for c in intervals.columns if c != key]
    s, t = F.coalesce(start, F.lit(0)), F.coalesce(end, F.lit(9999))
    joined = wanted.join(intervals, key, "left")
    valid = F.coalesce(F.col(year).between(s, t), F.lit(False)).cast("int")
    live = (~F.coalesce(F.col(repealed), F.lit(False))).cast("int")
    rank = [F.desc("_valid"), F.desc("_live"), F.desc("_start"), F.desc("_area"), F.asc_nulls_last(order)]
    ranked = joined.withColumn("_valid", valid).withColumn("_live", F.when(valid == 1, 0).otherwise(live)).withColumn("_start", F.coalesce(start, F.lit(0))).withColumn("_area", F.coalesce(area, F.lit(0.0)))
    w = Window.partitionBy(key, year).orderBy(*rank)
    best = ranked.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
    as_of = F.when(F.col(order).isNull(), "none").when(F.col("_valid") == 1, "valid").otherwise("fallback")
    return facts.join(best.select(key, year, *cols, as_of.alias("as_of")), (facts[key].eqNullSafe(best[key])) & (facts[year].eqNullSafe(best[year])), "left").drop(best[key], best[year])


def window_text(windows: DataFrame, pages: DataFrame, keys: Sequence[str], start: str, end: str, page: str, text: str) -> DataFrame:
    """Text of the pages from start to end, in page order; pages that are missing are left out.

    The range becomes an equi-join on ``(keys, page)``.
    """
    spread = windows.filter(F.col(end) >= F.col(start)).withColumn(page, F.explode(F.sequence(start, end)))
    once = pages.select(*keys, page, text)
    parts = spread.join(once, [*keys, page], "left").groupBy(*windows.columns).agg(F.sort_array(F.collect_list(F.when(F.col(text).isNotNull(), F.struct(page, text)))).alias("_p"))
    return parts.withColumn("window_text", F.array_join(F.transform("_p", lambda p: p[text]), "\n")).drop("_p")


def phrase_hits(texts: DataFrame, phrases: DataFrame, text_key: str, text: str, phrase_key: str, phrase: str) -> DataFrame:
    """``(text_key, phrase_key, phrase)``: phrases that a text holds as whole words, in normal form.

    A theta join by nature; here the first two words of a phrase meet the word pairs of the texts in an equi-join,
    and the rest is checked with ``position``. Phrases of one word meet single words.
    """
    words = lambda c: F.split(norm_text(c), " ")
    normal = phrases.select(F.col(phrase_key).alias("_pk"), norm_text(F.col(phrase)).alias("_p")).filter("_p <> ''").distinct()
    normal = normal.withColumn("_w", F.split("_p", " ")).withColumn("_key", F.when(F.size("_w") > 1, F.concat_ws(" ", F.col("_w")[0], F.col("_w")[1])).otherwise(F.col("_w")[0]))
    keys = lambda w: F.array_distinct(F.array_compact(F.concat(w, F.transform(w, lambda x, i: F.when(i + 1 < F.size(w), F.concat_ws(" ", x, F.get(w, i + 1)))))))
    # only keys travel; the text comes back for the pairs that met
    met = texts.select(F.col(text_key).alias("_tk"), words(F.col(text)).alias("_w")).select("_tk", F.explode(keys(F.col("_w"))).alias("_key")).join(normal.select("_pk", "_p", "_key"), "_key").select("_tk", "_pk", "_p").distinct()
    body = texts.select(F.col(text_key).alias("_tk"), F.concat(F.lit(" "), norm_text(F.col(text)), F.lit(" ")).alias("_t"))
    return met.join(body, "_tk").filter(F.position(F.concat(F.lit(" "), "_p", F.lit(" ")), "_t") > 0).select(F.col("_tk").alias(text_key), F.col("_pk").alias(phrase_key), F.col("_p").alias("phrase")).distinct()


def longest_hit(hits: DataFrame, text_key: str, phrase_key: str) -> DataFrame:
    """Of each text the longest phrase it holds; the smallest key on ties."""
    return first_per_key(hits, [text_key], [F.desc(F.length("phrase")), F.asc(phrase_key), F.asc("phrase")])


def only_value(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``(key, name)`` of keys that have exactly one distinct value."""
    return df.filter(F.col(value).isNotNull()).groupBy(key).agg(F.min(value).alias(name), F.max(value).alias("_hi")).filter(F.col(name) == F.col("_hi")).drop("_hi")


def compare_outer(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Full outer comparison: both values and ``verdict`` same, differs, left_only or right_only."""
    a = left.select(*keys, F.col(value).alias("left_value"), F.lit(1).alias("_l"))
    b = right.select(*keys, F.col(value).alias("right_value"), F.lit(1).alias("_r"))
    verdict = F.when(F.col("_l").isNull(), "right_only").when(F.col("_r").isNull(), "left_only").when(F.col("left_value").eqNullSafe(F.col("right_value")), "same").otherwise("differs")
    return a.join(b, list(keys), "full_outer").withColumn("verdict", verdict).drop("_l", "_r")


def greedy_pairs(mentions: DataFrame, keys: Sequence[str], kind: str, first: str, second: str, position: str, tie: str, id_col: str) -> DataFrame:
    """Within each key, every mention of kind ``first``, in order of position, takes the unused one of kind ``second`` nearest to it.

    What is free depends on the choices before, so a group is folded in order: its two kinds are two sorted arrays, and one
    ``aggregate`` takes from the free ones. Groups are mentions of one metric in one document.
    """
    rows = mentions.filter(F.col(kind).isin(first, second) & F.col(position).isNotNull())
    item = F.struct(F.col(position).cast("long").alias("at"), F.col(tie).alias("tie"), F.col(id_col).alias("id"))
    of = lambda k: F.array_sort(F.collect_list(F.when(F.col(kind) == k, item)))
    sides = rows.groupBy(*keys).agg(of(first).alias("_a"), of(second).alias("_b")).filter((F.size("_a") > 0) & (F.size("_b") > 0))
    id_type = dict(mentions.dtypes)[id_col]
    start = F.struct(F.col("_b").alias("free"), F.array().cast(f"array<struct<first_id:{id_type},second_id:{id_type},distance:bigint>>").alias("out"))

    def take(acc: Column, x: Column) -> Column:
        best = F.array_min(F.transform(acc["free"], lambda f, i: F.struct(F.abs(f["at"] - x["at"]).alias("d"), i.alias("i"), f["id"].alias("id"))))
        pair = F.struct(x["id"].alias("first_id"), best["id"].alias("second_id"), best["d"].alias("distance"))
        return F.when(F.size(acc["free"]) == 0, acc).otherwise(F.struct(F.filter(acc["free"], lambda f, i: i != best["i"]).alias("free"), F.concat(acc["out"], F.array(pair)).alias("out")))

    return sides.select(*keys, F.explode(F.aggregate("_a", start, take, lambda acc: acc["out"])).alias("_x")).select(*keys, "_x.*")


#: Most keys that can be hot at once.
HOT_KEYS = 10_000


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], rows: int = 20_000) -> DataFrame:
    """Inner join where no task gets much more than ``rows`` left rows of one key.

    A hot key is cut into parts, and its right rows go to each part. Keys with more than ``rows`` left rows, and more than one in ``HOT_KEYS`` of all left
    rows, are hot; so there are at most ``HOT_KEYS`` of them, and their list is sent to all tasks.
    """
    keyed = left.filter(" and ".join(f"`{k}` is not null" for k in keys))
    counts = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    most = max(rows, total // HOT_KEYS)
    if total <= most:
        return keyed.join(right, list(keys))
    hot = F.broadcast(counts.filter(F.col("_n") > most).select(*keys, F.ceil(F.col("_n") / most).cast("int").alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1))
    a = keyed.join(hot, list(keys), "left").withColumn("_salt", F.pmod(F.xxhash64(*left.columns), parts).cast("int")).drop("_parts")
    b = right.join(hot, list(keys), "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return a.join(b, [*keys, "_salt"]).drop("_salt")

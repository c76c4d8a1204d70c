"""Noise in text from scanned pages (problem 2).

Running headers are learnt as lines that recur at page edges, and cut out with page numbers (``scan_lines``). Words split at a line end are
put together as the corpus writes them: run together or with a hyphen, whichever is the more frequent word. Misread
words are found by anagram hashing: a misreading changes a word's anagram number by a difference that
depends on the letters changed only, so rare words are joined in SQL with frequent words whose numbers lie such differences away; the join's pairs are verified
letter by letter and ranked by number of misreadings, then frequency.

Defined cases: null and empty texts have no noise and stay as they are; texts of any length are handled
whole; an odd word that no known word explains is read sign by sign; repeated rows are handled alike;
empty tables give an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerweave.llm.scan_lines import bare, header_anchors, run_together, scanned, token_counts, tokens_but, with_hyphens
from ledgerweave.llm.scan_marks import anagram, misreadings, number_of, odd, parts, plain, suspect, targets
from ledgerweave.session import cut

#: A word that is right is at least so many times as frequent as its misreading.
RATIO = 2
#: Least count of a word in the corpus that may stand for a misread one which holds no odd sign.
KNOWN = 2

_S, _B = T.StringType(), T.BooleanType()
_SUBWORD = T.StructType([T.StructField("odd", _B), T.StructField("suspect", _B), T.StructField("number", T.LongType()), T.StructField("targets", T.ArrayType(T.LongType()))])


@F.pandas_udf(_SUBWORD)
def _anagrams(words: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in words:
        rows = [(odd(w), suspect(w), anagram(w), targets(w) if suspect(w) else []) for w in batch]
        yield pd.DataFrame(rows, columns=["odd", "suspect", "number", "targets"])


@F.pandas_udf(T.IntegerType())
def _misreadings(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for read, printed in batches:
        yield pd.Series([misreadings(a, b) for a, b in zip(read, printed, strict=True)], dtype="Int32")


@F.pandas_udf(T.ArrayType(_S))
def _parts(words: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in words:
        yield pd.Series([parts(w) for w in batch], dtype=object)


@F.pandas_udf(_S)
def _plain(words: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in words:
        yield batch.map(plain).astype(object)


@F.pandas_udf(_S)
def _number(words: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in words:
        yield pd.Series([number_of(w) for w in batch], dtype=object)


@F.pandas_udf(_S)
def _rebuilt(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """The word with its misread parts replaced."""
    for words, reads, prints in batches:
        out = []
        for word, read, printed in zip(words, reads, prints, strict=True):
            known = dict(zip(read, printed, strict=True))
            pieces, at = [], 0
            for part in parts(word):
                i = word.index(part, at)
                pieces += [word[at:i], known.get(part, part)]
                at = i + len(part)
            out.append("".join(pieces) + word[at:])
        yield pd.Series(out, dtype=object)


def corrections(words: DataFrame) -> DataFrame:
    """``(word, printed)`` of misread words; input ``(word, n, whole)``: distinct words, their counts, and how often they stand unsplit.

    Words are corrected part by part, a part being what stands between hyphens and slashes.
    """
    numbers = words.select("word", _number("word").alias("printed")).filter("printed is not null and printed <> word")
    pieces = cut(words.join(numbers, "word", "left_anti").select("word", "whole", F.explode(_parts("word")).alias("part")))
    counted = pieces.groupBy("part").agg(F.sum("whole").alias("n")).withColumn("a", _anagrams("part"))
    counted = cut(counted.select("part", "n", F.col("a.odd").alias("odd"), F.col("a.suspect").alias("suspect"), F.col("a.number").alias("number"), F.col("a.targets").alias("targets")))
    rare = counted.filter("suspect").select(F.col("part").alias("read"), F.col("n").alias("rn"), "odd", F.explode("targets").alias("number"))
    known = counted.filter("not odd").select(F.col("part").alias("printed"), F.col("n").alias("pn"), "number").filter("pn > 0")
    near = rare.join(known, "number").filter(F.col("odd") | ((F.col("pn") >= KNOWN) & (F.col("pn") >= RATIO * F.col("rn")))).withColumn("k", _misreadings("read", "printed")).filter("k > 0")
    best = near.groupBy("read").agg(F.min_by("printed", F.struct("k", -F.col("pn"), "printed")).alias("printed"))
    unexplained = counted.filter("odd").select(F.col("part").alias("read")).join(best, "read", "left_anti").withColumn("printed", _plain("read"))
    # a word that a correction leads to may itself be a misreading of a far more frequent one
    found = best.unionByName(unexplained).filter("read <> printed")
    found = cut(found)
    onward = found.alias("x").join(found.alias("y"), F.col("x.printed") == F.col("y.read"), "left").select(F.col("x.read").alias("part"), F.coalesce("y.printed", "x.printed").alias("printed"))
    changed = pieces.select("word", "part").distinct().join(onward, "part").groupBy("word").agg(F.collect_list("part").alias("read"), F.collect_list("printed").alias("prints"))
    return changed.select("word", _rebuilt("word", "read", "prints").alias("printed")).unionByName(numbers)


def lexicon(df: DataFrame, text: str) -> DataFrame:
    """``(word, whole)``: words of texts that were not scanned, with their counts; they support words of the scanned ones."""
    bare = lambda w: F.regexp_replace(w, r"^[^a-z0-9$]+|[^a-z0-9]+$", "")
    return df.select(F.explode(F.transform(F.split(F.lower(text), r"\s+"), bare)).alias("word")).filter("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("whole"))


def decisions(scans: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``(token, n, printed, hyphen, glyph)`` of all tokens; ``printed`` is the word as it should read where that is not as it stands.

    ``known`` are words with counts from elsewhere (``lexicon``). All work is on distinct tokens and words.
    """
    read = token_counts(scans).select("token", "n", bare(run_together(F.col("token"))).alias("word"), bare(with_hyphens(F.col("token"))).alias("split"))
    read = cut(read.filter("word <> ''"))
    whole = read.filter("split = ''").groupBy("word").agg(F.sum("n").alias("whole"))
    if known is not None:
        whole = whole.unionByName(known).groupBy("word").agg(F.sum("whole").alias("whole"))
    whole = cut(whole)
    # a split word is written as the corpus writes it unsplit: with a hyphen if that is the more frequent word
    choice = cut(
        read.filter("split <> ''")
        .select("token", "word", "split")
        .join(whole.withColumnRenamed("whole", "run"), "word", "left")
        .join(whole.select(F.col("word").alias("split"), F.col("whole").alias("hyphened")), "split", "left")
        .select("token", "split", F.when(F.coalesce("hyphened", F.lit(0)) > F.coalesce("run", F.lit(0)), F.col("split")).otherwise(F.col("word")).alias("as"))
    )
    words = whole.select("word", "whole").unionByName(choice.select(F.col("as").alias("word"), F.lit(0).cast("long").alias("whole"))).groupBy("word").agg(F.sum("whole").alias("whole"))
    fixed = cut(corrections(words))
    every = read.select("token", "n", "word", "split").join(choice.select("token", "as"), "token", "left").withColumn("as", F.coalesce("as", "word"))
    joined = every.join(fixed.select(F.col("word").alias("as"), "printed"), "as", "left")
    split = F.col("split") != ""
    return cut(joined.select("token", "n", F.when(split | F.col("printed").isNotNull(), F.coalesce("printed", "as")).alias("printed"), split.alias("hyphen"), F.col("printed").isNotNull().alias("glyph")))


#: The most frequent tokens that stand as they should, which are left out of the tokens before the join.
CLEAN = 50_000


def _decided(scans: DataFrame, known: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Tokens of rows that may be decided on, and the decisions; the tokens left out are decided to stand."""
    every = decisions(scans, known)
    clean = [r.token for r in every.filter("printed is null").orderBy(F.desc("n"), "token").limit(CLEAN).select("token").collect()]
    return tokens_but(scans, clean), every.filter("printed is not null and printed <> ''").drop("n")


#: Decisions of up to so many bytes are sent to all tasks; more are joined by shuffling the tokens.
SENT = 64_000_000


def _sent(decided: DataFrame) -> DataFrame:
    size = decided.agg(F.coalesce(F.sum(F.octet_length("token") + F.octet_length("printed") + 64), F.lit(0))).first()[0]
    return F.broadcast(decided) if size <= SENT else decided


def noise(rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``(tbl, row_id, noise, word)``, distinct, of rows ``(tbl, row_id, text)``."""
    scans = cut(scanned(rows, header_anchors(rows)))
    kinds = F.array_compact(F.array(F.when(F.col("header"), F.lit("header")), F.when(F.col("page"), F.lit("page"))))
    lines = scans.select("tbl", "row_id", F.explode(kinds).alias("noise"), F.lit("").alias("word"))
    marks = F.array_compact(F.array(F.when(F.col("hyphen"), F.lit("hyphen")), F.when(F.col("glyph"), F.lit("glyph"))))
    tokens, decided = _decided(scans, known)
    words = tokens.join(_sent(decided), "token").select("tbl", "row_id", F.explode(marks).alias("noise"), F.col("printed").alias("word"))
    return lines.unionByName(words).distinct()


@F.pandas_udf(_S)
def _written(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """The corrected word in the letter case and between the punctuation of the token as read."""
    for raws, words in batches:
        out = []
        for raw, word in zip(raws, words, strict=True):
            body = raw.strip(".,;:!?()[]{}\"'“”‘’*")
            at = raw.find(body) if body else 0
            shape = word.upper() if body.isupper() and len(body) > 1 else "-".join(p[:1].upper() + p[1:] if q[:1].isupper() else p for p, q in zip(word.split("-"), (body.split("-") + [""] * 9), strict=False))
            out.append(raw[:at] + shape + raw[at + len(body) :] if body else raw)
        yield pd.Series(out, dtype=object)


def repaired(rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``(tbl, row_id, text)`` of every row: one continuous paragraph, null where the text is null.

    Only tokens that may change travel; what changes is put back into the texts.
    """
    scans = cut(scanned(rows, header_anchors(rows)))
    tokens, decided = _decided(scans, known)
    written = cut(decided.select("token", _written(run_together(F.col("token")), "printed").alias("printed")))
    fixes = tokens.join(_sent(written), "token").groupBy("tbl", "row_id").agg(F.map_from_entries(F.collect_list(F.struct("token", "printed"))).alias("fix"))
    paragraph = F.array_join(F.transform(F.split("body", " "), lambda t: F.coalesce(F.col("fix")[t], run_together(t))), " ")
    blank = rows.select("tbl", "row_id", F.col("text").isNull().alias("none")).filter("none")
    return scans.join(fixes, ["tbl", "row_id"], "left").join(blank, ["tbl", "row_id"], "left").select("tbl", "row_id", F.when(F.col("none").isNull(), paragraph).alias("text"))


def scanned_rows(legacy: DataFrame, audit: DataFrame, mentions: DataFrame) -> DataFrame:
    """The three tables' scanned columns as ``(tbl, row_id, text)``."""
    pick = lambda d, tbl, key, text: d.select(F.lit(tbl).alias("tbl"), F.col(key).alias("row_id"), F.col(text).alias("text"))
    return (
        pick(legacy, "tif_legacy_annual_report_projects_2010_2016", "legacy_row_id", "project_name")
        .unionByName(pick(audit, "tif_legacy_pdf_project_audit_sample", "audit_row_id", "source_line"))
        .unionByName(pick(mentions, "tif_pdf_projected_realized_mentions", "mention_id", "snippet"))
    )

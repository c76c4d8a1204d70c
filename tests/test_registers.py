"""Operators of registers, proceedings and reports on rows made by hand, and against plain Python."""

import random
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from ledgerweave.functions import text
from ledgerweave.operators import joins, journal, match, reports, textmine, universe
from ledgerweave.plans.registers import _DROP, _PHRASES, _STOP


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_amounts_of_the_specification(spark):
    df = spark.createDataFrame([(1, "$(1,200) kept"), (2, "$5 may"), (3, "$5 bn and 3 yrs"), (4, "7 million"), (5, None)], "id int, t string")
    assert rows(textmine.mentions(df, ["id"], "t", textmine.MONEY, "cost").select("id", "value_raw", "value_numeric", "at")) == [(1, "$(1,200) k", 1.2e6, 0), (2, "$5 m", 5e6, 0), (3, "$5 bn", 5e9, 0), (4, "7 million", 7e6, 0)]
    assert rows(textmine.mentions(df, ["id"], "t", textmine.DURATION, "time").select("id", "value_raw", "value_numeric")) == [(3, "3 yrs", 36.0)]


def test_nearest_keyword_counts_from_beginning_to_beginning(spark):
    df = spark.createDataFrame([(1, "actual cost: $1,234,567.00 planned"), (2, "budgeted $5, then spent")], "id int, t string")
    found = textmine.mentions(df, ["id", "t"], "t", textmine.MONEY, "cost")
    groups = {"projected": textmine.PROJECTED, "realized": textmine.REALIZED}
    assert rows(textmine.nearest_label(found, "t", "at", groups, "label").select("id", "label")) == [(1, "realized"), (2, "projected")]
    assert rows(textmine.nearest_word(found, "t", "at", (*textmine.PROJECTED, *textmine.REALIZED), "word").select("id", "word")) == [(1, "actual"), (2, "budget")]


def test_greedy_pairs_against_plain_python(spark):
    rng = random.Random(2)
    data = [(i, rng.choice("ab"), rng.choice(["p", "r", "x"]), rng.choice([None, *range(1, 9)]), rng.choice("stu")) for i in range(80)]
    want = []
    for key in "ab":
        side = lambda kind: sorted((r for r in data if r[1] == key and r[2] == kind and r[3] is not None), key=lambda r: (r[3], r[4], r[0]))  # noqa: B023, E731
        free = side("r")
        for p in side("p"):
            if free:
                best = min(free, key=lambda r: abs(r[3] - p[3]))  # noqa: B023
                free.remove(best)
                want.append((key, p[0], best[0], abs(best[3] - p[3])))
    df = spark.createDataFrame(data, "id int, k string, kind string, page int, tie string")
    assert rows(joins.greedy_pairs(df, ["k"], "kind", "p", "r", "page", "tie", "id")) == sorted(want, key=str)
    assert joins.greedy_pairs(df.limit(0), ["k"], "kind", "p", "r", "page", "tie", "id").count() == 0


def test_salted_join_is_a_join(spark):
    left = spark.createDataFrame([("hot", i) for i in range(50)] + [("cold", 1), (None, 2)], "k string, v int")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("cold", 3), ("none", 4)], "k string, w int")
    assert rows(joins.salted_join(left, right, ["k"], 7)) == rows(left.join(right, ["k"]))


REPORT = """FY 2014 TIF Name: Elm
Project 1: Elm Lofts Project is Ongoing
Private Investment Undertaken $5
Project 2:
Oak Hotel
Proiect Ongoing
Project 3: See Instructions
Project 4: Ash Library completed project
Project 5: Fir Yard
Ratio of Private/Public Investment
Project 5: FIR yard
General Notes Project 6: Not read"""


def test_project_rows(spark):
    data = [(1, REPORT), (2, "SECTION 5\nBirch Park Project is Completed.\nTotal 3\nPine Court project ongoing"), (3, "No Projects Were Undertaken"), (4, None), (5, "")]
    got = rows(reports.project_rows(spark.createDataFrame(data, "id int, t string"), ["id"], "t"))
    assert got == [
        (1, 1, "Elm Lofts", "Active Project"), (1, 2, "Oak Hotel", "Active Project"), (1, 4, "Ash Library", "Completed Project"), (1, 5, "Fir Yard", "Unknown"),
        (2, 1, "Birch Park", "Completed Project"), (2, 2, "Pine Court", "Active Project"),
    ]


def test_section_windows_stop(spark):
    texts = ["intro", "SECTION 5 x", "Project 2: y", "Project 3: CERTIFICATION", "Project 4: z"]
    df = spark.createDataFrame([("a", i + 1, t) for i, t in enumerate(texts)] + [("b", 1, "SECTION 5"), ("b", 2, "other"), ("b", 3, "Project 9: no")], "d string, p int, t string")
    got = reports.section_window(df, ["d"], "p", "t", "(?i)section 5", "CERTIFICATION", r"Project \d", 9)
    assert rows(got.select("d", "p")) == [("a", 2), ("a", 3), ("b", 1), ("b", 2)]


def test_place_names(spark):
    rules = dict(heads=("the|a|an", "for|within"), tails=(r"tax\s+increment",), stop=("city",), bad="(?i)journal")
    cases = {"  the Elm/Oak Tax Increment area": "Elm/Oak", "within the city": None, "for Elm": None, "35th/Elm": "35th/Elm", "THE JOURNAL of": None, "some lower case words": None, "Elmhurst": "Elmhurst", "": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "x string")
    assert {r.x: r.n for r in df.select("x", journal.place_name(F.col("x"), **rules).alias("n")).collect()} == cases
    lines = spark.createDataFrame([("no\nplan for the Elm/Oak\nTax Increment area\nlast",), (None,)], "t string")
    assert [r[0] for r in lines.select(journal.place_names(F.col("t"), "(?i)plan", (r"for ([A-Za-z/ ]+?) Tax",), **rules)).collect()] == [["Elm/Oak"], []]


def test_funding_and_context(spark):
    df = spark.createDataFrame([("not to exceed $2 million; fee $9,000,000", 2e6), ("a grant of $300", 300.0), ("$5", None), (None, None)], "t string, v double")
    assert all(r[0] == r[1] for r in df.select(journal.funding(F.col("t"), r"not\s+to\s+exceed", "(?i)grant", 12), "v").collect())
    got = spark.createDataFrame([("x" * 9 + " bonds " + "y" * 9,), ("none",), (None,)], "t string").select(journal.context(F.col("t"), ("absent", "bonds"), 4))
    assert [r[0] for r in got.collect()] == ["... xxx bonds yyy ...", "", None]


def test_ladder_against_plain_python(spark):
    rng = random.Random(8)
    words = ["elm", "oak", "river", "street", "west", "tif", "district", "35th", "harbor", "north"]
    listed = [(f"T-{i:03d}", " ".join(rng.sample(words, rng.choice([1, 2, 3]))), int(rng.random() < 0.4)) for i in range(25)]
    names = ["".join(c for c in " ".join(rng.sample(words, rng.choice([1, 2, 3, 4]))) if rng.random() > 0.05) for _ in range(60)] + ["", "TIF District"]
    loose_drop = (*_DROP, "street")
    cut = lambda s, drop: " ".join(w for w in "".join(c if c.isalnum() else " " for c in s.lower()).split() if w not in drop)

    def best(name):
        key, lo, top = cut(name, _DROP), cut(name, loose_drop), -1.0
        if not key:
            return None
        for _, x, canonical in listed:
            k, kl = cut(x, _DROP), cut(x, loose_drop)
            if not k:
                continue
            a, b = set(key.split()), set(k.split())
            inside = len(a) > 1 and len(b) > 1 and (f" {key} " in f" {k} " or f" {k} " in f" {key} ")
            score = (1.02 if canonical else 1.0) if key == k else 0.93 if inside else max(SequenceMatcher(None, key, k).ratio(), len(a & b) / len(a | b))
            if lo and lo == kl and (len(lo.split()) > 1 or any(c.isdigit() for c in lo)):
                score = max(score, 0.99 if canonical else 0.98)
            top = max(top, score)
        return round(top, 3)

    df = spark.createDataFrame([(n,) for n in dict.fromkeys(names)], "name string")
    got = match.full_ladder(df, spark.createDataFrame(listed, "entry string, listed string, canonical int"), _DROP, loose_drop).collect()
    assert {r.name: r.score for r in got} == {n: best(n) for n in names}
    assert all((r.entry is None) == (r.status == "unmatched") for r in got)
    assert {r.status for r in match.full_ladder(df, spark.createDataFrame([], "entry string, listed string, canonical int"), _DROP, loose_drop).collect()} == {"unmatched"}


def test_entity_match_against_difflib(spark):
    forms = lambda df, c, n, s: df.withColumn(n, text.norm_text(F.col(c))).withColumn(s, text.simplified(F.col(c), _PHRASES, _STOP))
    annual = [("T-1", x) for x in ("Elm Lofts", "Elm Lofts Project LLC", "Oak Hotel Phase", "Ash Librari", "Zzz", "Stated", "Garden Homes")]
    listed = [("T-1", "Elm Lofts", None, 5), ("T-1", "Oak Hotel Agreement", None, 6), ("T-1", "Ash Library", None, 7), ("T-2", "Zzz", None, 8), ("T-1", "Nothing", "Garden Homes Inc", 9)]
    a = forms(spark.createDataFrame(annual, "t string, name string"), "name", "p", "s")
    b = forms(forms(spark.createDataFrame(listed, "t string, x string, y string, target int"), "x", "p", "s"), "y", "q", "d")
    o = spark.createDataFrame([("T-1", "stated", 99)], "t string, p string, target int")
    got = {r.p: (r.target, r.match_status, r.score, r.project_id) for r in match.entity_match(a, o, b, 0.82).collect()}
    like = round(SequenceMatcher(None, "ash librari", "ash library").ratio(), 4)
    assert got == {
        "elm lofts": (5, "exact", None, "master_5"), "elm lofts project llc": (5, "normalized", None, "master_5"), "oak hotel phase": (6, "normalized", None, "master_6"), "ash librari": (7, "fuzzy_review", like, "master_7"),
        "zzz": (None, "unmatched", None, "proj_T-1_zzz"), "stated": (99, "manual_override", None, "master_99"), "garden homes": (9, "normalized", None, "master_9"),
    }


def test_small_column_functions(spark):
    df = spark.createDataFrame([(" pro'ect • A | b\rc", "x/T_012_ElmOakAR14.pdf", "ward07@h.example 2015", " ", "y")], "a string, b string, c string, d string, e string")
    got = df.select(
        text.repaired(F.col("a")), text.clean_name(F.lit(" -A *  b:")), text.spaced_stem(F.col("b")), text.ward_of_email(F.col("c")), text.report_year(F.col("c")), text.first_filled(F.col("d"), F.col("e")), text.clean_space(F.lit("a  \n b")),
        text.norm_scanned(F.lit("The Proiect Companj")), text.without_status(F.lit("Elm Lofts Project is Ongoing"), r"Project\s+is|Ongoing"), universe.notes(F.lit("a"), F.lit(" "), F.lit(None).cast("string"), F.lit("b")),
    ).first()
    assert tuple(got) == (" project   A   b\nc", "A b", "Elm Oak", 7, 2015, "y", "a b", "the project company", "Elm Lofts", "a | b")


def test_queue_reasons(spark):
    df = spark.createDataFrame([(1, True, 0), (2, False, 5), (3, None, None)], "id int, gap boolean, n int")
    got = universe.gaps(df, {"gap": F.col("gap"), "many": F.col("n") > 3}, "complete", [(F.col("gap"), "high"), (F.col("n") > 3, "medium")], "low")
    assert rows(got.select("id", "reasons", "priority")) == [(1, "gap", "high"), (2, "many", "medium"), (3, "complete", "low")]
    terms = spark.range(1).select(universe.search_terms([F.lit("School"), F.lit(None).cast("string"), F.lit("Elm Lofts"), F.lit("Elm Lofts"), F.lit("1234567")], ("school",))).first()[0]
    assert terms == ["Elm Lofts"]

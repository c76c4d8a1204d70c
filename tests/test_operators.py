"""Operators on small tables, against plain Python where that is shorter than the expected rows."""

import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerweave.operators import aggregate, intervals, joins, match, rank, state, textmine
from ledgerweave.operators.components import connected_components


def rows(df, *order):
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_intervals_merge_touch_nest_and_gap(spark):
    data = [(1, "2000-01-01", "2000-02-01"), (1, "2000-02-01", "2000-03-01"), (1, "2000-01-10", "2000-01-20"), (1, "2000-05-01", "2000-06-01"), (2, "2001-01-01", "2001-01-01"), (3, None, "2001-01-01"), (None, "2001-01-01", "2002-01-01")]
    df = spark.createDataFrame(data + data, "e int, s string, t string").withColumn("kind", F.lit("clash"))
    got = rows(intervals.merge_intervals(df, "e", F.col("s"), F.col("t")))
    d = dt.date
    assert got == sorted([(1, "period", d(2000, 1, 1), d(2000, 3, 1)), (1, "gap", d(2000, 3, 1), d(2000, 5, 1)), (1, "period", d(2000, 5, 1), d(2000, 6, 1))], key=str)
    assert intervals.merge_intervals(df.limit(0), "e", F.col("s"), F.col("t")).count() == 0


def test_intervals_against_brute_force(spark):
    rng = random.Random(3)
    data = [(rng.randint(1, 5), rng.randint(0, 60), 0) for _ in range(120)]
    data = [(e, s, s + rng.randint(1, 5)) for e, s, _ in data]
    day = dt.date(2000, 1, 1)
    df = spark.createDataFrame([(e, day + dt.timedelta(s), day + dt.timedelta(t)) for e, s, t in data], "e int, s date, t date")
    got = {(r.e, (r.start_d - day).days, (r.end_d - day).days) for r in intervals.merge_intervals(df, "e", F.col("s"), F.col("t")).collect() if r.kind == "period"}
    want = set()
    for e in {x[0] for x in data}:
        days = sorted({d for x, s, t in data if x == e for d in range(s, t)})
        start = prev = None
        for d in days:
            if prev is None or d != prev + 1:
                if start is not None:
                    want.add((e, start, prev + 1))
                start = d
            prev = d
        want.add((e, start, prev + 1))
    assert got == want


def test_text_dates_of_tracts(spark):
    df = spark.createDataFrame([(1, "1/2/2000", "n.d.", "2001-01-01", "x"), (1, "20010101", "pending", "", "x"), (2, "2000-02-30", None, None, "x")], "tract_id int, approval_d string, repealed_d string, expiration string, kind string")
    assert rows(intervals.tract_intervals(df)) == [(1, "period", "2000-01-02", "9999-12-31")]


def test_page_clusters(spark):
    df = spark.createDataFrame([("a", p) for p in (1, 2, 5, 9, 9)] + [("a", None)], "doc string, page int")
    assert rows(rank.clusters(df, ["doc"], "page", pad=1).select("cluster_start", "cluster_end", "hits")) == [(1, 6, 3), (8, 10, 1)]


def test_as_of(spark):
    iv = spark.createDataFrame([("a", 1, 1990, 2000, False, 1.0), ("a", 2, 1995, None, False, 1.0), ("a", 3, 1995, None, False, 2.0), ("b", 4, 2010, None, True, 9.0), ("b", 5, 2005, 2006, False, 1.0)], "k string, id int, s int, t int, dead boolean, area double")
    facts = spark.createDataFrame([("a", 1992), ("a", 1999), ("b", 1980), ("b", None), ("c", 2000)], "k string, y int")
    got = {(r.k, r.y): (r.id, r.as_of) for r in joins.as_of_year(facts, iv, "k", "y", "s", "t", "dead", "area", "id").collect()}
    assert got == {("a", 1992): (1, "valid"), ("a", 1999): (3, "valid"), ("b", 1980): (5, "fallback"), ("b", None): (5, "fallback"), ("c", 2000): (None, "none")}


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (102, 101), (7, 7), (None, 3), (100, 101)]
    df = spark.createDataFrame(edges, "a int, b int")
    got = dict(tuple(r) for r in connected_components(df).collect())
    assert {got[i] for i in range(1, 41)} == {1} and {got[i] for i in (100, 101, 102)} == {100} and len(got) == 43
    assert connected_components(df.limit(0)).count() == 0


def test_phrase_hits_are_whole_words(spark):
    texts = spark.createDataFrame([(1, "The North-Side park; north"), (2, "Northside"), (3, None)], "id int, t string")
    phrases = spark.createDataFrame([("p", "north side park"), ("q", "north"), ("r", "")], "k string, n string")
    hits = joins.phrase_hits(texts, phrases, "id", "t", "k", "n")
    assert rows(hits.select("id", "k")) == [(1, "p"), (1, "q")]
    assert rows(joins.longest_hit(hits, "id", "k").select("id", "k")) == [(1, "p")]


def test_greedy_pairs(spark):
    df = spark.createDataFrame([("d", "p", 1, 5, "a"), ("d", "p", 2, 6, "b"), ("d", "r", 3, 6, "c"), ("d", "r", 4, 9, "d"), ("e", "p", 5, 1, "x")], "doc string, kind string, id int, page int, tie string")
    assert rows(joins.greedy_pairs(df, ["doc"], "kind", "p", "r", "page", "tie", "id")) == [("d", 1, 3, 1), ("d", 2, 4, 3)]


def test_append_unique_is_idempotent(spark):
    stored = spark.createDataFrame([("a", 1)], "k string, v int")
    batch = spark.createDataFrame([("a", 2), (" b", 3), ("b ", 4), ("", 5), (None, 6)], "k string, v int")
    once = state.append_unique(stored, batch, ["k"], [F.asc("v")])
    assert rows(once) == [(" b", 3), ("a", 1)]
    assert rows(state.append_unique(once, batch, ["k"], [F.asc("v")])) == rows(once)


def test_upsert_and_review(spark):
    stored = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, w string")
    change = spark.createDataFrame([("b", None, "z"), ("c", 3, "q")], "k string, v int, w string")
    out = state.upsert(stored, change, ["k"])
    assert rows(out) == [("a", 1, "x"), ("b", 2, "z"), ("c", 3, "q")]
    assert rows(state.upsert(out, change, ["k"])) == rows(out)
    reviewed = spark.createDataFrame([("1", "confirmed", "mine"), ("2", "needs_review", "old"), ("9", "rejected", "gone")], "id string, st string, t string")
    fresh = spark.createDataFrame([("1", "needs_review", "new"), ("2", "needs_review", "new"), ("3", "needs_review", "new")], "id string, st string, t string")
    assert rows(state.keep_reviewed(fresh, reviewed, "id", "st")) == [("1", "confirmed", "mine"), ("2", "needs_review", "new"), ("3", "needs_review", "new"), ("9", "rejected", "gone")]


def test_expand_years_never_counts_down(spark):
    df = spark.createDataFrame([("a", 1992, 1990), ("b", 2026, None), ("c", None, 2000)], "k string, s int, t int")
    assert rows(aggregate.expand_years(df, "s", "t", 1981, 2027).select("k", "year")) == [("b", 2026), ("b", 2027)]


def test_vote_and_roll_up(spark):
    votes = spark.createDataFrame([(1, "A B", 2, 1), (1, "a-b", 2, 2), (1, "Cdef", 3, 3)], "k int, name string, w int, o int").withColumn("form", F.lower(F.regexp_replace("name", "[^A-Za-z]+", " ")))
    assert rows(aggregate.weighted_vote(votes, "k", "form", "name", "w", [F.asc("o")])) == [(1, "A B", 4, 2)]


def test_mentions_and_nearest_keyword(spark):
    df = spark.createDataFrame([(1, "Estimated $5 million in all, so they say; the actual spending reached $300,000."), (2, "No amount"), (3, None), (4, "$7 alone")], "id int, t string")
    found = textmine.mentions(df, ["id", "t"], "t", textmine.MONEY, "cost")
    labelled = textmine.nearest_label(found, "t", "at", {"projected": textmine.PROJECTED, "realized": textmine.REALIZED}, "label")
    assert rows(labelled.select("id", "value_numeric", "label")) == [(1, 300000.0, "realized"), (1, 5e6, "projected"), (4, 7.0, None)]


def test_tiers(spark):
    left = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "", ""), (4, "z", "z")], "id int, k1 string, k2 string")
    first = spark.createDataFrame([("a", 10), ("a", 9), ("", 7)], "k1 string, v int")
    second = spark.createDataFrame([("x", 20), ("y", 21)], "k2 string, v int")
    got = match.tiered_match(left, [("one", first, ["k1"]), ("two", second, ["k2"])], [F.asc("v")], "v")
    assert rows(got.select("id", "v", "match_status")) == [(1, 9, "one"), (2, 21, "two"), (3, None, "unmatched"), (4, None, "unmatched")]


def test_fuzzy_pruning_changes_nothing(spark):
    words = ["industrial park", "industrial pk", "senior homes", "sr homes", "parking structure", "x"]
    left = spark.createDataFrame([(w, "b", w) for w in words], "id string, block string, a string")
    right = spark.createDataFrame([(w[::-1] if i % 2 else w, "b", w) for i, w in enumerate(words)], "rid string, block string, b string")
    pruned = match.best_fuzzy(left, right, ["block"], "id", [("a", "b")], "rid", 0.82)
    full = match.best_fuzzy(left, right, ["block"], "id", [("a", "b")], "rid", 0.82, suggest=True).filter("accepted")
    assert rows(pruned) == rows(full)


def test_project_blocks(spark):
    df = spark.createDataFrame([(1, "Intro Project 1: Alpha\nBeta Project 12: Gamma"), (2, "none"), (3, None)], "id int, t string")
    assert rows(textmine.project_blocks(df, ["id"], "t")) == [(1, 1, "Alpha Beta"), (1, 12, "Gamma")]


def test_window_text_skips_missing_pages(spark):
    windows = spark.createDataFrame([("d", 1, 3), ("d", 9, 8)], "doc string, s int, t int")
    pages = spark.createDataFrame([("d", 3, "c"), ("d", 1, "a")], "doc string, page int, txt string")
    assert [r.window_text for r in joins.window_text(windows, pages, ["doc"], "s", "t", "page", "txt").collect()] == ["a\nc"]


def test_roster_carries_the_ward(spark):
    text = ["=== 1st Ward ===", "* Smith, [[John Smith|John]]", '!scope="row"|Ann Lee Jr.', "note", "=== 22nd Ward ===", "* Ann Lee"]
    df = spark.createDataFrame(list(enumerate(text)), "pos int, line string")
    assert rows(textmine.roster(df, "pos", "line")) == [(1, "ann lee"), (1, "john smith"), (22, "ann lee")]


def test_anchor_blocks_stop(spark):
    df = spark.createDataFrame([("d", i, s) for i, s in enumerate(["x", "A one", "two", "three", "four", "A five", "stop", "six"])], "k string, pos int, line string")
    assert rows(textmine.anchor_blocks(df, ["k"], "pos", "line", "^A", "^stop", 3)) == [("d", 1, "A one two three"), ("d", 2, "A five")]

import random

import pytest

from pyspark.sql import functions as F

from ledgerweave.llm import scan_lines, scan_noise
from ledgerweave.llm.scan_marks import anagram, misreadings, number_of, targets

MENTION = "tif_pdf_projected_realized_mentions"


#: As ``header_anchors`` finds them: a line that never varies, one with a varying end, one with a varying beginning.
ANCHORS = [(True, "# REPORTS OF", "# REPORTS OF COMMITTEES", "# REPORTS OF COMMITTEES", 4), (True, "SECTION #", "SECTION #", "SECTION #", 2), (True, "FY # TIF", "FY # TIF Name: Ash Road", "FY # TIF Name: Zed", 6), (False, "REDEVELOPMENT PROJECT AREA", "A REDEVELOPMENT PROJECT AREA", "Z EAST REDEVELOPMENT PROJECT AREA", 5)]


def test_edge_lines():
    cases = [
        ("a\n2013 REPORTS OF COMMITTEES\nb", True, False), ("a\n141   SECTION 7\nb", True, True), ("a\nSECTION 7   141\nb", True, True), ("a\nP a g e | 12\nb", False, True), ("a\r\n19\r\nb", False, True), ("plain 19 text", False, False), ("x [p. 34] y", False, True),
        ("GLENSHAW EAST REDEVELOPMENT PROJECT AREA then", True, False), ("found no FY 2019 TIF Name: Calcroft West Page 115 of 133 settlement", True, True), ("SBIF - Alpe Corridor", False, False), ("North Ave Bldg. 12", False, False), ("it was done. 12", False, True), ("12\nof it", False, True), (None, False, False), ("", False, False),
    ]
    scanner = scan_lines.Scanner(ANCHORS)
    assert [scanner(c[0])[:2] for c in cases] == [c[1:] for c in cases]
    assert scan_lines.Scanner([])("a\nSECTION 7\nb") == (False, False, "a SECTION 7 b")


def test_tokens_join_over_lines_and_headers(spark):
    scanner = scan_lines.Scanner(ANCHORS)

    def words(text):
        both = spark.createDataFrame(list(enumerate(scanner(text)[2].split(" "))), "i int, t string")
        c = F.col("t")
        return [(r[0], r[1] != "") for r in both.orderBy("i").select(scan_lines.bare(scan_lines.run_together(c)), scan_lines.with_hyphens(c)).collect()]

    assert words("re-\ndevelop\u00ad ment") == [("redevelopment", True)]
    assert words("incur- 2023 REPORTS OF COMMITTEES   13 red costs") == [("incurred", True), ("costs", False)]
    assert words("Pre- and post-\nwar (c0st) (ost.") == [("pre", False), ("and", False), ("postwar", True), ("c0st", False), ("(ost", False)]


def test_headers_are_learnt_from_the_corpus(spark):
    rng = random.Random(3)
    words = "the developer will build and repair a long list of stores while most people wait for news about it in their own homes".split()
    texts = []
    for i in range(400):
        lines = [" ".join(rng.choice(words) for _ in range(6)) for _ in range(4)]
        if i % 4 == 0:
            lines.insert(rng.randrange(5), rng.choice([f"{1990 + i % 30} ANNALS OF TOWNS", f"Record of {rng.choice(['Ash', 'Elm Road', 'Oak'])}"]))
        texts.append("\n".join(lines))
    rows = spark.createDataFrame([("t", i, x) for i, x in enumerate(texts)], "tbl string, row_id long, text string")
    anchors = scan_lines.header_anchors(rows)
    assert {a[1] for a in anchors if a[0]} >= {"# ANNALS OF"} and not any(w in a[1] for a in anchors for w in ("developer", "stores", "news"))
    flagged = {r.row_id for r in scan_lines.scanned(rows, anchors).filter("header").collect()}
    assert {i for i, x in enumerate(texts) if "ANNALS" in x} <= flagged <= {i for i in range(400) if i % 4 == 0}
    assert scan_lines.header_anchors(rows.limit(0)) == []


@pytest.mark.parametrize("read,printed", [("cornplete", "complete"), ("rcp0rts", "reports"), ("indiistrial", "industrial"), ("strudure", "structure"), ("townliomes", "townhomes"), ("c1eveloper", "developer"), ("pro'osed", "proposed"), ("dehver", "deliver")])
def test_anagram_differences_lead_to_the_word(read, printed):
    assert anagram(printed) in targets(read) and misreadings(read, printed) >= 1
    assert misreadings(printed, printed) == 0 and misreadings("abc", "xyz") is None


def test_numbers():
    assert [number_of(w) for w in ("z018", "2o1o", "201s", "35th", "2018", "10a")] == ["2018", "2010", "2015", None, None, None]


def test_noise_and_repair(spark):
    good = "The developer will complete construction of the mixed-use building and reports progress on redevelopment. "
    rows = [(MENTION, i, good) for i in range(20)]
    rows += [(MENTION, 100, "The c1eveloper will cornplete construc-\ntion of the mixed-\nuse building"), (MENTION, 101, None), (MENTION, 102, ""), (MENTION, 103, "reports\nSECTION 3\nprogress on rede- velopment"), *[(MENTION, 200 + i, "\n".join(x)) for i, x in enumerate([["SECTION 4", good, "of"], ["the use", "SECTION 5", "of"], ["building", "SECTION 6", good], ["of", "SECTION 7", "building"]])], (MENTION, 104, good * 400 + "rcp0rts")]
    df = spark.createDataFrame(rows, "tbl string, row_id long, text string").selectExpr("*", "'w' as word", "1 as page")
    got = {(r.row_id, r.noise, r.word) for r in scan_noise.noise(df.select("tbl", "row_id", "text")).collect()}
    assert got == {(100, "glyph", "developer"), (100, "glyph", "complete"), (100, "hyphen", "construction"), (100, "hyphen", "mixed-use"), (103, "header", ""), *[(200 + i, "header", "") for i in range(4)], (103, "hyphen", "redevelopment"), (104, "glyph", "reports")}
    text = {r.row_id: r.text for r in scan_noise.repaired(df.select("tbl", "row_id", "text")).collect()}
    assert text[100] == "The developer will complete construction of the mixed-use building" and text[101] is None and text[102] == "" and text[103] == "reports progress on redevelopment"
    assert scan_noise.noise(df.select("tbl", "row_id", "text").limit(0)).count() == 0


def test_known_words_are_found_whatever_two_misreadings():
    rng = random.Random(4)
    from ledgerweave.llm.scan_marks import MISREAD

    for word in ("redevelopment", "environmental", "construction", "demolition", "residences"):
        for _ in range(20):
            read = word
            for _ in range(2):
                r, p = rng.choice([(r, p) for r, p in MISREAD if p in read] or [("", "")])
                if p:
                    i = rng.choice([k for k in range(len(read)) if read.startswith(p, k)])
                    read = read[:i] + r + read[i + len(p) :]
            k = misreadings(read, word)
            if read != word and k is not None and k <= 3:
                assert anagram(word) in targets(read), (read, word)

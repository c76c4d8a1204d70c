"""Column functions on rows that can be checked by hand."""

import math

import pytest
from pyspark.sql import functions as F

from ledgerweave.functions import coerce, dates, geo, ids, similarity, spans, text, url


def values(spark, rows, *cols):
    df = spark.createDataFrame([(r,) for r in rows], "x string")
    return [tuple(r) for r in df.select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).collect()]


X = F.col("x")


def test_coercions(spark):
    got = values(spark, ["2010-05-01", "05/01/2010", "$1,200.50", "-3", "abc", "", None], coerce.first_int(X), coerce.year_of(X), coerce.first_float(X), coerce.strict_int(X))
    assert got[0][:2] == (2010, 2010)
    assert got[1][:2] == (5, 2010)
    assert got[2][2] == 1200.5
    assert got[3] == (-3, -3, -3.0, -3)
    assert got[4] == got[5] == got[6] == (None, None, None, 0)


def test_money_and_months(spark):
    # a magnitude of one letter must stand alone; brackets and signs do not count
    assert [r[0] for r in values(spark, ["$5m", "$5 m", "$(1,200) k", "$5 bn", "2k", "$$7"], coerce.money(X))] == [5.0, 5e6, 1.2e6, 5e9, 2.0, 7.0]
    assert [r[0] for r in values(spark, ["3 yrs", "1 yr", "6 mo", "9 mos"], coerce.months(X))] == [36.0, 12.0, 6.0, 9.0]
    assert [r[0] for r in values(spark, ["$5 million", "$1,200", "3 thousand", "none"], coerce.money(X))] == [5e6, 1200.0, 3000.0, None]
    assert [r[0] for r in values(spark, ["18 months", "2 years", "7 days"], coerce.months(X))] == [18.0, 24.0, None]
    assert [r[0] for r in values(spark, ["2010-05-01", "x", None], coerce.date_key(X))] == [20100501, 0, 0]


def test_identifiers(spark):
    rows = ["T-T-7", "t-067", "T_067_Name23", "1234", "Loop", "", None]
    assert [r[0] for r in values(spark, rows, ids.canonical_district(X))] == ["T-007", "T-067", "T-067", "T-123", "LOOP", "", ""]
    assert [r[0] for r in values(spark, rows, ids.district_number(X))] == ["T-007", "T-067", "T-067", "T-123", None, None, None]
    assert [r[0] for r in values(spark, ["Yes", " t ", "0", None], ids.truthy(X))] == [True, True, False, False]


def test_text_forms(spark):
    got = values(spark, ["Café  No.5", "  A--b ", None], text.norm_text(X), text.slug(X), text.safe_filename(X))
    assert got[0][:2] == ("caf no 5", "caf-no-5")
    assert got[1] == ("a b", "a-b", "A--b")
    assert got[2] == ("", "item", "file")
    assert values(spark, ["Smith, John A. Jr."], text.person_name(X)) == [("john a smith",)]
    assert values(spark, ["'''[[Page|Some]]''' <b>text</b>{{cite}} &amp; more<ref>x</ref>"], text.strip_markup(X)) == [("Some text & more",)]
    assert values(spark, ["a Project b\nc", "plain"], text.before_first(X, ("Project", "\n"))) == [("a ",), ("plain",)]
    assert values(spark, ["ward 7", "07", "Ward 51"], text.ward_number(X)) == [(7,), (None,), (None,)]
    assert values(spark, ["x"], text.unique_join(F.array(F.lit("A b"), F.lit("a-B"), F.lit(""), F.lit("c")))) == [("A b; c",)]
    assert values(spark, ["error http 404 x"], text.http_status(X)) == [(404,)]


def test_dates(spark):
    rows = ["2/12/1982", "2000-04-01", "2013-04-07T00:00:00.000", "19970517", " 2007-12-10 ", "September 21, 1990", "08-OCT-2001", "1998-13-45", "02/30/2001", "00/00/0000", "n.d.", "", None]
    got = [None if r[0] is None else str(r[0]) for r in values(spark, rows, dates.parse_date(X))]
    assert got == ["1982-02-12", "2000-04-01", "2013-04-07", "1997-05-17", "2007-12-10", "1990-09-21", "2001-10-08"] + [None] * 6


def test_spans(spark):
    (row,) = values(spark, ["ab 12 cd 345, 6"], spans.matches(X, r"\d+"))
    assert [(m["at"], m["hit"]) for m in row[0]] == [(3, "12"), (9, "345"), (14, "6")]


def test_similarity(spark):
    df = spark.createDataFrame([("tide", "diet"), ("diet", "tide"), (None, "")], "a string, b string")
    assert [r[0] for r in df.select(similarity.ratio(F.col("a"), F.col("b"))).collect()] == [0.25, 0.5, 1.0]
    assert values(spark, ["x"], similarity.jaccard(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b")))) == [(0.5,)]


def test_urls(spark):
    page = F.lit("https://a.org/x/y.html?q=1")
    got = values(spark, ["/r.pdf", "s.pdf", "https://b.org/", "#top", "mailto:a@b", "//c.org/z"], url.absolute(X, page))
    assert [g[0] for g in got] == ["https://a.org/r.pdf", "https://a.org/x/s.pdf", "https://b.org/", None, None, "https://c.org/z"]
    assert values(spark, ["https://a.org/b/c.pdf?x=1#y"], url.tail(X)) == [("c.pdf",)]
    assert values(spark, ["""<a class=x href='p.pdf'>P</a><A HREF="q.pdf">"""], url.links_of(X)) == [(["p.pdf", "q.pdf"],)]


def test_geometry():
    square = "POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))"
    assert geo.centroid(geo.parse_wkt(square)) == (1.0, 1.0, 4.0)
    holed = "MULTIPOLYGON (((0 0, 2 0, 2 2, 0 2, 0 0), (0.5 0.5, 1 0.5, 1 1, 0.5 0.5)), ((10 0, 12 0, 12 2, 10 2)))"
    lon, lat, area = geo.centroid(geo.parse_wkt(holed))
    assert (lon, lat, area) == (6.0, 1.0, 8.0)
    assert geo.parse_wkt("POINT (1 2)") is None
    assert geo.parse_wkt("POLYGON ((0 0, 1 1))") is None
    lon, lat, area = geo.centroid(geo.parse_wkt("POLYGON ((0 0, 1 1, 2 2, 0 0))"))
    assert area == 0.0 and math.isclose(lon, 0.75)


@pytest.mark.parametrize("bad", [None, "", "POLYGON", "POLYGON ((a b, c d))"])
def test_geometry_of_junk(bad):
    assert geo.centroid(geo.parse_wkt(bad)) == (None, None, 0.0)

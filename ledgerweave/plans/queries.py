"""Queries over the test tables, each with the SQL that says the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.functions import coerce, geo, ids, similarity, text, url
from ledgerweave.operators import aggregate, intervals, joins, match, rank, state, textmine
from ledgerweave.operators.components import connected_components
from ledgerweave.sources.files import exploded_attachments, manifest, metric_map
from ledgerweave.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

ANNUAL, LEGACY, MENTIONS = "tif_annual_report_projects", "tif_legacy_annual_report_projects_2010_2016", "tif_pdf_projected_realized_mentions"
MATTERS, BOUNDARIES, UNIVERSE = "tif_elms_matters", "tif_boundary_districts_historical", "tif_district_universe"
CANDIDATES, OVERRIDES, AUDIT = "tif_district_legislation_candidates", "project_name_overrides", "tif_legacy_pdf_project_audit_sample"

Read = Callable[[str], DataFrame]


def query(sql: str | None = None) -> Callable[[Callable[[Read], DataFrame]], Callable[[Read], DataFrame]]:
    """Register a query ``f(read)``, where ``read(name)`` is a table of the data folder, with its SQL."""

    def register(f: Callable[[Read], DataFrame]) -> Callable[[Read], DataFrame]:
        QUERIES[f.__name__] = lambda spark, folder: f(lambda name: table(spark, folder, name))
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


_DATE = """CASE
  WHEN regexp_matches({s}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}([t ].*)?$') THEN try_cast(substr({s}, 1, 10) AS DATE)
  WHEN regexp_matches({s}, '^\\d{{8}}$') THEN try_cast(substr({s}, 1, 4) || '-' || substr({s}, 5, 2) || '-' || substr({s}, 7, 2) AS DATE)
  WHEN regexp_matches({s}, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$') THEN CAST(try_strptime({s}, '%m/%d/%Y') AS DATE)
  WHEN regexp_matches({s}, '^[a-z]+ \\d{{1,2}}, \\d{{4}}$') THEN CAST(try_strptime({s}, '%B %d, %Y') AS DATE)
  WHEN regexp_matches({s}, '^\\d{{1,2}}-[a-z]{{3}}-\\d{{4}}$') THEN CAST(try_strptime({s}, '%d-%b-%Y') AS DATE) END"""


def _date(c: str) -> str:
    return _DATE.format(s=f"lower(trim({c}))")


# SQL of the column functions
def _norm(c: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({c}, '')), '[^a-z0-9]+', ' ', 'g'))"


def _tif(c: str) -> str:
    """Canonical number, the text in upper case without digits."""
    d = f"regexp_extract(upper(trim(coalesce({c}, ''))), '(\\d{{1,3}})', 1)"
    return f"CASE WHEN {d} <> '' THEN 'T-' || lpad({d}, 3, '0') ELSE upper(trim(coalesce({c}, ''))) END"


def _num(c: str) -> str:
    return f"try_cast(nullif(regexp_extract(replace({c}, ',', ''), '-?\\d+(?:\\.\\d+)?', 0), '') AS DOUBLE)"


def _int(c: str) -> str:
    return f"try_cast(nullif(regexp_extract({c}, '-?\\d+', 0), '') AS BIGINT)"


def _year(c: str) -> str:
    return f"coalesce(try_cast(nullif(regexp_extract({c}, '\\b((?:19|20)\\d{{2}})\\b', 1), '') AS BIGINT), {_int(c)})"




@query(
    f"""
WITH i AS (SELECT tract_id, {_date("approval_d")} AS s, coalesce({_date("repealed_d")}, {_date("expiration")}, DATE '9999-12-31') AS t
  FROM tif_boundary_districts_historical),
m AS (SELECT *, max(t) OVER (PARTITION BY tract_id ORDER BY s, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM i WHERE s IS NOT NULL AND t > s),
n AS (SELECT *, sum(CASE WHEN b IS NULL OR s > b THEN 1 ELSE 0 END) OVER (PARTITION BY tract_id ORDER BY s, t ROWS UNBOUNDED PRECEDING) AS k FROM m),
p AS (SELECT tract_id, min(s) AS s, max(t) AS t FROM n WHERE tract_id IS NOT NULL GROUP BY tract_id, k),
g AS (SELECT *, lead(s) OVER (PARTITION BY tract_id ORDER BY s) AS x FROM p)
SELECT tract_id, 'period' AS kind, strftime(s, '%Y-%m-%d') AS start_d, strftime(t, '%Y-%m-%d') AS end_d FROM g
UNION ALL SELECT tract_id, 'gap', strftime(t, '%Y-%m-%d'), strftime(x, '%Y-%m-%d') FROM g WHERE x IS NOT NULL"""
)
def p5_found(read: Read) -> DataFrame:
    return intervals.tract_intervals(read(BOUNDARIES))


# --- coercions, identifiers, normal forms -----------------------------------------------------------


@query(
    f"""SELECT mention_id, {_num("value_raw")} AS as_float, {_int("value_raw")} AS as_int,
  {_num("value_raw")} * CASE WHEN regexp_matches(lower(value_raw), '(years?|yrs?)$') THEN 12 WHEN regexp_matches(lower(value_raw), '(months?|mos?)$') THEN 1 END AS as_months,
  coalesce(try_cast(trim(value_raw) AS INTEGER), 0) AS strict_int, try_cast(replace(trim(value_raw), ',', '') AS DOUBLE) AS strict_float
FROM tif_pdf_projected_realized_mentions"""
)
def coerce_values(read: Read) -> DataFrame:
    c = F.col("value_raw")
    return read(MENTIONS).select("mention_id", coerce.first_float(c).alias("as_float"), coerce.first_int(c).alias("as_int"), coerce.months(c).alias("as_months"), coerce.strict_int(c).alias("strict_int"), coerce.strict_float(c).alias("strict_float"))


@query(
    f"""SELECT boundary_row_id, {_year("approval_d")} AS year_of, {_int("approval_d")} AS first_int,
  coalesce(try_cast(replace(nullif(regexp_extract(approval_d, '^\\d{{4}}-\\d{{2}}-\\d{{2}}'), ''), '-', '') AS INTEGER), 0) AS date_key
FROM tif_boundary_districts_historical"""
)
def coerce_dates(read: Read) -> DataFrame:
    c = F.col("approval_d")
    return read(BOUNDARIES).select("boundary_row_id", coerce.year_of(c).alias("year_of"), coerce.first_int(c).alias("first_int"), coerce.date_key(c).alias("date_key"))


@query(
    f"""SELECT annual_row_id, {_tif("tif_number")} AS tif_key, {_norm("project_name")} AS project_key,
  left(coalesce(nullif(replace({_norm("project_name")}, ' ', '-'), ''), 'item'), 64) AS project_slug,
  left(coalesce(nullif(regexp_replace(regexp_replace(coalesce(project_name, ''), '[^A-Za-z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'file'), 140) AS file_name
FROM tif_annual_report_projects"""
)
def norm_ids(read: Read) -> DataFrame:
    n = F.col("project_name")
    return read(ANNUAL).select("annual_row_id", ids.canonical_district(F.col("tif_number")).alias("tif_key"), text.norm_text(n).alias("project_key"), text.slug(n).alias("project_slug"), text.safe_filename(n).alias("file_name"))


#: Words that a project name is compared without, and substrings that a district name is rewritten by (parameters of the query).
STOP_WORDS = ("the", "and", "project", "llc", "inc", "phase", "redevelopment", "agreement")
REWRITES = (("street", "st"), ("avenue", "ave"), (" and ", " "), (" project area", ""))


@query(
    f"""SELECT annual_row_id, array_to_string(list_filter(string_split({_norm("project_name")}, ' '), lambda t: NOT list_contains({list(STOP_WORDS)!r}, t)), ' ') AS simple_name,
  trim(regexp_replace(replace(replace(replace(replace({_norm("tif_district")}, 'street', 'st'), 'avenue', 'ave'), ' and ', ' '), ' project area', ''), ' +', ' ', 'g')) AS simple_district,
  regexp_matches({_norm("project_name")}, '[a-z]') AND NOT regexp_matches(trim(regexp_replace(' ' || {_norm("project_name")} || ' ', '( \\d+)+ ', ' ', 'g')), '^(school|park|iga|hospital)$')
    AND (length(replace({_norm("project_name")}, ' ', '')) >= 6 OR length(array_to_string(list_filter(string_split({_norm("project_name")}, ' '), lambda t: NOT list_contains({list(STOP_WORDS)!r}, t)), '')) >= 5) AS informative
FROM tif_annual_report_projects"""
)
def simplify_names(read: Read) -> DataFrame:
    n = F.col("project_name")
    return read(ANNUAL).select(
        "annual_row_id", text.without_words(n, STOP_WORDS).alias("simple_name"), text.rewritten(F.col("tif_district"), REWRITES).alias("simple_district"), text.informative(n, ("school", "park", "iga", "hospital"), simple=text.without_words(n, STOP_WORDS)).alias("informative")
    )


@query(
    """SELECT DISTINCT filing_sponsor, trim(regexp_replace(regexp_replace(regexp_replace(lower(coalesce(
  CASE WHEN contains(filing_sponsor, ',') THEN trim(split_part(filing_sponsor, ',', -1)) || ' ' || trim(split_part(filing_sponsor, ',', 1)) ELSE filing_sponsor END, '')), '[^a-z]+', ' ', 'g'),
  '\\b(jr|sr|ii|iii|iv)\\b', ' ', 'g'), ' +', ' ', 'g')) AS person
FROM tif_elms_matters"""
)
def person_names(read: Read) -> DataFrame:
    return read(MATTERS).select("filing_sponsor", text.person_name(F.col("filing_sponsor")).alias("person")).distinct()


@query("""SELECT doc_id, sha1(text) AS text_hash, length(trim(regexp_replace(text, '[ \\t\\n\\r]+', ' ', 'g'))) AS clean_chars FROM documents WHERE text IS NOT NULL""")
def text_hash(read: Read) -> DataFrame:
    """SHA-1 of the UTF-8 bytes of every text, and its length in code points with runs of white space as one space."""
    t = F.col("text")
    return read("documents").filter("text is not null").select("doc_id", F.sha1(t.cast("binary")).alias("text_hash"), F.length(F.trim(F.regexp_replace(t, r"[ \t\n\r]+", " "))).cast("long").alias("clean_chars"))


# --- projections, unions, panels ------------------------------------------------------------------------


@query(
    """SELECT annual_row_id, round(current_year_payments - estimated_next_year_payments, 2) AS gap,
  round((current_year_payments - estimated_next_year_payments) / nullif(estimated_next_year_payments, 0), 6) AS gap_share
FROM tif_annual_report_projects"""
)
def payment_gap(read: Read) -> DataFrame:
    gap = F.col("current_year_payments") - F.col("estimated_next_year_payments")
    return read(ANNUAL).select("annual_row_id", F.round(gap, 2).alias("gap"), F.round(gap / F.nullif(F.col("estimated_next_year_payments"), F.lit(0)), 6).alias("gap_share"))


@query(
    f"""SELECT {_tif("tif_number")} AS tif_key, report_year, count(*) AS projects, round(sum(coalesce(current_year_payments, 0)), 2) AS paid,
  round(sum(coalesce(estimated_next_year_payments, 0)), 2) AS planned
FROM tif_annual_report_projects WHERE report_year IS NOT NULL GROUP BY ALL"""
)
def district_year_sums(read: Read) -> DataFrame:
    rows = read(ANNUAL).withColumn("tif_key", ids.canonical_district(F.col("tif_number")))
    return aggregate.counts_and_sums(rows, ["tif_key", "report_year"], {"paid": "current_year_payments", "planned": "estimated_next_year_payments"}, "projects")


@query(
    """SELECT pdf_file, page_number, round(sum(CASE WHEN status = 'projected' THEN coalesce(value_numeric, 0) ELSE 0 END), 2) AS projected,
  round(sum(CASE WHEN status = 'realized' THEN coalesce(value_numeric, 0) ELSE 0 END), 2) AS realized,
  round(sum(CASE WHEN status IS NULL OR status NOT IN ('projected', 'realized') THEN coalesce(value_numeric, 0) ELSE 0 END), 2) AS other
FROM tif_pdf_projected_realized_mentions WHERE pdf_file IS NOT NULL AND page_number IS NOT NULL GROUP BY ALL"""
)
def conditional_sums(read: Read) -> DataFrame:
    s = F.col("status")
    return aggregate.conditional_sums(read(MENTIONS), ["pdf_file", "page_number"], F.col("value_numeric"), {"projected": s == "projected", "realized": s == "realized"}, "other")


@query(
    f"""WITH a AS (SELECT {_tif("tif_number")} AS tif_key, report_year AS year, count(*) AS projects, round(sum(coalesce(current_year_payments, 0)), 2) AS paid
  FROM tif_annual_report_projects WHERE report_year IS NOT NULL GROUP BY ALL),
y AS (SELECT tif_number AS tif_key, canonical_tif_district AS district, CAST(unnest(generate_series(greatest(first_year, 1981), least(last_year, 2027))) AS INTEGER) AS year FROM tif_district_universe),
l AS (SELECT {_tif("tif_number")} AS tif_key, report_year AS year, max(legacy_expected_project_total) AS expected FROM tif_legacy_annual_report_projects_2010_2016 GROUP BY ALL)
SELECT y.tif_key, y.year, district, coalesce(projects, 0) AS projects, coalesce(paid, 0) AS paid, expected
FROM y LEFT JOIN a ON y.tif_key = a.tif_key AND y.year = a.year LEFT JOIN l ON y.tif_key = l.tif_key AND y.year = l.year"""
)
def district_panel(read: Read) -> DataFrame:
    universe = read(UNIVERSE).select(F.col("tif_number").alias("tif_key"), F.col("canonical_tif_district").alias("district"), "first_year", "last_year")
    years = aggregate.expand_years(universe, "first_year", "last_year", 1981, 2027).drop("first_year", "last_year")
    annual = read(ANNUAL).select(ids.canonical_district(F.col("tif_number")).alias("tif_key"), F.col("report_year").alias("year"), "current_year_payments")
    sums = aggregate.counts_and_sums(annual, ["tif_key", "year"], {"paid": "current_year_payments"}, "projects")
    legacy = read(LEGACY).groupBy(ids.canonical_district(F.col("tif_number")).alias("tif_key"), F.col("report_year").alias("year")).agg(F.max("legacy_expected_project_total").alias("expected"))
    panel = years.join(sums, ["tif_key", "year"], "left").join(legacy, ["tif_key", "year"], "left")
    return panel.select("tif_key", "year", "district", F.coalesce("projects", F.lit(0)).alias("projects"), F.coalesce("paid", F.lit(0.0)).alias("paid"), "expected")


@query(
    """SELECT annual_row_id AS row_id, tif_number, report_year, project_name, current_year_payments, 'annual' AS source, CAST(NULL AS VARCHAR) AS section_pages FROM tif_annual_report_projects
UNION ALL SELECT legacy_row_id, tif_number, report_year, project_name, NULL, 'legacy', section_pages FROM tif_legacy_annual_report_projects_2010_2016"""
)
def full_union(read: Read) -> DataFrame:
    common = ["tif_number", "report_year", "project_name"]
    return aggregate.union_tagged(
        {"annual": read(ANNUAL).select(F.col("annual_row_id").alias("row_id"), *common, "current_year_payments"), "legacy": read(LEGACY).select(F.col("legacy_row_id").alias("row_id"), *common, "section_pages")}
    )


@query(
    f"""WITH a AS (SELECT {_tif("tif_number")} AS t, {_norm("project_name")} AS p, report_year AS y FROM tif_annual_report_projects),
l AS (SELECT {_tif("tif_number")} AS t, {_norm("project_name")} AS p FROM tif_legacy_annual_report_projects_2010_2016),
d AS (SELECT count(*) AS n FROM (SELECT DISTINCT t FROM a WHERE t <> '' INTERSECT SELECT DISTINCT t FROM l WHERE t <> ''))
SELECT unnest(['rows', 'districts', 'projects', 'first_year', 'last_year', 'shared_districts', 'share_named']) AS metric,
  unnest([CAST(count(*) AS DOUBLE), count(DISTINCT nullif(t, '')), count(DISTINCT CASE WHEN t <> '' AND p <> '' THEN t || '|' || p END), min(y), max(y), (SELECT n FROM d),
  round(sum(CASE WHEN p <> '' THEN 1 ELSE 0 END) / nullif(count(*), 0), 6)]) AS value FROM a"""
)
def coverage_metrics(read: Read) -> DataFrame:
    t, p = ids.canonical_district(F.col("tif_number")), text.norm_text(F.col("project_name"))
    legacy = read(LEGACY).select(t.alias("t")).filter("t <> ''").distinct().withColumn("l", F.lit(1))
    rows = read(ANNUAL).select(t.alias("t"), p.alias("p"), F.col("report_year").alias("y")).join(legacy, "t", "left")
    named = F.sum((F.col("p") != "").cast("int"))
    return aggregate.metric_table(
        rows,
        {
            "rows": F.count(F.lit(1)),
            "districts": F.countDistinct(F.nullif(F.col("t"), F.lit(""))),
            "projects": F.countDistinct(F.when((F.col("t") != "") & (F.col("p") != ""), F.concat_ws("|", "t", "p"))),
            "first_year": F.min("y"),
            "last_year": F.max("y"),
            "shared_districts": F.countDistinct(F.when(F.col("l") == 1, F.col("t"))),
            "share_named": F.round(named / F.nullif(F.count(F.lit(1)), F.lit(0)), 6),
        },
    )


@query("""SELECT 'mentions_' || coalesce(nullif(metric_type, ''), 'blank') || '_' || coalesce(nullif(status, ''), 'blank') AS metric, CAST(count(*) AS DOUBLE) AS value FROM tif_pdf_projected_realized_mentions GROUP BY 1""")
def metrics_by_status(read: Read) -> DataFrame:
    return aggregate.counts_as_metrics(read(MENTIONS), ["metric_type", "status"], "mentions")


@query(
    """WITH m AS (SELECT 'status_' || coalesce(status, 'none') AS metric, CAST(annual_row_id AS VARCHAR) AS value, annual_row_id FROM tif_annual_report_projects)
SELECT metric, arg_max(value, annual_row_id) AS value FROM m GROUP BY metric"""
)
def metric_lookup(read: Read) -> DataFrame:
    rows = read(ANNUAL).select(F.concat(F.lit("status_"), F.coalesce("status", F.lit("none"))).alias("metric"), F.col("annual_row_id").cast("string").alias("value"), "annual_row_id")
    return metric_map(rows, "annual_row_id")


# --- first, last and best rows; calendars; votes ---------------------------------------------------------------


@query(
    f"""WITH m AS (SELECT {_tif("tif_number")} AS tif_key, {_norm("project_name")} AS project_key, legacy_row_id, status AS legacy_status,
  row_number() OVER (PARTITION BY {_tif("tif_number")}, {_norm("project_name")} ORDER BY legacy_row_id) AS r FROM tif_legacy_annual_report_projects_2010_2016)
SELECT a.annual_row_id, m.legacy_row_id, m.legacy_status, CASE WHEN m.legacy_row_id IS NULL THEN 0 ELSE 1 END AS matched
FROM tif_annual_report_projects a LEFT JOIN m ON {_tif("a.tif_number")} = m.tif_key AND {_norm("a.project_name")} = m.project_key AND m.r = 1"""
)
def first_wins_match(read: Read) -> DataFrame:
    keys = [ids.canonical_district(F.col("tif_number")).alias("tif_key"), text.norm_text(F.col("project_name")).alias("project_key")]
    left, right = read(ANNUAL).select("annual_row_id", *keys), read(LEGACY).select(*keys, "legacy_row_id", F.col("status").alias("legacy_status"))
    return joins.first_match(left, right, ["tif_key", "project_key"], [F.asc("legacy_row_id")]).select("annual_row_id", "legacy_row_id", "legacy_status", "matched")


def _as_of(year_sql: Callable[[str], str]) -> str:
    return f"""WITH b AS (SELECT {_tif("ref")} AS tif_key, boundary_row_id, {year_sql("approval_d")} AS s, coalesce({year_sql("repealed_d")}, {year_sql("expiration")}) AS t,
  {year_sql("repealed_d")} IS NOT NULL AS dead, shape_area FROM tif_boundary_districts_historical),
f AS (SELECT DISTINCT {_tif("tif_number")} AS tif_key, report_year FROM tif_annual_report_projects WHERE tif_number IS NOT NULL),
j AS (SELECT f.tif_key, f.report_year, b.boundary_row_id, coalesce(f.report_year BETWEEN coalesce(s, 0) AND coalesce(t, 9999), FALSE) AS ok, dead, coalesce(s, 0) AS s, coalesce(shape_area, 0) AS a
  FROM f LEFT JOIN b ON f.tif_key = b.tif_key),
r AS (SELECT *, row_number() OVER (PARTITION BY tif_key, report_year ORDER BY ok DESC, CASE WHEN ok THEN 0 WHEN dead THEN 0 ELSE 1 END DESC, s DESC, a DESC, boundary_row_id) AS k FROM j)
SELECT tif_key, report_year, boundary_row_id, CASE WHEN boundary_row_id IS NULL THEN 'none' WHEN ok THEN 'valid' ELSE 'fallback' END AS as_of FROM r WHERE k = 1"""


def _as_of_rows(read: Read, year: Callable[[Column], Column]) -> DataFrame:
    y = lambda c: year(F.col(c))
    boundaries = read(BOUNDARIES).select(
        ids.canonical_district(F.col("ref")).alias("tif_key"), "boundary_row_id", y("approval_d").alias("s"), F.coalesce(y("repealed_d"), y("expiration")).alias("t"), y("repealed_d").isNotNull().alias("dead"), "shape_area"
    )
    facts = read(ANNUAL).filter("tif_number is not null").select(ids.canonical_district(F.col("tif_number")).alias("tif_key"), "report_year").distinct()
    return joins.as_of_year(facts, boundaries, "tif_key", "report_year", "s", "t", "dead", "shape_area", "boundary_row_id").select("tif_key", "report_year", "boundary_row_id", "as_of")


@query(_as_of(_year))
def as_of_boundary(read: Read) -> DataFrame:
    return _as_of_rows(read, coerce.year_of)


@query(_as_of(_int))
def as_of_boundary_first_int(read: Read) -> DataFrame:
    """The same with the other year parser: the first integer of the text."""
    return _as_of_rows(read, coerce.first_int)


@query(
    f"""WITH v AS (SELECT {_tif("tif_number")} AS tif_key, tif_district AS name, 3 AS w, annual_row_id AS o, 0 AS s FROM tif_annual_report_projects
UNION ALL SELECT {_tif("ref")}, tif_name, 2, boundary_row_id, 1 FROM tif_boundary_districts_historical),
k AS (SELECT *, {_norm("name")} AS form FROM v WHERE {_norm("name")} <> '' AND tif_key <> ''),
f AS (SELECT tif_key, form, arg_min(name, s * 10000000000 + o) AS name, sum(w) AS w FROM k GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY tif_key ORDER BY w DESC, length(name) DESC, lower(name) DESC) AS r, max(w) OVER (PARTITION BY tif_key) AS top, count(*) OVER (PARTITION BY tif_key) AS n FROM f)
SELECT tif_key, name AS voted, CAST(top AS BIGINT) AS votes, n AS spellings FROM r WHERE r = 1"""
)
def name_vote(read: Read) -> DataFrame:
    a = read(ANNUAL).select(ids.canonical_district(F.col("tif_number")).alias("tif_key"), F.col("tif_district").alias("name"), F.lit(3).alias("w"), F.col("annual_row_id").alias("o"), F.lit(0).alias("s"))
    b = read(BOUNDARIES).select(ids.canonical_district(F.col("ref")).alias("tif_key"), F.col("tif_name").alias("name"), F.lit(2).alias("w"), F.col("boundary_row_id").alias("o"), F.lit(1).alias("s"))
    votes = a.unionByName(b).withColumn("form", text.norm_text(F.col("name"))).filter("form <> '' and tif_key <> ''")
    return aggregate.weighted_vote(votes, "tif_key", "form", "name", "w", [F.asc("s"), F.asc("o")])


@query(
    f"""WITH o AS (SELECT {_tif("tif_number")} AS tif_key, report_year AS year, 'annual' AS src FROM tif_annual_report_projects
UNION ALL SELECT {_tif("tif_number")}, report_year, 'legacy' FROM tif_legacy_annual_report_projects_2010_2016
UNION ALL SELECT matched_tif_number, try_cast(meeting_year AS INTEGER), 'journal' FROM tif_district_legislation_candidates),
ob AS (SELECT * FROM o WHERE tif_key <> '' AND year BETWEEN 1981 AND 2027),
i AS (SELECT tif_number AS tif_key, CAST(unnest(generate_series(greatest(first_year, 1981), least(coalesce(last_year, 2027), 2027))) AS INTEGER) AS year FROM tif_district_universe),
u AS (SELECT tif_key, year, src, 1 AS ob, 0 AS im FROM ob UNION ALL SELECT tif_key, year, NULL, 0, 1 FROM i)
SELECT tif_key, year, max(ob) AS observed, max(im) AS implied, max(CASE WHEN src = 'annual' THEN 1 ELSE 0 END) AS has_annual, max(CASE WHEN src = 'legacy' THEN 1 ELSE 0 END) AS has_legacy,
  max(CASE WHEN src = 'journal' THEN 1 ELSE 0 END) AS has_journal,
  CASE WHEN max(ob) = 1 AND max(im) = 1 THEN 'observed_active' WHEN max(ob) = 1 THEN 'observed_no_date_interval' ELSE 'date_implied_only' END AS coverage_status
FROM u GROUP BY tif_key, year"""
)
def universe_calendar(read: Read) -> DataFrame:
    k = ids.canonical_district(F.col("tif_number")).alias("tif_key")
    observed = (
        read(ANNUAL).select(k, F.col("report_year").alias("year"), F.lit("annual").alias("src"))
        .unionByName(read(LEGACY).select(k, F.col("report_year").alias("year"), F.lit("legacy").alias("src")))
        .unionByName(read(CANDIDATES).select(F.col("matched_tif_number").alias("tif_key"), F.col("meeting_year").try_cast("int").alias("year"), F.lit("journal").alias("src")))
    ).filter("tif_key <> '' and year between 1981 and 2027").distinct()
    universe = read(UNIVERSE).select(F.col("tif_number").alias("tif_key"), "first_year", "last_year")
    return aggregate.calendar(observed, aggregate.expand_years(universe, "first_year", "last_year", 1981, 2027), "tif_key", "year", "src", ("annual", "legacy", "journal"))


@query(
    f"""WITH t AS (SELECT {_tif("ref")} AS tif_key, tif_name, boundary_row_id, {_year("approval_d")} AS s, {_year("expiration")} AS t FROM tif_boundary_districts_historical),
e AS (SELECT tif_key, tif_name, boundary_row_id, s, CAST(unnest(generate_series(greatest(s, 1998), least(coalesce(t, 2024), 2024))) AS INTEGER) AS year FROM t WHERE s IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY tif_key, year ORDER BY s DESC, boundary_row_id DESC) AS k FROM e)
SELECT tif_key, year, tif_name, boundary_row_id FROM r WHERE k = 1"""
)
def tenure_resolve(read: Read) -> DataFrame:
    rows = read(BOUNDARIES).select(ids.canonical_district(F.col("ref")).alias("tif_key"), "tif_name", "boundary_row_id", coerce.year_of(F.col("approval_d")).alias("s"), coerce.year_of(F.col("expiration")).alias("t"))
    return rank.best_row(aggregate.expand_years(rows, "s", "t", 1998, 2024), ["tif_key", "year"], ["s", "boundary_row_id"], ["tif_name", "boundary_row_id"])


@query(
    f"""WITH s AS (SELECT {_tif("tif_number")} AS tif_key, report_year, {_norm("project_type")} AS kind, count(*) AS n, round(sum(coalesce(current_year_payments, 0)), 2) AS paid
  FROM tif_annual_report_projects WHERE report_year IS NOT NULL GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY tif_key, report_year ORDER BY paid DESC, n DESC, kind DESC) AS k FROM s)
SELECT tif_key, report_year, kind AS lead_kind, n AS lead_projects, paid AS lead_paid FROM r WHERE k = 1"""
)
def lead_argmax(read: Read) -> DataFrame:
    rows = read(ANNUAL).select(ids.canonical_district(F.col("tif_number")).alias("tif_key"), "report_year", text.norm_text(F.col("project_type")).alias("kind"), "current_year_payments")
    sums = aggregate.counts_and_sums(rows, ["tif_key", "report_year", "kind"], {"paid": "current_year_payments"}, "n")
    best = rank.best_row(sums, ["tif_key", "report_year"], ["paid", "n", "kind"], ["kind", "n", "paid"])
    return best.select("tif_key", "report_year", F.col("kind").alias("lead_kind"), F.col("n").alias("lead_projects"), F.col("paid").alias("lead_paid"))


@query(
    f"""SELECT report_year, project_iga, count(*) AS projects, sum(CASE WHEN status = 'Completed Project' THEN 1 ELSE 0 END)::BIGINT AS completed,
  count(DISTINCT {_tif("tif_number")}) AS districts, round(sum(coalesce(current_year_payments, 0)), 2) AS paid, round(sum(coalesce(private_funds, 0)), 2) AS private
FROM tif_annual_report_projects GROUP BY ALL"""
)
def year_summary(read: Read) -> DataFrame:
    return read(ANNUAL).groupBy("report_year", "project_iga").agg(
        F.count(F.lit(1)).alias("projects"),
        F.sum(F.when(F.col("status") == "Completed Project", 1).otherwise(0)).alias("completed"),
        F.countDistinct(ids.canonical_district(F.col("tif_number"))).alias("districts"),
        F.round(F.sum(F.coalesce("current_year_payments", F.lit(0.0))), 2).alias("paid"),
        F.round(F.sum(F.coalesce("private_funds", F.lit(0.0))), 2).alias("private"),
    )


@query(
    f"""WITH a AS (SELECT {_tif("tif_number")} || '|' || {_norm("project_name")} AS spine, report_year, status, project_name, annual_row_id,
  CASE status WHEN 'Completed Project' THEN 2 WHEN 'Active Project' THEN 1 ELSE 0 END AS k FROM tif_annual_report_projects)
SELECT spine, min(report_year) AS first_year, max(report_year) AS last_year, count(report_year) AS years_observed,
  first(status ORDER BY k DESC, annual_row_id) AS best_status, coalesce(array_to_string(list_sort(list_distinct(list(nullif(project_name, '')))), ' | '), '') AS variants
FROM a GROUP BY spine"""
)
def spine_rollup(read: Read) -> DataFrame:
    rows = read(ANNUAL).withColumn("spine", F.concat_ws("|", ids.canonical_district(F.col("tif_number")), text.norm_text(F.col("project_name"))))
    k = F.when(F.col("status") == "Completed Project", 2).when(F.col("status") == "Active Project", 1).otherwise(0)
    return aggregate.roll_up(rows, "spine", "report_year", k, "status", "project_name", "annual_row_id")


@query(
    f"""WITH u AS (SELECT {_tif("ref")} AS tif_key, avg(shape_area) AS area FROM tif_boundary_districts_historical WHERE shape_area IS NOT NULL GROUP BY 1),
c AS (SELECT a.annual_row_id, a.private_funds, u.area FROM tif_annual_report_projects a LEFT JOIN u ON {_tif("a.tif_number")} = u.tif_key)
SELECT annual_row_id, CASE WHEN private_funds > 0 THEN 'own value' WHEN area IS NOT NULL THEN 'district value' ELSE 'missing' END AS value_source, round(CASE WHEN private_funds > 0 THEN private_funds ELSE area END, 2) AS value FROM c"""
)
def value_tiers(read: Read) -> DataFrame:
    """Tiering with a coarser fallback: a row's own value, else that of its district, else none."""
    area = read(BOUNDARIES).filter("shape_area is not null").groupBy(ids.canonical_district(F.col("ref")).alias("tif_key")).agg(F.avg("shape_area").alias("area"))
    rows = read(ANNUAL).select("annual_row_id", "private_funds", ids.canonical_district(F.col("tif_number")).alias("tif_key")).join(area, "tif_key", "left")
    own = F.col("private_funds") > 0
    return rows.select("annual_row_id", F.when(own, "own value").when(F.col("area").isNotNull(), "district value").otherwise("missing").alias("value_source"), F.round(F.when(own, F.col("private_funds")).otherwise(F.col("area")), 2).alias("value"))


@query(
    """WITH p AS (SELECT tif_number_guess AS g, pdf_file FROM tif_pdf_projected_realized_mentions WHERE tif_number_guess IS NOT NULL)
SELECT pdf_file, min(g) AS only_number FROM p WHERE pdf_file IS NOT NULL GROUP BY pdf_file HAVING count(DISTINCT g) = 1"""
)
def guarded_lookup(read: Read) -> DataFrame:
    return joins.only_value(read(MENTIONS).filter("pdf_file is not null"), "pdf_file", "tif_number_guess", "only_number")


# --- pages, lines and texts ---------------------------------------------------------------------------------------


@query(
    """WITH h AS (SELECT DISTINCT pdf_file, page_number, greatest(page_number - 1, 1) AS s, page_number + 1 AS t FROM tif_pdf_projected_realized_mentions WHERE page_number IS NOT NULL),
b AS (SELECT *, max(t) OVER (PARTITION BY pdf_file ORDER BY page_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM h),
i AS (SELECT *, sum(CASE WHEN p IS NULL OR s > p + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY pdf_file ORDER BY page_number ROWS UNBOUNDED PRECEDING) AS k FROM b)
SELECT pdf_file, min(s) AS cluster_start, max(t) AS cluster_end, count(*) AS hits FROM i GROUP BY pdf_file, k"""
)
def page_clusters(read: Read) -> DataFrame:
    return rank.clusters(read(MENTIONS), ["pdf_file"], "page_number", pad=1)


@query(
    """WITH pages AS (SELECT pdf_file, page_number, string_agg(DISTINCT snippet, chr(10) ORDER BY snippet) AS t FROM tif_pdf_projected_realized_mentions WHERE page_number IS NOT NULL AND pdf_file IS NOT NULL AND snippet IS NOT NULL GROUP BY ALL),
h AS (SELECT pdf_file, page_number, greatest(page_number - 1, 1) AS s, page_number + 1 AS t FROM pages),
b AS (SELECT *, max(t) OVER (PARTITION BY pdf_file ORDER BY page_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM h),
i AS (SELECT *, sum(CASE WHEN p IS NULL OR s > p + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY pdf_file ORDER BY page_number ROWS UNBOUNDED PRECEDING) AS k FROM b),
w AS (SELECT pdf_file, min(s) AS cluster_start, max(t) AS cluster_end FROM i GROUP BY pdf_file, k)
SELECT w.pdf_file, cluster_start, cluster_end, string_agg(p.t, chr(10) ORDER BY page_number) AS window_text
FROM w JOIN pages p ON w.pdf_file = p.pdf_file AND p.page_number BETWEEN cluster_start AND cluster_end GROUP BY ALL"""
)
def window_text(read: Read) -> DataFrame:
    """Text of clusters of pages; a page's text is what the mentions show of it."""
    rows = read(MENTIONS).filter("page_number is not null and pdf_file is not null and snippet is not null")
    pages = rows.groupBy("pdf_file", "page_number").agg(F.array_join(F.array_sort(F.collect_set("snippet")), "\n").alias("page_text"))
    windows = rank.clusters(pages, ["pdf_file"], "page_number", pad=1).drop("hits")
    return joins.window_text(windows, pages, ["pdf_file"], "cluster_start", "cluster_end", "page_number", "page_text")


_LINES = """l AS (SELECT doc_id, i - 1 AS line_no, trim(regexp_replace(x, '[ \\t\\x{A0}]+', ' ', 'g'), ' ') AS line FROM (
  SELECT doc_id, unnest(string_split_regex(text, '\\r?\\n')) AS x, generate_subscripts(string_split_regex(text, '\\r?\\n'), 1) AS i FROM documents WHERE text IS NOT NULL))"""


@query(
    f"""WITH {_LINES}, n AS (SELECT doc_id, line_no, line, lead(line) OVER (PARTITION BY doc_id ORDER BY line_no) AS nxt FROM l WHERE line <> '')
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, CASE WHEN length(line) < 60 AND nxt IS NOT NULL THEN line || ' ' || nxt ELSE line END AS snippet FROM n"""
)
def snippet_lead(read: Read) -> DataFrame:
    rows = textmine.lines(read("documents"), ["doc_id"], "text")
    return rank.with_next(rows, ["doc_id"], "line_no", "line", 60, "snippet").select("doc_id", "line_no", "snippet")


@query(
    f"""WITH {_LINES}, h AS (SELECT doc_id, line_no, CASE WHEN regexp_matches(line, '^[A-Z][A-Z0-9 .,-]+$') THEN line END AS head FROM l WHERE line <> '')
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, last_value(head IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS section FROM h"""
)
def carry_header(read: Read) -> DataFrame:
    rows = textmine.lines(read("documents"), ["doc_id"], "text")
    head = F.when(F.col("line").rlike(r"^[A-Z][A-Z0-9 .,-]+$"), F.col("line"))
    return rank.carry_forward(rows, ["doc_id"], "line_no", head, "section").select("doc_id", "line_no", "section")


_HITS = f"""p AS (SELECT DISTINCT tif_number, {_norm("n")} AS phrase FROM (SELECT tif_number, unnest(string_split_regex(district_name_variants, '\\s*;\\s*')) AS n FROM tif_district_universe) WHERE {_norm("n")} <> ''),
h AS (SELECT DISTINCT m.matter_row_id, p.tif_number, p.phrase FROM tif_elms_matters m JOIN p ON contains(' ' || {_norm("matter_title")} || ' ', ' ' || p.phrase || ' '))"""


def _district_phrases(read: Read) -> DataFrame:
    return read(UNIVERSE).select("tif_number", F.explode(F.split("district_name_variants", r"\s*;\s*")).alias("n"))


@query(f"WITH {_HITS} SELECT matter_row_id, tif_number, phrase FROM h")
def containment_hits(read: Read) -> DataFrame:
    return joins.phrase_hits(read(MATTERS), _district_phrases(read), "matter_row_id", "matter_title", "tif_number", "n")


@query(f"WITH {_HITS}, r AS (SELECT *, row_number() OVER (PARTITION BY matter_row_id ORDER BY length(phrase) DESC, tif_number, phrase) AS k FROM h) SELECT matter_row_id, tif_number, phrase FROM r WHERE k = 1")
def longest_dictionary_hit(read: Read) -> DataFrame:
    return joins.longest_hit(containment_hits(read), "matter_row_id", "tif_number")


#: Amounts and durations as their specification writes them, for the SQL side.
_MONEY_SQL = r"(?i)\$+\s*\(?\d[\d,]*(?:\.\d+)?\)?\s*(?:billion|million|thousand|bn|m|k)?|\b\d[\d,]*(?:\.\d+)?\s*(?:billion|million|thousand|bn|m|k)\b"
_DURATION_SQL = r"(?i)\b\d+(?:\.\d+)?\s*(?:months|month|mos|mo|years|year|yrs|yr)\b"
_BARE_SQL = "trim(regexp_replace(lower(value_raw), '[$,()]', '', 'g'))"


@query(
    f"""WITH h AS (SELECT matter_row_id, unnest(regexp_extract_all(matter_title, '{_MONEY_SQL}')) AS value_raw, generate_subscripts(regexp_extract_all(matter_title, '{_MONEY_SQL}'), 1) - 1 AS pos FROM tif_elms_matters)
SELECT matter_row_id, CAST(pos AS INTEGER) AS pos, trim(value_raw) AS value_raw, {_num(_BARE_SQL)} * CASE WHEN contains({_BARE_SQL}, 'billion') OR regexp_matches({_BARE_SQL}, '\\bbn\\b') THEN 1e9
  WHEN contains({_BARE_SQL}, 'million') OR regexp_matches({_BARE_SQL}, '\\bm\\b') THEN 1e6 WHEN contains({_BARE_SQL}, 'thousand') OR regexp_matches({_BARE_SQL}, '\\bk\\b') THEN 1e3 ELSE 1 END AS value_numeric
FROM h"""
)
def money_mentions(read: Read) -> DataFrame:
    return textmine.mentions(read(MATTERS), ["matter_row_id"], "matter_title", textmine.MONEY, "cost").select("matter_row_id", "pos", "value_raw", "value_numeric")


@query(
    f"""WITH h AS (SELECT mention_id, unnest(regexp_extract_all(snippet, '{_DURATION_SQL}')) AS value_raw, generate_subscripts(regexp_extract_all(snippet, '{_DURATION_SQL}'), 1) - 1 AS pos
  FROM tif_pdf_projected_realized_mentions WHERE regexp_matches(lower(snippet), 'month|year|schedule|timeline|duration|completion|deadline'))
SELECT mention_id, CAST(pos AS INTEGER) AS pos, value_raw, {_num("value_raw")} * CASE WHEN regexp_matches(lower(value_raw), 'ye?a?rs?$') THEN 12 ELSE 1 END AS value_numeric FROM h"""
)
def duration_mentions(read: Read) -> DataFrame:
    rows = read(MENTIONS).filter(F.lower("snippet").rlike("|".join(textmine.TIME_HINTS)))
    return textmine.mentions(rows, ["mention_id"], "snippet", textmine.DURATION, "time").select("mention_id", "pos", "value_raw", "value_numeric")


TAGS = {"tif": r"(?i)tax increment", "agreement": r"(?i)agreement", "sale": r"(?i)negotiated sale", "notes": r"(?i)allocation notes", "zoning": r"(?i)zoning", "designation": r"(?i)^designation"}


@query(
    "SELECT matter_row_id, array_to_string(list_filter(["
    + ", ".join(f"CASE WHEN regexp_matches(matter_title, '{p}') THEN '{label}' END" for label, p in TAGS.items())
    + "], lambda x: x IS NOT NULL), '; ') AS tags, CASE WHEN regexp_matches(left(matter_title, 2500), '(?i)redevelopment agreement') THEN 'agreement' WHEN regexp_matches(left(matter_title, 2500), '(?i)parking|zoning') THEN 'street' ELSE 'other' END AS section, coalesce(regexp_matches(matter_title, '(?i)allocation notes|redevelopment agreement') OR (regexp_matches(matter_title, '\\bTIF\\b') AND regexp_matches(matter_title, '(?i)district|project area')), FALSE) AS gate FROM tif_elms_matters"
)
def term_tags(read: Read) -> DataFrame:
    section = textmine.first_of(F.left("matter_title", F.lit(2500)), (("(?i)redevelopment agreement", "agreement"), ("(?i)parking|zoning", "street")), "other")
    return read(MATTERS).select("matter_row_id", F.array_join(textmine.tags(F.col("matter_title"), TAGS), "; ").alias("tags"), section.alias("section"), textmine.gate(F.col("matter_title"), "(?i)allocation notes|redevelopment agreement", r"\bTIF\b", "(?i)district|project area").alias("gate"))


@query(
    """WITH t AS (SELECT matter_row_id, unnest(string_split(keyword_hits, ' | ')) AS term FROM tif_elms_matters WHERE keyword_hits IS NOT NULL)
SELECT term, count(*) AS hits, count(DISTINCT matter_row_id) AS matters FROM t WHERE term <> '' GROUP BY term"""
)
def exploded_terms(read: Read) -> DataFrame:
    rows = read(MATTERS).select("matter_row_id", F.explode(F.split("keyword_hits", r" \| ")).alias("term")).filter("term <> ''")
    return rows.groupBy("term").agg(F.count(F.lit(1)).alias("hits"), F.countDistinct("matter_row_id").alias("matters"))


@query(
    """WITH m AS (SELECT DISTINCT matter_title AS t FROM tif_elms_matters WHERE matter_title IS NOT NULL),
a AS (SELECT t, CASE WHEN regexp_matches(t, '(?i)not to exceed') THEN 3 WHEN regexp_matches(t, '(?i)agreement') THEN 2 WHEN regexp_matches(t, '\\$') THEN 1 END AS w,
  CASE WHEN regexp_matches(t, '(?i)not to exceed') THEN strpos(lower(t), 'not to exceed') WHEN regexp_matches(t, '(?i)agreement') THEN strpos(lower(t), 'agreement') ELSE strpos(t, '$') END AS pos FROM m)
SELECT t AS title, CASE WHEN w IS NOT NULL THEN CASE WHEN pos > 21 THEN '... ' ELSE '' END || substr(t, greatest(pos - 20, 1), 40) || CASE WHEN greatest(pos - 20, 1) + 40 <= length(t) THEN ' ...' ELSE '' END END AS snippet FROM a"""
)
def best_snippets(read: Read) -> DataFrame:
    rows = read(MATTERS).select(F.col("matter_title").alias("title")).filter("title is not null").distinct()
    return rows.select("title", textmine.best_snippet(F.col("title"), (("(?i)not to exceed", 3), ("(?i)agreement", 2), (r"\$", 1)), 20).alias("snippet"))


@query()
def funding_near(read: Read) -> DataFrame:
    """The largest amount near a funding word."""
    return read(MATTERS).select("matter_row_id", textmine.largest_near(F.col("matter_title"), r"\$[0-9][0-9,]*(?:\.[0-9]+)?", "(?i)exceed|assistance|notes|grant", 60).alias("funding"))


@query(
    """SELECT audit_row_id, CASE WHEN source_line IS NULL THEN NULL WHEN strpos(source_line, 'Project') = 0 AND strpos(source_line, chr(10)) = 0 THEN source_line
  ELSE substr(source_line, 1, least(coalesce(nullif(strpos(source_line, 'Project'), 0), 1000000), coalesce(nullif(strpos(source_line, chr(10)), 0), 1000000)) - 1) END AS head,
  CASE WHEN regexp_matches(coalesce(extracted_status, ''), '(?i)complet') THEN 'Completed' WHEN regexp_matches(coalesce(extracted_status, ''), '(?i)activ|ongoing') THEN 'Active' ELSE 'No' END AS status
FROM tif_legacy_pdf_project_audit_sample"""
)
def stop_truncation(read: Read) -> DataFrame:
    status = textmine.first_of(F.coalesce("extracted_status", F.lit("")), (("(?i)complet", "Completed"), ("(?i)activ|ongoing", "Active")), "No")
    return read(AUDIT).select("audit_row_id", text.before_first(F.col("source_line"), ("Project", "\n")).alias("head"), status.alias("status"))


@query(
    """WITH s AS (SELECT pdf_file, report_year, number, string_agg(extracted_project_name, ' ' ORDER BY number, audit_row_id) AS x FROM (
  SELECT pdf_path AS pdf_file, report_year, try_cast(project_number AS INTEGER) AS number, coalesce(extracted_project_name, '') AS extracted_project_name, audit_row_id FROM tif_legacy_pdf_project_audit_sample WHERE try_cast(project_number AS INTEGER) IS NOT NULL) GROUP BY ALL)
SELECT pdf_file, report_year, number AS project_number, trim(regexp_replace(x, '\\s+', ' ', 'g')) AS block FROM s"""
)
def project_blocks(read: Read) -> DataFrame:
    """A report is put together as ``Project N: ...`` passages and taken apart again."""
    n = F.col("project_number").try_cast("int")
    passages = read(AUDIT).filter(n.isNotNull()).groupBy(F.col("pdf_path").alias("pdf_file"), "report_year", n.alias("n")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("audit_row_id", F.coalesce("extracted_project_name", F.lit("")).alias("x")))), lambda s: s["x"]), " ").alias("x")
    )
    report = passages.groupBy("pdf_file", "report_year").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "x"))), lambda s: F.concat(F.lit("Project "), s["n"].cast("string"), F.lit(": "), s["x"])), "\n").alias("t"))
    return textmine.project_blocks(report, ["pdf_file", "report_year"], "t")


# --- links, markup, JSON -----------------------------------------------------------------------------------------------


@query(
    """WITH h AS (SELECT DISTINCT annual_report_pdf AS pdf FROM tif_legacy_annual_report_projects_2010_2016 WHERE annual_report_pdf IS NOT NULL)
SELECT 'https://reports.example/' || CAST(report_year AS VARCHAR) || '/' || pdf AS link, report_year, split_part(pdf, '/', -1) AS file_name, TRUE AS is_pdf
FROM (SELECT pdf, min(report_year) AS report_year FROM (SELECT DISTINCT annual_report_pdf AS pdf, report_year FROM tif_legacy_annual_report_projects_2010_2016 WHERE annual_report_pdf IS NOT NULL) GROUP BY pdf)"""
)
def html_links(read: Read) -> DataFrame:
    """Index pages are written as HTML, one per year, and crawled for PDF links; a PDF counts for its first page."""
    pages = read(LEGACY).filter("annual_report_pdf is not null").select("report_year", "annual_report_pdf").distinct()
    pages = pages.select("report_year", F.concat(F.lit("https://reports.example/"), F.col("report_year").cast("string"), F.lit("/index.html")).alias("page"), F.concat(F.lit('<p><a class="x" href="'), "annual_report_pdf", F.lit('">PDF</a> <a href="#top">up</a></p>')).alias("html"))
    links = pages.select("report_year", "page", F.explode(url.links_of(F.col("html"))).alias("raw")).withColumn("link", url.absolute(F.col("raw"), F.col("page"))).filter("link is not null")
    first = rank.first_per_key(links, ["raw"], [F.asc("report_year")])
    return first.select("link", "report_year", url.tail(F.col("link")).alias("file_name"), url.is_pdf(F.lit(""), F.col("link")).alias("is_pdf"))


@query("""SELECT override_id, trim(trim(regexp_replace(canonical_project_name, '\\s+', ' ', 'g')) || ' & ' || coalesce(active, '')) AS plain FROM project_name_overrides WHERE canonical_project_name IS NOT NULL""")
def strip_markup(read: Read) -> DataFrame:
    """Names are marked up and read again; what is markup in a name itself is escaped, and a name with brackets is in no link."""
    rows = read(OVERRIDES).filter("canonical_project_name is not null")
    name = F.col("canonical_project_name")
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("'", "&#39;")):
        name = F.replace(name, F.lit(char), F.lit(entity))
    link = F.when(name.rlike(r"[\[\]{}|]"), name).otherwise(F.concat(F.lit("[[Page|"), name, F.lit("]]")))
    marked = F.concat(F.lit("'''<b>"), link, F.lit("</b>'''{{cite}}<ref name=a>note</ref> &amp; "), F.coalesce("active", F.lit("")))
    return rows.select("override_id", text.strip_markup(marked).alias("plain"))


@query("""SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, user_id % 3 AS n_items, 1 + i AS item_index, 'path/' || i AS path FROM events, unnest(generate_series(0, 2)) AS t(i) WHERE i < user_id % 3""")
def json_explode(read: Read) -> DataFrame:
    record = F.from_json("props", "k bigint")
    items = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.struct(F.when(i < F.col("user_id") % 3, F.concat(F.lit("path/"), i.cast("string"))).otherwise("").alias("path")))
    rows = read("events").select("event_id", "event_type", record["k"].alias("k"), (F.col("user_id") % 3).alias("n_items"), items.alias("items"))
    return exploded_attachments(rows, ["event_id", "event_type", "k", "n_items"], "items", "path").withColumn("item_index", F.col("item_index").cast("long"))


@query("SELECT o_orderkey, concat_ws('=', 'q', replace(replace(o_orderpriority, ' ', '+'), '/', '%2F')) AS encoded FROM orders")
def url_encode(read: Read) -> DataFrame:
    return read("orders").select("o_orderkey", F.concat_ws("=", F.lit("q"), F.url_encode("o_orderpriority")).alias("encoded"))


# --- matching ---------------------------------------------------------------------------------------------------------------


@query(
    f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY report_year, {_tif("tif_number")}, project_number, {_norm("project_name")} ORDER BY legacy_row_id) AS k FROM tif_legacy_annual_report_projects_2010_2016)
SELECT legacy_row_id, {_norm("project_name")} AS project_key FROM r WHERE k = 1 AND {_norm("project_name")} <> ''"""
)
def dedupe_normalized(read: Read) -> DataFrame:
    rows = read(LEGACY).select("legacy_row_id", "report_year", ids.canonical_district(F.col("tif_number")).alias("t"), "project_number", text.norm_text(F.col("project_name")).alias("project_key")).filter("project_key <> ''")
    return rank.first_per_key(rows, ["report_year", "t", "project_number", "project_key"], [F.asc("legacy_row_id")]).select("legacy_row_id", "project_key")


@query(
    f"""WITH o AS (SELECT override_id, list_distinct(string_split({_norm("raw_project_name")}, ' ')) AS a, list_distinct(string_split({_norm("canonical_project_name")}, ' ')) AS b FROM project_name_overrides)
SELECT override_id, round(len(list_intersect(a, b)) / CAST(len(list_distinct(list_concat(a, b))) AS DOUBLE), 6) AS jaccard FROM o"""
)
def token_jaccard(read: Read) -> DataFrame:
    words = lambda c: F.split(text.norm_text(F.col(c)), " ")
    return read(OVERRIDES).select("override_id", F.round(similarity.jaccard(words("raw_project_name"), words("canonical_project_name")), 6).alias("jaccard"))


_TIER = f"""a AS (SELECT annual_row_id, {_tif("tif_number")} AS t, {_norm("project_name")} AS p, array_to_string(list_filter(string_split({_norm("project_name")}, ' '), lambda t: NOT list_contains({list(STOP_WORDS)!r}, t)), ' ') AS s FROM tif_annual_report_projects),
o AS (SELECT {_tif("tif_number")} AS t, {_norm("raw_project_name")} AS p, min_by(override_id, override_id) AS id FROM project_name_overrides WHERE lower(trim(coalesce(active, ''))) IN ('1', 'true', 'yes', 'y', 't') GROUP BY ALL),
l AS (SELECT {_tif("tif_number")} AS t, {_norm("project_name")} AS p, array_to_string(list_filter(string_split({_norm("project_name")}, ' '), lambda t: NOT list_contains({list(STOP_WORDS)!r}, t)), ' ') AS s, legacy_row_id AS id FROM tif_legacy_annual_report_projects_2010_2016),
e AS (SELECT t, p, min(id) AS id FROM l GROUP BY ALL), n AS (SELECT t, s, min(id) AS id FROM l GROUP BY ALL)"""


@query(
    f"""WITH {_TIER} SELECT annual_row_id, coalesce(o.id, e.id, n.id) AS target, CASE WHEN o.id IS NOT NULL THEN 'override' WHEN e.id IS NOT NULL THEN 'exact' WHEN n.id IS NOT NULL THEN 'simplified' ELSE 'unmatched' END AS match_status
FROM a LEFT JOIN o ON a.t = o.t AND a.p = o.p AND a.t <> '' AND a.p <> '' LEFT JOIN e ON a.t = e.t AND a.p = e.p AND a.t <> '' AND a.p <> '' LEFT JOIN n ON a.t = n.t AND a.s = n.s AND a.t <> '' AND a.s <> ''"""
)
def tiered_match(read: Read) -> DataFrame:
    t = ids.canonical_district(F.col("tif_number")).alias("t")
    name = lambda c: [text.norm_text(F.col(c)).alias("p"), text.without_words(F.col(c), STOP_WORDS).alias("s")]
    legacy = read(LEGACY).select(t, *name("project_name"), F.col("legacy_row_id").alias("target"))
    overrides = read(OVERRIDES).filter(ids.truthy(F.col("active"))).select(t, *name("raw_project_name"), F.col("override_id").alias("target"))
    left = read(ANNUAL).select("annual_row_id", t, *name("project_name"))
    tiers = [("override", overrides, ["t", "p"]), ("exact", legacy, ["t", "p"]), ("simplified", legacy, ["t", "s"])]
    return match.tiered_match(left, tiers, [F.asc("target")], "target").select("annual_row_id", "target", "match_status")


@query()
def fuzzy_best(read: Read) -> DataFrame:
    """Best legacy name of the same district by Ratcliff-Obershelp likeness, for names of the annual table; tested against difflib."""
    t = ids.canonical_district(F.col("tif_number")).alias("t")
    left = read(ANNUAL).select(t, text.norm_text(F.col("project_name")).alias("a")).filter("a <> '' and t <> ''").distinct().withColumn("id", F.concat_ws("|", "t", "a"))
    right = read(LEGACY).select(t, text.norm_text(F.col("project_name")).alias("b")).filter("b <> '' and t <> ''").distinct().withColumn("rid", F.col("b"))
    return match.best_fuzzy(left, right, ["t"], "id", [("a", "b")], "rid", 0.82)


@query(
    f"""WITH d AS (SELECT DISTINCT tif_number AS entry, {_norm("n")} AS form, replace(replace({_norm("n")}, ' street', ''), ' avenue', '') AS loose, {_norm("n")} = {_norm("canonical_tif_district")} AS canonical
  FROM (SELECT tif_number, canonical_tif_district, unnest(string_split_regex(district_name_variants, '\\s*;\\s*')) AS n FROM tif_district_universe)),
e AS (SELECT form, first(entry ORDER BY canonical DESC, entry) AS entry FROM d WHERE form <> '' GROUP BY form), l AS (SELECT loose, first(entry ORDER BY canonical DESC, entry) AS entry FROM d WHERE loose <> '' GROUP BY loose),
c AS (SELECT DISTINCT district_name_raw, {_norm("district_name_raw")} AS form, replace(replace({_norm("district_name_raw")}, ' street', ''), ' avenue', '') AS loose FROM tif_district_legislation_candidates WHERE district_name_raw IS NOT NULL)
SELECT district_name_raw, coalesce(e.entry, l.entry) AS entry, CASE WHEN e.entry IS NOT NULL THEN 'exact' WHEN l.entry IS NOT NULL THEN 'loose' ELSE 'unmatched' END AS rung
FROM c LEFT JOIN e ON c.form = e.form LEFT JOIN l ON c.loose = l.loose"""
)
def district_ladder(read: Read) -> DataFrame:
    loose = lambda c: F.replace(F.replace(text.norm_text(c), F.lit(" street"), F.lit("")), F.lit(" avenue"), F.lit(""))
    listed = read(UNIVERSE).select(F.col("tif_number").alias("entry"), "canonical_tif_district", F.explode(F.split("district_name_variants", r"\s*;\s*")).alias("n"))
    listed = listed.select("entry", text.norm_text(F.col("n")).alias("form"), loose(F.col("n")).alias("loose"), (text.norm_text(F.col("n")) == text.norm_text(F.col("canonical_tif_district"))).cast("int").alias("canonical")).distinct()
    names = read(CANDIDATES).filter("district_name_raw is not null").select("district_name_raw").distinct()
    return match.name_ladder(names.select("district_name_raw", text.norm_text(F.col("district_name_raw")).alias("form"), loose(F.col("district_name_raw")).alias("loose")), listed, "district_name_raw")


@query()
def name_audit(read: Read) -> DataFrame:
    """Likeness of the extracted name and the head of its passage, with a verdict."""
    rows = read(AUDIT).select("audit_row_id", text.norm_text(F.col("extracted_project_name")).alias("a"), text.norm_text(text.before_first(F.col("source_line"), (" Project",))).alias("b"))
    return match.name_audit(rows, "a", "b", 0.88).select("audit_row_id", "score", "verdict")


@query()
def greedy_pairs(read: Read) -> DataFrame:
    """Projected mentions paired one to one with the nearest realized mention of the document; tested against plain Python."""
    return joins.greedy_pairs(read(MENTIONS).filter("pdf_file is not null and metric_type is not null"), ["pdf_file", "metric_type"], "status", "projected", "realized", "page_number", "snippet", "mention_id")


_POSITIONS = f"SELECT nullif({_tif('tif_number')}, '') AS tif_key, report_year, project_number, count(*) AS n FROM"


@query(
    f"""WITH a AS ({_POSITIONS} tif_annual_report_projects GROUP BY ALL), b AS ({_POSITIONS} tif_legacy_annual_report_projects_2010_2016 GROUP BY ALL)
SELECT coalesce(a.tif_key, b.tif_key) AS tif_key, coalesce(a.report_year, b.report_year) AS report_year, coalesce(a.project_number, b.project_number) AS project_number, a.n AS left_value, b.n AS right_value,
  CASE WHEN a.n IS NULL THEN 'right_only' WHEN b.n IS NULL THEN 'left_only' WHEN a.n = b.n THEN 'same' ELSE 'differs' END AS verdict
FROM a FULL JOIN b ON a.tif_key = b.tif_key AND a.report_year = b.report_year AND a.project_number = b.project_number"""
)
def full_outer_compare(read: Read) -> DataFrame:
    """Both whole tables, the year in the key; rows that lack a part of the key meet nothing and are on their side only."""
    keys = ["tif_key", "report_year", "project_number"]
    key = F.nullif(ids.canonical_district(F.col("tif_number")), F.lit(""))
    of = lambda t: read(t).withColumn("tif_key", key).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return joins.compare_outer(of(ANNUAL), of(LEGACY), keys, "n")


@query(
    f"""WITH e AS (SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM (SELECT {_tif("tif_number")} || ':' || {_norm("raw_project_name")} AS a, {_tif("tif_number")} || ':' || {_norm("canonical_project_name")} AS b FROM project_name_overrides) WHERE a <> b),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e)
SELECT node, min(root) AS component FROM (WITH RECURSIVE w(node, root) AS (SELECT a, a FROM u UNION SELECT u.b, w.root FROM w JOIN u ON w.node = u.a) SELECT node, root FROM w) GROUP BY node"""
)
def linked_names(read: Read) -> DataFrame:
    name = lambda c: F.concat_ws(":", ids.canonical_district(F.col("tif_number")), text.norm_text(F.col(c)))
    return connected_components(read(OVERRIDES).select(name("raw_project_name").alias("a"), name("canonical_project_name").alias("b")))


# --- cumulative tables --------------------------------------------------------------------------------------------------------


@query(
    """WITH s AS (SELECT matter_id, detail_fetched, matter_row_id FROM tif_elms_matters WHERE matter_row_id % 2 = 0),
b AS (SELECT matter_id, detail_fetched, matter_row_id, row_number() OVER (PARTITION BY trim(matter_id), detail_fetched ORDER BY matter_row_id) AS k FROM tif_elms_matters WHERE matter_row_id % 2 = 1 AND trim(coalesce(matter_id, '')) <> '')
SELECT * FROM s UNION ALL SELECT matter_id, detail_fetched, matter_row_id FROM b WHERE k = 1 AND NOT EXISTS (SELECT 1 FROM s WHERE trim(s.matter_id) = trim(b.matter_id) AND s.detail_fetched IS NOT DISTINCT FROM b.detail_fetched)"""
)
def append_unique(read: Read) -> DataFrame:
    """The table comes in two halves; the second is appended by key. The halves are the two batches that the operator is about."""
    rows = read(MATTERS).select("matter_id", "detail_fetched", "matter_row_id")
    half = F.col("matter_row_id") % 2
    return state.append_unique(rows.filter(half == 0), rows.filter((half == 1) & (F.trim(F.coalesce("matter_id", F.lit(""))) != "")), ["matter_id", "detail_fetched"], [F.asc("matter_row_id")])


@query(
    """WITH p AS (SELECT matter_id, min('run1') AS first_seen_run FROM tif_elms_matters WHERE detail_fetched = 0 GROUP BY matter_id), f AS (SELECT matter_id, max(matter_status) AS matter_status FROM tif_elms_matters WHERE detail_fetched = 1 GROUP BY matter_id)
SELECT f.matter_id, matter_status, coalesce(first_seen_run, 'run2') AS first_seen_run, 'run2' AS last_checked_run FROM f LEFT JOIN p ON f.matter_id = p.matter_id"""
)
def inventory_first_seen(read: Read) -> DataFrame:
    prior = read(MATTERS).filter("detail_fetched = 0").select("matter_id", F.lit("run1").alias("first_seen_run"))
    fresh = read(MATTERS).filter("detail_fetched = 1").groupBy("matter_id").agg(F.max("matter_status").alias("matter_status"))
    return state.carry_first_seen(prior, fresh, ["matter_id"], F.lit("run2"))


@query(
    """WITH s AS (SELECT matter_id, max(matter_status) AS st, max(attachments_count) AS n FROM tif_elms_matters WHERE detail_fetched = 0 GROUP BY 1), c AS (SELECT matter_id, max(matter_status) AS st, max(attachments_count) AS n FROM tif_elms_matters WHERE detail_fetched = 1 GROUP BY 1)
SELECT coalesce(c.matter_id, s.matter_id) AS matter_id, coalesce(c.st, s.st) AS matter_status, coalesce(c.n, s.n) AS attachments_count FROM s FULL JOIN c ON s.matter_id IS NOT DISTINCT FROM c.matter_id"""
)
def inventory_upsert(read: Read) -> DataFrame:
    of = lambda d: read(MATTERS).filter(F.col("detail_fetched") == d).groupBy("matter_id").agg(F.max("matter_status").alias("matter_status"), F.max("attachments_count").alias("attachments_count"))
    return state.upsert(of(0), of(1), ["matter_id"])


@query(
    """WITH r AS (SELECT district_candidate_id, district_match_status AS review_status, matched_tif_number AS answer FROM tif_district_legislation_candidates WHERE district_match_status IS NOT NULL),
d AS (SELECT * FROM r WHERE trim(review_status) <> '' AND review_status <> 'unmatched'), g AS (SELECT district_candidate_id, 'needs_review' AS review_status, district_name_raw AS answer FROM tif_district_legislation_candidates)
SELECT * FROM d UNION ALL SELECT * FROM g WHERE district_candidate_id NOT IN (SELECT district_candidate_id FROM d)"""
)
def review_merge(read: Read) -> DataFrame:
    reviewed = read(CANDIDATES).filter("district_match_status is not null").select("district_candidate_id", F.col("district_match_status").alias("review_status"), F.col("matched_tif_number").alias("answer"))
    generated = read(CANDIDATES).select("district_candidate_id", F.lit("needs_review").alias("review_status"), F.col("district_name_raw").alias("answer"))
    return state.keep_reviewed(generated, reviewed, "district_candidate_id", "review_status", open_status="unmatched")


@query(
    """SELECT coalesce(nullif(matched_tif_number, ''), 'unmatched:' || coalesce(lower(trim(district_name_raw)), '')) AS k, min(meeting_date) AS first_meeting, first(district_candidate_id ORDER BY meeting_date, district_candidate_id) AS first_candidate,
  count(*) AS candidates, count(*) FILTER (WHERE initial_or_revision_guess = 'initial_designation') AS initial, count(DISTINCT district_name_raw) AS spellings
FROM tif_district_legislation_candidates WHERE meeting_date IS NOT NULL GROUP BY 1"""
)
def legislation_rollup(read: Read) -> DataFrame:
    rows = read(CANDIDATES).filter("meeting_date is not null").withColumn("k", F.coalesce(F.nullif(F.col("matched_tif_number"), F.lit("")), F.concat(F.lit("unmatched:"), F.coalesce(F.lower(F.trim("district_name_raw")), F.lit("")))))
    return rows.groupBy("k").agg(
        F.min("meeting_date").alias("first_meeting"),
        F.min_by("district_candidate_id", F.struct("meeting_date", "district_candidate_id")).alias("first_candidate"),
        F.count(F.lit(1)).alias("candidates"),
        F.count(F.when(F.col("initial_or_revision_guess") == "initial_designation", 1)).alias("initial"),
        F.countDistinct("district_name_raw").alias("spellings"),
    )


@query(
    """WITH s AS (SELECT pdf_path, min(report_year) AS y, count(*) AS n, max(CASE WHEN source_mode = 'ocr' THEN 1 ELSE 0 END) AS ocr FROM tif_legacy_pdf_project_audit_sample WHERE pdf_path IS NOT NULL GROUP BY 1),
t AS (SELECT *, CASE WHEN ocr = 1 THEN 0 WHEN n >= 3 THEN 1 ELSE 2 END AS stratum FROM s)
SELECT pdf_path, y, n, stratum FROM t ORDER BY stratum, n DESC, pdf_path LIMIT 50"""
)
def stratified_sample(read: Read) -> DataFrame:
    """The audit sample of 50 documents, riskiest strata first."""
    pdfs = read(AUDIT).filter("pdf_path is not null").groupBy("pdf_path").agg(F.min("report_year").alias("y"), F.count(F.lit(1)).alias("n"), F.max((F.coalesce(F.col("source_mode") == "ocr", F.lit(False))).cast("int")).alias("ocr"))
    stratum = F.when(F.col("ocr") == 1, 0).when(F.col("n") >= 3, 1).otherwise(2)
    return rank.stratified_sample(pdfs, stratum, ["pdf_path"], [F.desc("n"), F.asc("pdf_path")], 50).drop("ocr")


@query(
    """SELECT journal_pdf, min(meeting_date) AS meeting_date FROM tif_district_legislation_candidates WHERE try_cast(meeting_year AS INTEGER) BETWEEN 1985 AND 1995 AND journal_pdf IS NOT NULL AND meeting_date IS NOT NULL GROUP BY 1"""
)
def manifest_rows(read: Read) -> DataFrame:
    rows = read(CANDIDATES).filter("meeting_date is not null").groupBy("journal_pdf").agg(F.min("meeting_date").alias("meeting_date"), F.min(F.col("meeting_year").try_cast("int")).alias("y"))
    return manifest(rows, "y", 1985, 1995, None, F.col("journal_pdf").isNotNull(), "journal_pdf", "meeting_date").select("journal_pdf", "meeting_date")


@query(
    """WITH m AS (SELECT DISTINCT pdf_file, regexp_extract(pdf_file, '^matter_(\\d+)_(\\d+)\\.pdf$', 1) AS a, regexp_extract(pdf_file, '^matter_(\\d+)_(\\d+)\\.pdf$', 2) AS b FROM tif_pdf_projected_realized_mentions WHERE pdf_file IS NOT NULL),
g AS (SELECT pdf_file, min(matter_id) AS own FROM tif_pdf_projected_realized_mentions WHERE matter_id IS NOT NULL AND pdf_file IS NOT NULL GROUP BY 1)
SELECT m.pdf_file, coalesce(g.own, nullif(m.a, ''), '') AS matter_id, coalesce(nullif(m.b, ''), '') AS attachment_id, CASE WHEN g.own IS NOT NULL THEN 'metadata' WHEN m.a <> '' THEN 'file name' ELSE 'none' END AS tier
FROM m LEFT JOIN g ON m.pdf_file = g.pdf_file"""
)
def document_metadata(read: Read) -> DataFrame:
    """Metadata of a document: as stored, else from its file name, else blank."""
    name = r"^matter_(\d+)_(\d+)\.pdf$"
    files = read(MENTIONS).filter("pdf_file is not null").select("pdf_file", F.regexp_extract("pdf_file", name, 1).alias("a"), F.regexp_extract("pdf_file", name, 2).alias("b")).distinct()
    own = read(MENTIONS).filter("matter_id is not null and pdf_file is not null").groupBy("pdf_file").agg(F.min("matter_id").alias("own"))
    rows = files.join(own, "pdf_file", "left")
    return rows.select("pdf_file", F.coalesce("own", F.nullif(F.col("a"), F.lit("")), F.lit("")).alias("matter_id"), F.col("b").alias("attachment_id"), F.when(F.col("own").isNotNull(), "metadata").when(F.col("a") != "", "file name").otherwise("none").alias("tier"))


@query(
    """WITH n AS (SELECT boundary_row_id, list_transform(regexp_extract_all(the_geom, '-?[0-9.]+'), lambda x: CAST(x AS DOUBLE)) AS v FROM tif_boundary_districts_historical)
SELECT boundary_row_id, round((v[1] + v[3] + v[5]) / 3, 6) AS lon, round((v[2] + v[4] + v[6]) / 3, 6) AS lat, CASE WHEN v IS NOT NULL THEN 1 END AS polygons FROM n"""
)
def polygon_centroids(read: Read) -> DataFrame:
    """Centroids of boundary polygons. Those of the test tables are triangles, for which SQL has the closed form; others are tested on rows made by hand."""
    return read(BOUNDARIES).select("boundary_row_id", geo.centroid_of(F.col("the_geom")).alias("c")).select("boundary_row_id", F.round("c.lon", 6).alias("lon"), F.round("c.lat", 6).alias("lat"), F.col("c.polygons").alias("polygons"))


@query(
    f"""WITH s AS (SELECT {_tif("tif_number")} AS tif_key, report_year, status, row_number() OVER (PARTITION BY {_tif("tif_number")}, report_year ORDER BY legacy_row_id DESC) AS k FROM tif_legacy_annual_report_projects_2010_2016)
SELECT a.annual_row_id, coalesce(s.status, 'not reported') AS last_status FROM tif_annual_report_projects a LEFT JOIN s ON {_tif("a.tif_number")} = s.tif_key AND a.report_year = s.report_year AND s.k = 1"""
)
def last_wins_status(read: Read) -> DataFrame:
    """Status lookup where the last of repeated rows counts, with a default."""
    key = ids.canonical_district(F.col("tif_number")).alias("tif_key")
    last = rank.last_per_key(read(LEGACY).select(key, "report_year", "status", "legacy_row_id"), ["tif_key", "report_year"], ["legacy_row_id"]).drop("legacy_row_id")
    return read(ANNUAL).select("annual_row_id", key, "report_year").join(last, ["tif_key", "report_year"], "left").select("annual_row_id", F.coalesce("status", F.lit("not reported")).alias("last_status"))


@query(
    """WITH r AS (SELECT DISTINCT matter_id FROM tif_elms_matters WHERE detail_fetched = 1), m AS (SELECT matter_row_id, matter_id, file_year FROM tif_elms_matters WHERE detail_fetched = 0)
SELECT matter_row_id, matter_id FROM m WHERE (file_year IS NULL OR file_year >= 2012) AND NOT EXISTS (SELECT 1 FROM r WHERE r.matter_id = m.matter_id)"""
)
def unseen_since(read: Read) -> DataFrame:
    """Rows not seen before, from a year on; rows without a year pass."""
    rows = read(MATTERS).filter("detail_fetched = 0 and (file_year is null or file_year >= 2012)").select("matter_row_id", "matter_id")
    return state.unseen(rows, read(MATTERS).filter("detail_fetched = 1"), key="matter_id")


@query(
    """WITH a AS (SELECT matter_id, matter_title, max(file_year) AS file_year FROM tif_elms_matters GROUP BY ALL)
SELECT m.matter_row_id, m.record_number, a.matter_title, a.file_year FROM tif_elms_matters m JOIN a ON m.matter_id = a.matter_id AND m.matter_title = a.matter_title"""
)
def denormalized_rows(read: Read) -> DataFrame:
    """Child rows with their parent's columns."""
    parent = read(MATTERS).groupBy("matter_id", "matter_title").agg(F.max("file_year").alias("file_year"))
    return read(MATTERS).select("matter_row_id", "record_number", "matter_id", "matter_title").join(parent, ["matter_id", "matter_title"]).select("matter_row_id", "record_number", "matter_title", "file_year")


@query(
    """SELECT district_candidate_id, CASE review_priority WHEN 'highest' THEN 0 WHEN 'high' THEN 1 WHEN 'medium' THEN 2 WHEN 'low' THEN 3 ELSE 9 END AS rank,
  coalesce(try_cast(nullif(regexp_extract(source_start_page, '\\d+', 0), '') AS BIGINT), 999999) AS page FROM tif_district_legislation_candidates"""
)
def rank_codes(read: Read) -> DataFrame:
    """Sort keys: a rank-coded label, and a number with a high default."""
    code = F.when(F.col("review_priority") == "highest", 0).when(F.col("review_priority") == "high", 1).when(F.col("review_priority") == "medium", 2).when(F.col("review_priority") == "low", 3).otherwise(9)
    return read(CANDIDATES).select("district_candidate_id", code.alias("rank"), F.coalesce(coerce.first_int(F.regexp_extract("source_start_page", r"\d+", 0)), F.lit(999999)).alias("page"))


_ADDRESS = r"[0-9]{1,5} (?:North|South|East|West) [A-Z][a-z]+ (?:Street|Avenue|Boulevard|Parkway)"


@query(
    f"""SELECT matter_row_id, array_to_string(list_sort(list_distinct(regexp_extract_all(matter_title, '{_ADDRESS}'))), '; ') AS addresses,
  array_to_string(list_sort(list_distinct(regexp_extract_all(matter_title, '\\$[0-9][0-9,]*'))), '; ') AS dollars FROM tif_elms_matters"""
)
def extracted_fields(read: Read) -> DataFrame:
    all_of = lambda p: F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all("matter_title", F.lit(p), F.lit(0)))), "; ")
    return read(MATTERS).select("matter_row_id", all_of(_ADDRESS).alias("addresses"), all_of(r"\$[0-9][0-9,]*").alias("dollars"))


@query(
    f"""WITH {_LINES}, a AS (SELECT doc_id, line_no, line, regexp_matches(line, '(?i)ordinance|agreement') AS is_a, regexp_matches(line, '(?i)whereas') AS is_s FROM l WHERE line <> ''),
b AS (SELECT *, sum(CASE WHEN is_a THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS block_no FROM a),
c AS (SELECT *, row_number() OVER (PARTITION BY doc_id, block_no ORDER BY line_no) AS r, sum(CASE WHEN is_s AND NOT is_a THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, block_no ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS s FROM b WHERE block_no > 0)
SELECT doc_id, CAST(block_no AS BIGINT) AS block_no, string_agg(line, ' ' ORDER BY line_no) AS block FROM c WHERE r <= 3 AND s = 0 GROUP BY ALL"""
)
def anchor_blocks(read: Read) -> DataFrame:
    return textmine.anchor_blocks(textmine.lines(read("documents"), ["doc_id"], "text"), ["doc_id"], "line_no", "line", "(?i)ordinance|agreement", "(?i)whereas", 3)


@query(
    """WITH f AS (SELECT pdf_file, min(page_number) AS section_start FROM tif_pdf_projected_realized_mentions WHERE regexp_matches(snippet, '(?i)construction period') GROUP BY 1)
SELECT m.mention_id, f.section_start FROM tif_pdf_projected_realized_mentions m JOIN f ON m.pdf_file = f.pdf_file WHERE m.page_number >= section_start AND m.page_number < section_start + 3"""
)
def section_pages(read: Read) -> DataFrame:
    return textmine.section_pages(read(MENTIONS), ["pdf_file"], "page_number", "snippet", "(?i)construction period", 3).select("mention_id", "section_start")


@query()
def project_suggestions(read: Read) -> DataFrame:
    """For each legacy name the likeliest of all names of the overrides, helped by the district; tested against plain Python."""
    t = ids.canonical_district(F.col("tif_number")).alias("place")
    left = read(LEGACY).select(text.norm_text(F.col("project_name")).alias("name"), t).filter("name <> ''").distinct().withColumn("id", F.concat_ws("|", "place", "name"))
    right = read(OVERRIDES).select("override_id", text.norm_text(F.col("canonical_project_name")).alias("name"), t)
    return match.likeliest(left, right, "id", "name", "place", "override_id", 0.72, 0.9)

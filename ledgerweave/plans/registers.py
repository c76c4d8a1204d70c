"""Queries over the test tables: registers, look-ups, proceedings and reports, each with the SQL that says the same where SQL can."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerweave.functions import coerce, ids, text
from ledgerweave.operators import aggregate, joins, journal, match, rank, reports, textmine, universe
from ledgerweave.plans.queries import (
    ANNUAL, AUDIT, BOUNDARIES, CANDIDATES, LEGACY, MATTERS, MENTIONS, OVERRIDES, SQL, UNIVERSE, Read, _as_of, _as_of_rows, _district_phrases, _HITS, _int, _norm, _tif, _year, containment_hits, district_year_sums, lead_argmax, query, tenure_resolve,
)
from ledgerweave.sources.files import manifest
from ledgerweave.sources.remote import existing_union, followed

def _key():
    return ids.canonical_district(F.col("tif_number"))


_TRUE = "lower(trim(coalesce(active, ''))) IN ('1', 'true', 'yes', 'y', 't')"


def _places(t: str, pattern: str) -> str:
    """SQL list of ``{at, hit}`` of all matches, ``at`` from 0."""
    h, p = f"regexp_extract_all({t}, '{pattern}')", f"string_split_regex({t}, '{pattern}')"
    n = lambda xs: f"coalesce(list_sum(list_transform({xs}, lambda x: length(x))), 0)"
    return f"list_transform(generate_series(1, len({h})), lambda i: {{'at': CAST({n(f'({p})[1:i]')} + {n(f'({h})[1:i-1]')} AS BIGINT), 'hit': ({h})[i]}})"


# --- projections -------------------------------------------------------------------------------------------------


@query(
    f"""SELECT annual_row_id, {_tif("tif_number")} AS tif_key, {_norm("project_name")} AS project_key, coalesce(report_year, 0) AS report_year, trim(coalesce(status, '')) AS status,
  CASE WHEN lower(trim(coalesce(ongoing, ''))) IN ('1', 'true', 'yes', 'y', 't') THEN 1 ELSE 0 END AS ongoing, current_year_payments AS paid, estimated_next_year_payments AS planned,
  {_int("current_year_new_deals")} AS deals, private_funds, private_funds_to_completion FROM tif_annual_report_projects"""
)
def annual_normalized(read: Read):
    return read(ANNUAL).select(
        "annual_row_id", _key().alias("tif_key"), text.norm_text(F.col("project_name")).alias("project_key"), F.coalesce("report_year", F.lit(0)).alias("report_year"), F.trim(F.coalesce("status", F.lit(""))).alias("status"),
        ids.truthy(F.col("ongoing")).cast("int").alias("ongoing"), F.col("current_year_payments").alias("paid"), F.col("estimated_next_year_payments").alias("planned"), coerce.first_int(F.col("current_year_new_deals")).alias("deals"),
        "private_funds", "private_funds_to_completion",
    )


@query(
    f"""SELECT override_id AS id, {_tif("tif_number")} AS tif_key, {_norm("canonical_project_name")} AS project_key, {_int("master_id")} AS master_number, trim(coalesce(canonical_project_id, '')) AS project_id,
  CASE WHEN {_TRUE} THEN 1 ELSE 0 END AS is_active FROM project_name_overrides"""
)
def master_normalized(read: Read):
    return read(OVERRIDES).select(
        F.col("override_id").alias("id"), _key().alias("tif_key"), text.norm_text(F.col("canonical_project_name")).alias("project_key"), coerce.first_int(F.col("master_id")).alias("master_number"), F.trim(F.coalesce("canonical_project_id", F.lit(""))).alias("project_id"),
        ids.truthy(F.col("active")).cast("int").alias("is_active"),
    )


@query("SELECT matter_id AS id, record_number AS file, matter_title AS title, matter_type AS type, matter_status AS status, controlling_body AS body, introduction_date AS introduced, final_action_date AS passed FROM tif_elms_matters")
def renamed_matters(read: Read):
    names = {"matter_id": "id", "record_number": "file", "matter_title": "title", "matter_type": "type", "matter_status": "status", "controlling_body": "body", "introduction_date": "introduced", "final_action_date": "passed"}
    return read(MATTERS).select(*[F.col(a).alias(b) for a, b in names.items()])


@query("SELECT DISTINCT journal_pdf FROM tif_district_legislation_candidates WHERE contains(lower(journal_pdf), 'journals') AND contains(lower(journal_pdf), '199') AND lower(journal_pdf) LIKE '%\\_regular.pdf' ESCAPE '\\'")
def url_filter(read: Read):
    return read(CANDIDATES).filter(followed(F.col("journal_pdf"), ("journals", "199"), "_regular.pdf")).select("journal_pdf").distinct()


@query(
    """SELECT matter_row_id, coalesce(contains(lower(matter_title), 'tax increment financing') OR contains(lower(matter_title), 'allocation notes'), FALSE)
  OR (contains(lower(coalesce(keyword_hits, '')), 'tax increment') AND coalesce(regexp_matches(lower(matter_title), 'project\\s+area|district'), FALSE)) AS legislation FROM tif_elms_matters"""
)
def legislation_windows(read: Read):
    """Whether a text concerns a district: by a phrase, or by a tagged term and wording together."""
    low = F.lower(F.coalesce("matter_title", F.lit("")))
    phrase = low.contains("tax increment financing") | low.contains("allocation notes")
    tagged = F.lower(F.coalesce("keyword_hits", F.lit(""))).contains("tax increment") & low.rlike(r"project\s+area|district")
    return read(MATTERS).select("matter_row_id", (phrase | tagged).alias("legislation"))


# --- look-ups ------------------------------------------------------------------------------------------------------


@query(
    f"""WITH w AS ({_as_of(_year)}), b AS (SELECT boundary_row_id, shape_area, shape_leng FROM tif_boundary_districts_historical)
SELECT a.annual_row_id, CASE WHEN a.private_funds IS NOT NULL AND a.private_funds_to_completion IS NOT NULL THEN 'own' WHEN b.shape_area IS NOT NULL AND b.shape_leng IS NOT NULL THEN 'district' ELSE 'missing' END AS tier,
  CASE WHEN a.private_funds IS NOT NULL AND a.private_funds_to_completion IS NOT NULL THEN a.private_funds WHEN b.shape_area IS NOT NULL AND b.shape_leng IS NOT NULL THEN b.shape_area END AS x,
  CASE WHEN a.private_funds IS NOT NULL AND a.private_funds_to_completion IS NOT NULL THEN a.private_funds_to_completion WHEN b.shape_area IS NOT NULL AND b.shape_leng IS NOT NULL THEN b.shape_leng END AS y
FROM tif_annual_report_projects a LEFT JOIN w ON a.tif_number IS NOT NULL AND {_tif("a.tif_number")} = w.tif_key AND a.report_year IS NOT DISTINCT FROM w.report_year LEFT JOIN b ON w.boundary_row_id = b.boundary_row_id"""
)
def geometry_tiers(read: Read):
    """A pair of values, both needed: a row's own, else that of its district's boundary as of the year, else none."""
    best = _as_of_rows(read, coerce.year_of).filter("boundary_row_id is not null").join(read(BOUNDARIES).select("boundary_row_id", "shape_area", "shape_leng"), "boundary_row_id")
    rows = read(ANNUAL).select("annual_row_id", F.when(F.col("tif_number").isNotNull(), _key()).alias("k"), F.col("report_year").alias("yr"), "private_funds", "private_funds_to_completion")
    both = rows.join(best, (F.col("k") == F.col("tif_key")) & F.col("yr").eqNullSafe(F.col("report_year")), "left")
    own = F.col("private_funds").isNotNull() & F.col("private_funds_to_completion").isNotNull()
    area = F.col("shape_area").isNotNull() & F.col("shape_leng").isNotNull()
    pick = lambda a, b: F.when(own, F.col(a)).when(area, F.col(b))
    return both.select("annual_row_id", F.when(own, "own").when(area, "district").otherwise("missing").alias("tier"), pick("private_funds", "shape_area").alias("x"), pick("private_funds_to_completion", "shape_leng").alias("y"))


@query(
    f"""WITH w AS ({_as_of(_year)}), c AS (SELECT {_tif("tif_number")} AS tif_key, report_year, count(*) AS projects FROM tif_annual_report_projects WHERE tif_number IS NOT NULL AND report_year IS NOT NULL GROUP BY ALL)
SELECT c.tif_key, c.report_year, projects, boundary_row_id, as_of FROM c JOIN w ON c.tif_key = w.tif_key AND c.report_year = w.report_year"""
)
def district_year_boundaries(read: Read):
    """Counts per district and year with the boundary of that year."""
    counts = aggregate.counts_and_sums(read(ANNUAL).filter("tif_number is not null").withColumn("tif_key", _key()), ["tif_key", "report_year"], {}, "projects")
    return counts.join(_as_of_rows(read, coerce.year_of), ["tif_key", "report_year"]).select("tif_key", "report_year", "projects", "boundary_row_id", "as_of")


@query(
    f"""WITH t AS (SELECT {_tif("ref")} AS tif_key, tif_name, boundary_row_id, {_year("approval_d")} AS s, {_year("expiration")} AS t FROM tif_boundary_districts_historical),
e AS (SELECT tif_key, tif_name, boundary_row_id, s, CAST(unnest(generate_series(greatest(s, 1998), least(coalesce(t, 2024), 2024))) AS INTEGER) AS year FROM t WHERE s IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY tif_key, year ORDER BY s DESC, boundary_row_id DESC) AS k FROM e)
SELECT a.annual_row_id, coalesce(r.tif_name, '') AS holder FROM tif_annual_report_projects a LEFT JOIN r ON {_tif("a.tif_number")} = r.tif_key AND a.report_year = r.year AND r.k = 1"""
)
def tenure_lookup(read: Read):
    """Who held a place in a year, empty where nobody is known."""
    held = tenure_resolve(read).select("tif_key", F.col("year").alias("report_year"), F.col("tif_name").alias("holder"))
    return universe.lookup(read(ANNUAL).select("annual_row_id", _key().alias("tif_key"), "report_year"), held, ["tif_key", "report_year"], {"holder": ""}).select("annual_row_id", "holder")


@query(
    f"""WITH s AS (SELECT {_tif("tif_number")} AS tif_key, report_year, {_norm("project_type")} AS kind, count(*) AS n, round(sum(coalesce(current_year_payments, 0)), 2) AS paid FROM tif_annual_report_projects WHERE report_year IS NOT NULL GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY tif_key, report_year ORDER BY paid DESC, n DESC, kind DESC) AS k FROM s),
l AS (SELECT {_tif("tif_number")} AS tif_key, report_year, count(*) AS rows FROM tif_legacy_annual_report_projects_2010_2016 WHERE report_year IS NOT NULL GROUP BY ALL)
SELECT l.tif_key, l.report_year, l.rows, coalesce(r.kind, '') AS lead_kind, coalesce(r.n, 0) AS lead_projects, coalesce(r.paid, 0.0) AS lead_paid FROM l LEFT JOIN r ON l.tif_key = r.tif_key AND l.report_year = r.report_year AND r.k = 1"""
)
def lead_lookup(read: Read):
    legacy = aggregate.counts_and_sums(read(LEGACY).withColumn("tif_key", _key()), ["tif_key", "report_year"], {}, "rows")
    return universe.lookup(legacy, lead_argmax(read), ["tif_key", "report_year"], {"lead_kind": "", "lead_projects": 0, "lead_paid": 0.0})


@query(
    """WITH g AS (SELECT mention_id, pdf_file, CASE WHEN regexp_extract(tif_number_guess, '(\\d{1,3})', 1) <> '' THEN 'T-' || lpad(regexp_extract(tif_number_guess, '(\\d{1,3})', 1), 3, '0') END AS own FROM tif_pdf_projected_realized_mentions),
o AS (SELECT pdf_file, min(own) AS only_one FROM g WHERE pdf_file IS NOT NULL AND own IS NOT NULL GROUP BY 1 HAVING count(DISTINCT own) = 1)
SELECT mention_id, coalesce(own, only_one) AS number, CASE WHEN own IS NOT NULL THEN 'own' WHEN only_one IS NOT NULL THEN 'file' ELSE 'none' END AS origin FROM g LEFT JOIN o ON g.pdf_file = o.pdf_file"""
)
def guarded_resolution(read: Read):
    """A row's own number goes before the one that all rows of its file agree on."""
    rows = read(MENTIONS).select("mention_id", "pdf_file", ids.district_number(F.col("tif_number_guess")).alias("own"))
    known = joins.only_value(rows.filter("pdf_file is not null"), "pdf_file", "own", "only_one")
    return rows.join(known, "pdf_file", "left").select("mention_id", F.coalesce("own", "only_one").alias("number"), F.when(F.col("own").isNotNull(), "own").when(F.col("only_one").isNotNull(), "file").otherwise("none").alias("origin"))


@query(
    f"""WITH o AS (SELECT DISTINCT {_tif("tif_number")} AS t, {_norm("raw_project_name")} AS p FROM project_name_overrides WHERE {_TRUE})
SELECT a.annual_row_id, CASE WHEN o.t IS NULL THEN 0 ELSE 1 END AS overridden FROM tif_annual_report_projects a LEFT JOIN o ON {_tif("a.tif_number")} = o.t AND {_norm("a.project_name")} = o.p"""
)
def override_flag(read: Read):
    name = lambda c: [_key().alias("t"), text.norm_text(F.col(c)).alias("p")]
    listed = read(OVERRIDES).filter(ids.truthy(F.col("active"))).select(*name("raw_project_name"))
    return universe.flag(read(ANNUAL).select("annual_row_id", *name("project_name")), listed, ["t", "p"], "overridden").select("annual_row_id", "overridden")


@query(
    f"""WITH d AS (SELECT DISTINCT pdf_path, report_year, {_tif("tif_number")} AS t FROM tif_legacy_pdf_project_audit_sample WHERE pdf_path IS NOT NULL)
SELECT d.pdf_path, l.legacy_row_id FROM d JOIN tif_legacy_annual_report_projects_2010_2016 l ON d.report_year = l.report_year AND d.t = {_tif("l.tif_number")}"""
)
def rows_by_document(read: Read):
    """Every extracted row of a document's year and district."""
    documents = read(AUDIT).filter("pdf_path is not null").select("pdf_path", "report_year", _key().alias("t")).distinct()
    return documents.join(read(LEGACY).select("legacy_row_id", "report_year", _key().alias("t")), ["report_year", "t"]).select("pdf_path", "legacy_row_id")


@query(
    """WITH s AS (SELECT pdf_path, arg_max(source_status, audit_row_id) AS last_status FROM tif_legacy_pdf_project_audit_sample WHERE pdf_path IS NOT NULL AND source_status IS NOT NULL GROUP BY 1),
m AS (SELECT DISTINCT annual_report_pdf FROM tif_legacy_annual_report_projects_2010_2016 WHERE lower(annual_report_name) LIKE '%iga%' AND annual_report_pdf IS NOT NULL)
SELECT l.legacy_row_id, CASE WHEN m.annual_report_pdf IS NOT NULL THEN 'known_missing' ELSE coalesce(s.last_status, 'not_downloaded') END AS download_status
FROM tif_legacy_annual_report_projects_2010_2016 l LEFT JOIN s ON l.annual_report_pdf = s.pdf_path LEFT JOIN m ON l.annual_report_pdf = m.annual_report_pdf"""
)
def known_missing(read: Read):
    """Last status of a link, unless a list says that the document is known to be missing."""
    seen = read(AUDIT).filter("pdf_path is not null and source_status is not null")
    status = rank.best_row(seen, ["pdf_path"], ["audit_row_id"], ["source_status"]).select(F.col("pdf_path").alias("annual_report_pdf"), F.col("source_status").alias("last_status"))
    missing = read(LEGACY).filter(F.lower("annual_report_name").contains("iga") & F.col("annual_report_pdf").isNotNull())
    rows = universe.flag(universe.lookup(read(LEGACY).select("legacy_row_id", "annual_report_pdf"), status, ["annual_report_pdf"], {"last_status": "not_downloaded"}), missing, ["annual_report_pdf"], "gone")
    return rows.select("legacy_row_id", F.when(F.col("gone") == 1, "known_missing").otherwise(F.col("last_status")).alias("download_status"))


@query(
    """SELECT legacy_row_id, report_year, coalesce(annual_report_name, project_name, '') AS name, coalesce(status, '') AS status, '' AS new_deals, CAST(NULL AS DOUBLE) AS paid, coalesce(source, 'annual_report_pdf') AS source,
  array_to_string(CASE WHEN len(regexp_extract_all(coalesce(section_pages, ''), '\\d+')) > 0 THEN list_transform(regexp_extract_all(section_pages, '\\d+'), lambda x: CAST(CAST(x AS INTEGER) AS VARCHAR)) ELSE ['15'] END, ',') AS pages FROM tif_legacy_annual_report_projects_2010_2016"""
)
def legacy_common(read: Read):
    """The legacy table in the schema of the annual one: constants for what it lacks, fall-backs for what may be missing."""
    or_blank = lambda *cs: F.coalesce(*cs, F.lit(""))
    return read(LEGACY).select(
        "legacy_row_id", "report_year", or_blank("annual_report_name", "project_name").alias("name"), or_blank("status").alias("status"), F.lit("").alias("new_deals"), F.lit(None).cast("double").alias("paid"), F.coalesce("source", F.lit("annual_report_pdf")).alias("source"),
        F.array_join(F.transform(text.ints_of(F.col("section_pages"), (15,)), lambda x: x.cast("string")), ",").alias("pages"),
    )


@query(
    f"""WITH r AS (SELECT annual_report_pdf, max(legacy_expected_project_total) AS expected, count(*) AS extracted FROM tif_legacy_annual_report_projects_2010_2016 WHERE annual_report_pdf IS NOT NULL GROUP BY 1)
SELECT unnest(['reports', 'expected', 'extracted', 'short', 'agreeing']) AS metric, unnest([CAST(count(*) AS DOUBLE), sum(coalesce(expected, 0)), sum(extracted), count(*) FILTER (WHERE extracted < expected), count(*) FILTER (WHERE extracted = expected)]) AS value FROM r"""
)
def validation_metrics(read: Read):
    """What reports state against what was extracted."""
    by_report = read(LEGACY).filter("annual_report_pdf is not null").groupBy("annual_report_pdf").agg(F.max("legacy_expected_project_total").alias("e"), F.count(F.lit(1)).alias("x"))
    n = lambda c: F.count(F.when(c, 1))
    return aggregate.metric_table(by_report, {"reports": F.count(F.lit(1)), "expected": F.sum(F.coalesce("e", F.lit(0))), "extracted": F.sum("x"), "short": n(F.col("x") < F.col("e")), "agreeing": n(F.col("x") == F.col("e"))})


# --- registers and summaries -------------------------------------------------------------------------------------


@query(
    f"""WITH e AS (SELECT {_tif("tif_number")} AS k, CAST(report_year AS BIGINT) AS year, 'annual' AS source, tif_district AS name, 3 AS w, 0 AS s, CAST(annual_row_id AS VARCHAR) AS o FROM tif_annual_report_projects
UNION ALL SELECT {_tif("ref")}, {_year("approval_d")}, 'boundary', tif_name, 2, 1, CAST(boundary_row_id AS VARCHAR) FROM tif_boundary_districts_historical
UNION ALL SELECT {_tif("tif_number")}, report_year, 'legacy', tif_district, 3, 2, CAST(legacy_row_id AS VARCHAR) FROM tif_legacy_annual_report_projects_2010_2016
UNION ALL SELECT {_tif("matched_tif_number")}, try_cast(meeting_year AS BIGINT), 'journal', matched_canonical_tif_district, 3, 3, district_candidate_id FROM tif_district_legislation_candidates
UNION ALL SELECT {_tif("tif_number")}, first_year, 'list', canonical_tif_district, 3, 4, tif_number FROM tif_district_universe),
x AS (SELECT * FROM e WHERE k <> ''),
f AS (SELECT k, {_norm("name")} AS form, first(name ORDER BY s, o) AS name, sum(w) AS w FROM x WHERE {_norm("name")} <> '' GROUP BY 1, 2),
v AS (SELECT k, name AS canonical, w AS votes, row_number() OVER (PARTITION BY k ORDER BY w DESC, length(name) DESC, lower(name) DESC) AS r FROM f),
b AS (SELECT k, min(CASE WHEN year BETWEEN 1981 AND 2027 THEN year END) AS lo, max(CASE WHEN year BETWEEN 1981 AND 2027 THEN year END) AS hi, count(DISTINCT CASE WHEN year BETWEEN 1981 AND 2027 THEN year END) AS n,
  array_to_string(list_sort(list_distinct(list(source))), '; ') AS sources, array_to_string(list_transform(list_sort(list_distinct(list({{'l': lower(trim(name)), 'n': trim(name)}}) FILTER (WHERE trim(name) <> ''))), lambda z: z.n), '; ') AS variants FROM x GROUP BY k),
i AS (SELECT {_tif("ref")} AS k, greatest({_year("approval_d")}, 1981) AS a, least(coalesce({_year("repealed_d")}, {_year("expiration")}, 2027), 2027) AS z FROM tif_boundary_districts_historical WHERE {_year("approval_d")} IS NOT NULL),
j AS (SELECT k, min(a) AS a, max(z) AS z FROM i WHERE z >= a AND k <> '' GROUP BY k)
SELECT b.k AS tif_key, coalesce(v.canonical, '') AS canonical, coalesce(b.variants, '') AS variants, CAST(least(lo, a) AS BIGINT) AS first_year, CAST(greatest(hi, z) AS BIGINT) AS last_year, n AS years_observed, sources
FROM b LEFT JOIN v ON b.k = v.k AND v.r = 1 LEFT JOIN j ON b.k = j.k"""
)
def district_register(read: Read):
    """One row per district over five sources: voted name, spellings, years observed and implied, sources."""
    part = lambda t, k, year, source, name, w, s, o: read(t).select(ids.canonical_district(F.col(k)).alias("tif_key"), year.cast("long").alias("year"), F.lit(source).alias("source"), F.col(name).alias("name"), F.lit(w).alias("w"), F.lit(s).alias("s"), F.col(o).cast("string").alias("o"))
    evidence = (
        part(ANNUAL, "tif_number", F.col("report_year"), "annual", "tif_district", 3, 0, "annual_row_id")
        .unionByName(part(BOUNDARIES, "ref", coerce.year_of(F.col("approval_d")), "boundary", "tif_name", 2, 1, "boundary_row_id"))
        .unionByName(part(LEGACY, "tif_number", F.col("report_year"), "legacy", "tif_district", 3, 2, "legacy_row_id"))
        .unionByName(part(CANDIDATES, "matched_tif_number", F.col("meeting_year").try_cast("long"), "journal", "matched_canonical_tif_district", 3, 3, "district_candidate_id"))
        .unionByName(part(UNIVERSE, "tif_number", F.col("first_year"), "list", "canonical_tif_district", 3, 4, "tif_number"))
    ).filter("tif_key <> ''")
    spans = read(BOUNDARIES).select(ids.canonical_district(F.col("ref")).alias("tif_key"), coerce.year_of(F.col("approval_d")).alias("a"), F.coalesce(coerce.year_of(F.col("repealed_d")), coerce.year_of(F.col("expiration"))).alias("z"))
    implied = aggregate.expand_years(spans.filter("tif_key <> ''").distinct(), "a", "z", 1981, 2027).select("tif_key", F.col("year").cast("long").alias("year"))
    return universe.register(evidence, "tif_key", "year", "source", "name", "w", ["s", "o"], implied, 1981, 2027)


@query(
    """SELECT unnest(['rows', 'matters', 'detailed', 'with_hits', 'attachments', 'first_year', 'last_year']) AS metric,
  unnest([CAST(count(*) AS DOUBLE), count(DISTINCT matter_id), sum(coalesce(detail_fetched, 0)), count(*) FILTER (WHERE coalesce(keyword_hits, '') <> ''), sum(coalesce(attachments_count, 0)), min(file_year), max(file_year)]) AS value FROM tif_elms_matters"""
)
def harvest_summary(read: Read):
    n = lambda c: F.sum(F.coalesce(c, F.lit(0)))
    return aggregate.metric_table(
        read(MATTERS),
        {"rows": F.count(F.lit(1)), "matters": F.countDistinct("matter_id"), "detailed": n("detail_fetched"), "with_hits": F.count(F.when(F.coalesce("keyword_hits", F.lit("")) != "", 1)), "attachments": n("attachments_count"), "first_year": F.min("file_year"), "last_year": F.max("file_year")},
    )


@query(
    """SELECT unnest(['mentions', 'documents', 'projected_documents', 'realized_documents', 'cost', 'time']) AS metric,
  unnest([CAST(count(*) AS DOUBLE), count(DISTINCT pdf_file), count(DISTINCT CASE WHEN status = 'projected' THEN pdf_file END), count(DISTINCT CASE WHEN status = 'realized' THEN pdf_file END), count(*) FILTER (WHERE metric_type = 'cost'), count(*) FILTER (WHERE metric_type LIKE 'time%')]) AS value FROM tif_pdf_projected_realized_mentions"""
)
def mention_summary(read: Read):
    docs = lambda s: F.countDistinct(F.when(F.col("status") == s, F.col("pdf_file")))
    return aggregate.metric_table(
        read(MENTIONS), {"mentions": F.count(F.lit(1)), "documents": F.countDistinct("pdf_file"), "projected_documents": docs("projected"), "realized_documents": docs("realized"), "cost": F.count(F.when(F.col("metric_type") == "cost", 1)), "time": F.count(F.when(F.col("metric_type").startswith("time"), 1))}
    )


@query(
    """SELECT unnest(['rows', 'documents', 'pass', 'warning', 'fail', 'similar', 'status_agrees']) AS metric,
  unnest([CAST(count(*) AS DOUBLE), count(DISTINCT pdf_path), count(*) FILTER (WHERE project_audit_verdict = 'pass'), count(*) FILTER (WHERE project_audit_verdict = 'warning'), count(*) FILTER (WHERE project_audit_verdict = 'fail'),
  count(*) FILTER (WHERE name_similarity >= 0.88), count(*) FILTER (WHERE extracted_status = source_status)]) AS value FROM tif_legacy_pdf_project_audit_sample"""
)
def audit_summary(read: Read):
    n = lambda c: F.count(F.when(c, 1))
    verdict = F.col("project_audit_verdict")
    return aggregate.metric_table(
        read(AUDIT), {"rows": F.count(F.lit(1)), "documents": F.countDistinct("pdf_path"), **{v: n(verdict == v) for v in ("pass", "warning", "fail")}, "similar": n(F.col("name_similarity") >= 0.88), "status_agrees": n(F.col("extracted_status") == F.col("source_status"))}
    )


@query(
    """WITH s AS (SELECT DISTINCT matter_id FROM tif_elms_matters WHERE detail_fetched = 1),
t AS (SELECT unnest(string_split(keyword_hits, ' | ')) AS term, detail_fetched, file_year, m.matter_id, s.matter_id IS NOT NULL AS seen FROM tif_elms_matters m LEFT JOIN s ON m.matter_id = s.matter_id WHERE keyword_hits IS NOT NULL)
SELECT term, count(*) AS fetched, count(*) FILTER (WHERE coalesce(file_year < 2012, FALSE)) AS before_floor, count(*) FILTER (WHERE NOT coalesce(file_year < 2012, FALSE) AND seen) AS seen,
  count(*) FILTER (WHERE NOT coalesce(file_year < 2012, FALSE) AND NOT seen) AS new FROM t WHERE term <> '' GROUP BY term"""
)
def term_statistics(read: Read):
    """What a search term brought: rows, those before the year floor, those seen before, new ones."""
    seen = read(MATTERS).filter("detail_fetched = 1")
    rows = universe.flag(read(MATTERS).select("matter_id", "file_year", F.explode(F.split("keyword_hits", r" \| ")).alias("term")).filter("term <> ''"), seen, ["matter_id"], "seen")
    early = F.coalesce(F.col("file_year") < 2012, F.lit(False))
    n = lambda c: F.count(F.when(c, 1))
    return rows.groupBy("term").agg(F.count(F.lit(1)).alias("fetched"), n(early).alias("before_floor"), n(~early & (F.col("seen") == 1)).alias("seen"), n(~early & (F.col("seen") == 0)).alias("new"))


@query(
    f"""SELECT {_tif("tif_number")} AS tif_key, report_year, round(sum(CASE WHEN project_iga = 'IGA' THEN coalesce(current_year_payments, 0) ELSE 0 END), 2) AS iga, round(sum(CASE WHEN project_iga = 'Project' THEN coalesce(current_year_payments, 0) ELSE 0 END), 2) AS project,
  round(sum(CASE WHEN project_iga IS NULL OR project_iga NOT IN ('IGA', 'Project') THEN coalesce(current_year_payments, 0) ELSE 0 END), 2) AS other,
  round(round(sum(CASE WHEN project_iga = 'IGA' THEN coalesce(current_year_payments, 0) ELSE 0 END), 2) - round(sum(CASE WHEN project_iga = 'Project' THEN coalesce(current_year_payments, 0) ELSE 0 END), 2), 2) AS net
FROM tif_annual_report_projects WHERE report_year IS NOT NULL GROUP BY ALL"""
)
def net_sums(read: Read):
    kind = F.col("project_iga")
    sums = aggregate.conditional_sums(read(ANNUAL).withColumn("tif_key", _key()), ["tif_key", "report_year"], F.col("current_year_payments"), {"iga": kind == "IGA", "project": kind == "Project"}, "other")
    return sums.withColumn("net", F.round(F.col("iga") - F.col("project"), 2))


# --- orders, limits, sets -------------------------------------------------------------------------------------------


@query("SELECT pdf_path, audit_row_id, CAST(row_number() OVER (PARTITION BY pdf_path ORDER BY report_year, audit_row_id) AS INTEGER) AS number FROM tif_legacy_pdf_project_audit_sample WHERE source_mode = 'ocr'")
def renumbered(read: Read):
    return reports.renumbered(read(AUDIT).filter("source_mode = 'ocr'"), ["pdf_path"], ["report_year", "audit_row_id"], "number").select("pdf_path", "audit_row_id", "number")


@query("SELECT annual_row_id, coalesce(report_year, 0) AS y, coalesce(tif_number, '') AS t FROM tif_annual_report_projects ORDER BY y, t, annual_row_id")
def null_as_zero_sort(read: Read):
    return read(ANNUAL).select("annual_row_id", F.coalesce("report_year", F.lit(0)).alias("y"), F.coalesce("tif_number", F.lit("")).alias("t")).orderBy("y", "t", "annual_row_id")


@query("SELECT district_candidate_id, coalesce(district_match_status, 'needs_review') AS status FROM tif_district_legislation_candidates ORDER BY coalesce(district_match_status, 'needs_review') <> 'needs_review', district_candidate_id")
def review_first_sort(read: Read):
    rows = read(CANDIDATES).select("district_candidate_id", F.coalesce("district_match_status", F.lit("needs_review")).alias("status"))
    return rows.orderBy(F.col("status") != "needs_review", "district_candidate_id")


@query(
    """WITH m AS (SELECT journal_pdf, min(meeting_date) AS meeting_date, min(try_cast(meeting_year AS INTEGER)) AS y FROM tif_district_legislation_candidates WHERE meeting_date IS NOT NULL GROUP BY 1)
SELECT journal_pdf, meeting_date FROM m WHERE y BETWEEN 1985 AND 2005 AND journal_pdf IS NOT NULL ORDER BY meeting_date, journal_pdf LIMIT 25"""
)
def limited_manifest(read: Read):
    """The first 25 documents of a range of years; the limit is the feature."""
    rows = read(CANDIDATES).filter("meeting_date is not null").groupBy("journal_pdf").agg(F.min("meeting_date").alias("meeting_date"), F.min(F.col("meeting_year").try_cast("int")).alias("y"))
    return manifest(rows, "y", 1985, 2005, None, F.col("journal_pdf").isNotNull(), "journal_pdf", "meeting_date", 25).select("journal_pdf", "meeting_date")


@query("SELECT tif_number, array_to_string(string_split_regex(district_name_variants, '\\s*;\\s*')[1:2], ' | ') AS first_names FROM tif_district_universe WHERE district_name_variants IS NOT NULL")
def first_variants(read: Read):
    return read(UNIVERSE).filter("district_name_variants is not null").select("tif_number", F.array_join(F.slice(F.split("district_name_variants", r"\s*;\s*"), 1, 2), " | ").alias("first_names"))


@query(
    """SELECT report_year, tif_number, project_number, 'legacy' AS source FROM tif_legacy_annual_report_projects_2010_2016
UNION ALL SELECT report_year, tif_number, project_number, 'audit' FROM tif_legacy_pdf_project_audit_sample"""
)
def files_union(read: Read):
    """Same-shaped files with their tag; one of the three does not exist and is left out."""
    files = {"legacy": LEGACY, "absent": "tif_legacy_absent", "audit": AUDIT}
    return existing_union({tag: lambda t=t: read(t) for tag, t in files.items()}, ["report_year", "tif_number", "project_number"])


_WORDS = f"string_split({_norm('matter_title')}, ' ')"


@query(f"SELECT matter_row_id, array_to_string(list_filter({_WORDS}, lambda x, i: list_position({_WORDS}, x) = i), ' ') AS words FROM tif_elms_matters")
def ordered_words(read: Read):
    """Words of a title, each once, in the order in which they first come."""
    return read(MATTERS).select("matter_row_id", F.array_join(F.array_distinct(F.split(text.norm_text(F.col("matter_title")), " ")), " ").alias("words"))


# --- clean-up of scanned text ------------------------------------------------------------------------------------------


def _repaired_sql(c: str) -> str:
    out = f"coalesce({c}, '')"
    for bad, good in text.REPAIRS:
        out = f"regexp_replace({out}, '(?i){bad.replace(chr(39), chr(39) * 2)}', '{good}', 'g')"
    return f"replace(regexp_replace(replace(replace(replace(replace({out}, '•', ' '), '|', ' '), '[', ' '), ']', ' '), '[_`~]+', ' ', 'g'), chr(13), chr(10))"


def _clean_sql(c: str) -> str:
    return f"trim(regexp_replace(replace(replace(replace(coalesce({c}, ''), chr(12), ' '), '•', ' '), '*', ' '), '\\s+', ' ', 'g'), ' -:;,.')"


_STATUS = r"Project\s+is|Ongoing|Completed?"


@query(
    f"""SELECT legacy_row_id, {_repaired_sql("project_name")} AS repaired, {_clean_sql("project_name")} AS cleaned, {_clean_sql(f"regexp_replace({_clean_sql('project_name')}, '(?i)\\b(?:{_STATUS})\\b.*$', '', 'g')")} AS named,
  {_norm("replace(replace(lower(coalesce(project_name, '')), 'proiect', 'project'), 'companj', 'company')")} AS form, length(trim(regexp_replace(project_name, '\\s+', ' ', 'g'))) AS spaced FROM tif_legacy_annual_report_projects_2010_2016"""
)
def scan_cleanup(read: Read):
    n = F.col("project_name")
    return read(LEGACY).select("legacy_row_id", text.repaired(n).alias("repaired"), text.clean_name(n).alias("cleaned"), text.without_status(n, _STATUS).alias("named"), text.norm_scanned(n).alias("form"), F.length(text.clean_space(n)).alias("spaced"))


_DISTRICT_HEAD = (r"(?i)FY\s*20\d{2}\s+TIF\s*Name\s*:\s*([A-Za-z0-9/ ]+)", r"(?i)([A-Za-z0-9/ ]+?)\s+REDEVELOPMENT PROJECT AREA")
_TOTALS = (r"(?is)total number of projects.*?\n\s*(\d{1,3})\b", r"(?is)completed\s+(\d{1,3})\s+inspections")


@query(
    f"""WITH a AS (SELECT audit_row_id, pdf_path, source_line, regexp_replace(string_split(pdf_path, '/')[-1], '\\.[A-Za-z]+$', '') AS stem FROM tif_legacy_pdf_project_audit_sample)
SELECT audit_row_id, try_cast(nullif(regexp_extract(pdf_path, '(20\\d{{2}})', 1), '') AS INTEGER) AS report_year,
  coalesce(nullif(regexp_extract(source_line, '{_DISTRICT_HEAD[0]}', 1), ''), nullif(regexp_extract(source_line, '{_DISTRICT_HEAD[1]}', 1), ''), trim(regexp_replace(regexp_replace(regexp_replace(stem, '^T[_-]\\d{{3}}_', ''), 'AR\\d{{2,4}}$', ''), '([a-z])([A-Z])', '\\1 \\2', 'g'))) AS district,
  coalesce(try_cast(nullif(regexp_extract(source_line, '{_TOTALS[0]}', 1), '') AS INTEGER), try_cast(nullif(regexp_extract(source_line, '{_TOTALS[1]}', 1), '') AS INTEGER)) AS total FROM a"""
)
def report_heads(read: Read):
    """Year, district and stated number of a report, from its text, else from its file name."""
    line, path = F.col("source_line"), F.col("pdf_path")
    return read(AUDIT).select("audit_row_id", text.report_year(path).alias("report_year"), F.coalesce(text.first_capture(line, _DISTRICT_HEAD), text.spaced_stem(path)).alias("district"), reports.reported_total(line, _TOTALS).alias("total"))


_KINDS = (("(?i) iga |intergovernmental", "Intergovernmental"), ("(?i) sbif |small business improvement fund", "Fund"), ("(?i) redevelopment agreement ", "Agreement"))


@query(
    f"""WITH n AS (SELECT annual_row_id, ' ' || {_norm("project_name")} || ' ' AS n FROM tif_annual_report_projects)
SELECT annual_row_id, CASE WHEN contains(n, ' iga ') OR contains(n, 'intergovernmental') THEN 'Intergovernmental' WHEN contains(n, ' sbif ') OR contains(n, 'small business improvement fund') THEN 'Fund' WHEN contains(n, ' redevelopment agreement ') THEN 'Agreement' ELSE 'Project' END AS kind FROM n"""
)
def agreement_kinds(read: Read):
    return read(ANNUAL).select("annual_row_id", reports.agreement_kind(F.col("project_name"), _KINDS, "Project").alias("kind"))


@query(
    f"""WITH o AS (SELECT {_tif("tif_number")} AS t, {_norm("raw_project_name")} AS p, first(nullif(trim(canonical_project_id), '') ORDER BY override_id) AS c, first(nullif(trim(master_id), '') ORDER BY override_id) AS m FROM project_name_overrides WHERE {_TRUE} GROUP BY 1, 2)
SELECT a.annual_row_id, coalesce(o.c, 'master_' || o.m, 'proj_' || {_tif("a.tif_number")} || '_' || left(coalesce(nullif(replace({_norm("a.project_name")}, ' ', '-'), ''), 'item'), 64)) AS project_id
FROM tif_annual_report_projects a LEFT JOIN o ON {_tif("a.tif_number")} = o.t AND {_norm("a.project_name")} = o.p"""
)
def canonical_ids(read: Read):
    key = lambda c: [_key().alias("t"), text.norm_text(F.col(c)).alias("p")]
    blank = lambda c: F.nullif(F.trim(c), F.lit("")).alias(c)
    rows = read(OVERRIDES).filter(ids.truthy(F.col("active"))).select(*key("raw_project_name"), blank("canonical_project_id"), blank("master_id"), "override_id")
    stated = rank.first_per_key(rows, ["t", "p"], [F.asc("override_id")])
    joined = read(ANNUAL).select("annual_row_id", *key("project_name"), "project_name").join(stated, ["t", "p"], "left")
    return joined.select("annual_row_id", text.canonical_id(F.col("canonical_project_id"), F.col("master_id"), F.col("t"), F.col("project_name")).alias("project_id"))


# --- mentions and proceedings --------------------------------------------------------------------------------------------


_ALL_WORDS = tuple(dict.fromkeys((*textmine.PROJECTED, *textmine.REALIZED, *textmine.TIME_HINTS)))


def _word_list(groups: dict[str, tuple[str, ...]]) -> str:
    return ", ".join(f"({g}, {k}, '{w}', '{label}')" for g, (label, ws) in enumerate(groups.items()) for k, w in enumerate(ws))


#: Amounts as the specification of the mentions writes them, for the SQL side.
_MONEY_SQL = r"(?i)\$+\s*\(?\d[\d,]*(?:\.\d+)?\)?\s*(?:billion|million|thousand|bn|m|k)?|\b\d[\d,]*(?:\.\d+)?\s*(?:billion|million|thousand|bn|m|k)\b"
_WORDS_AT = """w AS (SELECT * FROM (VALUES {words}) t(g, k, word, label)),
s AS (SELECT mention_id, snippet, lower(snippet) AS low FROM tif_pdf_projected_realized_mentions WHERE snippet IS NOT NULL),
c AS (SELECT mention_id, low, unnest(generate_series(1, length(low))) AS i FROM s),
q AS (SELECT c.mention_id, i - 1 AS at, g, k, word, label FROM c JOIN w ON starts_with(substr(low, i, 12), word)),
x AS (SELECT mention_id, unnest({places}, recursive := false) AS m, generate_subscripts({places}, 1) - 1 AS pos FROM s)"""


@query(
    f"""WITH {_WORDS_AT.format(words=_word_list(dict(projected=textmine.PROJECTED, realized=textmine.REALIZED)), places=_places("snippet", _MONEY_SQL))},
r AS (SELECT x.mention_id, pos, trim(m.hit) AS value_raw, label, row_number() OVER (PARTITION BY x.mention_id, pos ORDER BY abs(q.at - m.at), g, q.at) AS n FROM x LEFT JOIN q ON x.mention_id = q.mention_id)
SELECT mention_id, CAST(pos AS INTEGER) AS pos, value_raw, label FROM r WHERE n = 1"""
)
def nearest_keyword(read: Read):
    """Status of every amount by the keyword that begins nearest to it."""
    found = textmine.mentions(read(MENTIONS).select("mention_id", "snippet"), ["mention_id", "snippet"], "snippet", textmine.MONEY, "cost")
    return textmine.nearest_label(found, "snippet", "at", {"projected": textmine.PROJECTED, "realized": textmine.REALIZED}, "label").select("mention_id", "pos", "value_raw", "label")


@query(
    f"""WITH {_WORDS_AT.format(words=_word_list(dict(any=_ALL_WORDS)), places=_places("snippet", _MONEY_SQL))},
r AS (SELECT x.mention_id, pos, word, row_number() OVER (PARTITION BY x.mention_id, pos ORDER BY abs(q.at - m.at), q.at, k) AS n FROM x LEFT JOIN q ON x.mention_id = q.mention_id)
SELECT mention_id, CAST(pos AS INTEGER) AS pos, word AS bucket FROM r WHERE n = 1"""
)
def keyword_bucket(read: Read):
    """The keyword, of all lists, that begins nearest to an amount."""
    found = textmine.mentions(read(MENTIONS).select("mention_id", "snippet"), ["mention_id", "snippet"], "snippet", textmine.MONEY, "cost")
    return textmine.nearest_word(found, "snippet", "at", _ALL_WORDS, "bucket").select("mention_id", "pos", "bucket")


_IN_PLACE = (r"\bin ([A-Z0-9][A-Za-z0-9/ ]+?) Tax Increment", r"\(([A-Z0-9][A-Za-z0-9/ ]+?) TIF\)", r", ([A-Z0-9][A-Za-z0-9/ ]+?) TIF$")
_WITH_FIRM = (r"[Aa]greement with ([A-Z][A-Za-z&,. ]+?) (?:for|at) ", r"[Aa]greement for ([^,]+), ")


def _captured_sql(t: str, patterns: tuple[str, ...]) -> str:
    return "list_concat(" * (len(patterns) - 1) + f"regexp_extract_all({t}, '{patterns[0]}', 1)" + "".join(f", regexp_extract_all({t}, '{p}', 1))" for p in patterns[1:])


def _unique_sql(xs: str) -> str:
    """SQL of items cleaned, those of one normal form once, joined."""
    items = f"list_transform({xs}, lambda x: trim(regexp_replace(trim(regexp_replace(x, '\\s+', ' ', 'g')), '(?i)^(?:the|an|a) ', ''), ' ,.;:-'))"
    forms = f"list_transform({items}, lambda x: {_norm('x')})"
    return f"array_to_string(list_filter({items}, lambda x, i: {_norm('x')} <> '' AND list_position({forms}, {_norm('x')}) = i), '; ')"


_T = "coalesce(matter_title, '')"


@query(f"SELECT matter_row_id, {_unique_sql(_captured_sql(_T, _IN_PLACE))} AS districts, {_unique_sql(_captured_sql(_T, _WITH_FIRM))} AS parties FROM tif_elms_matters")
def named_places(read: Read):
    """Districts and parties that a title names."""
    return read(MATTERS).select("matter_row_id", journal.found(F.col("matter_title"), _IN_PLACE).alias("districts"), journal.found(F.col("matter_title"), _WITH_FIRM).alias("parties"))


_ADDRESSES = (r"(\b\d{1,5}\s+(?:(?:N|S|E|W|North|South|East|West)\.?\s+)?[A-Z][A-Za-z0-9.'-]+(?:\s+[A-Z][A-Za-z0-9.'-]+){0,5}\s+(?:Street|Avenue|Boulevard|Parkway|Road)\b)",)
_DOLLAR = (r"(?i)(\$\s*\d[\d,]*(?:\.\d+)?(?:\s*(?:million|billion))?)",)
_LIMITS = (r"(?i)not\s+to\s+exceed\s+(\$\s*\d[\d,]*(?:\.\d+)?(?:\s*(?:million|billion))?)",)
_DATES = (r"(?i)(\b(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{1,2},\s+\d{4}\b)",)


@query(
    "SELECT matter_row_id, "
    + ", ".join(f"{_unique_sql(_captured_sql(_T, tuple(p.replace(chr(39), chr(39) * 2) for p in ps)))} AS {n}" for n, ps in (("addresses", _ADDRESSES), ("dollars", _DOLLAR), ("limits", _LIMITS), ("dates", _DATES)))
    + " FROM tif_elms_matters"
)
def captured_fields(read: Read):
    """Addresses, amounts, amounts not to be exceeded, and dates of a title."""
    return read(MATTERS).select("matter_row_id", *[journal.found(F.col("matter_title"), ps).alias(n) for n, ps in (("addresses", _ADDRESSES), ("dollars", _DOLLAR), ("limits", _LIMITS), ("dates", _DATES))])


_PLACE_HEADS, _PLACE_TAILS, _PLACE_STOP, _PLACE_BAD = ("the|a|an", r"for|to|within|in|of|as|and"), (r"tax\s+increment", r"redevelopment\s+project\s+area", "tif"), ("city", "ordinance", "committee"), r"(?i)\$|not to exceed"
_PLACE_TERMS = r"(?i)tax increment|TIF|redevelopment project area"
_PLACE_PATTERNS = (r"(?i)\bin ([A-Z0-9][A-Za-z0-9&/.,'() -]{2,100}?)\s+Tax\s+Increment", r"(?i)within ([A-Z0-9][A-Za-z0-9&/.,'() -]{2,100}?)\s+(?:TIF|Redevelopment)", r"(?i)\(([A-Z0-9][A-Za-z0-9&/.,' -]{2,100}?)\s+TIF\)")


def _place_sql(c: str) -> str:
    out = f"regexp_replace(trim(regexp_replace({c}, '\\s+', ' ', 'g')), '^[^A-Za-z0-9]+', '')"
    for head in _PLACE_HEADS:
        out = f"regexp_replace({out}, '(?i)^(?:{head})\\s+', '')"
    for tail in _PLACE_TAILS:
        out = f"regexp_replace({out}, '(?i)\\b(?:{tail})\\b.*$', '')"
    return f"trim(trim(regexp_replace({out}, '\\s+', ' ', 'g')), ' .,:;-''\"()[]{{}}')"


@query(
    f"""WITH t AS (SELECT DISTINCT matter_row_id, matter_title FROM tif_elms_matters WHERE regexp_matches(matter_title, '{_PLACE_TERMS}')),
c AS (SELECT matter_row_id, {" || ".join(f"regexp_extract_all(matter_title, '{p.replace(chr(39), chr(39) * 2)}', 1)" for p in _PLACE_PATTERNS)} AS xs FROM t),
u AS (SELECT matter_row_id, unnest(xs) AS x, generate_subscripts(xs, 1) AS i FROM c),
n AS (SELECT matter_row_id, i, {_place_sql("x")} AS name FROM u),
k AS (SELECT *, {_norm("name")} AS form, list_filter(regexp_extract_all(name, '[A-Za-z]+'), lambda w: lower(w) NOT IN ('st', 'nd', 'rd', 'th')) AS ws FROM n),
f AS (SELECT *, row_number() OVER (PARTITION BY matter_row_id, form ORDER BY i) AS r FROM k WHERE length(form) >= 3 AND form NOT IN ('city', 'ordinance', 'committee') AND NOT regexp_matches(name, '{_PLACE_BAD}')
  AND len(list_filter(ws, lambda w: regexp_matches(w, '^[A-Z]') OR w IN ('and', 'of', 'the', 'at', 'in', 'on'))) >= 0.8 * len(ws) AND (contains(form, ' ') OR length(form) >= 6 OR regexp_matches(name, '\\d|[/&-]')) AND len(string_split(form, ' ')) <= 10 AND length(name) <= 100)
SELECT matter_row_id, name AS place FROM f WHERE r = 1"""
)
def place_candidates(read: Read):
    """Names of places in titles, cut down and judged by how names are set."""
    names = journal.place_names(F.col("matter_title"), _PLACE_TERMS, _PLACE_PATTERNS, heads=_PLACE_HEADS, tails=_PLACE_TAILS, stop=_PLACE_STOP, bad=_PLACE_BAD)
    return read(MATTERS).select("matter_row_id", F.explode(names).alias("place"))


_FUND_WORDS = r"(?i)assistance|notes|grant|increasing"
_AMOUNT = "try_cast(replace(regexp_extract({x}, '\\d[\\d,]*(?:\\.\\d+)?'), ',', '') AS DOUBLE) * CASE WHEN regexp_matches({x}, '(?i)million') THEN 1e6 WHEN regexp_matches({x}, '(?i)billion') THEN 1e9 ELSE 1 END"
_DOLLAR_SQL = r"(?i)\$\s*\d[\d,]*(?:\.\d+)?(?:\s*(?:million|billion))?"


@query(
    f"""WITH x AS (SELECT matter_row_id, matter_title AS t, unnest({_places("matter_title", _DOLLAR_SQL)}, recursive := false) AS m FROM tif_elms_matters WHERE matter_title IS NOT NULL),
n AS (SELECT matter_row_id, {_AMOUNT.format(x="m.hit")} AS v FROM x WHERE regexp_matches(substr(t, CAST(greatest(m.at - 39, 1) AS BIGINT), length(m.hit) + 80), '{_FUND_WORDS}')
  UNION ALL SELECT matter_row_id, {_AMOUNT.format(x="y")} FROM (SELECT matter_row_id, unnest(regexp_extract_all(matter_title, '{_LIMITS[0]}', 1)) AS y FROM tif_elms_matters))
SELECT m.matter_row_id, max(n.v) AS funding FROM tif_elms_matters m LEFT JOIN n ON m.matter_row_id = n.matter_row_id GROUP BY 1"""
)
def funding_guess(read: Read):
    """The largest amount that may not be exceeded or has a funding word near."""
    return read(MATTERS).select("matter_row_id", journal.funding(F.col("matter_title"), r"not\s+to\s+exceed", _FUND_WORDS, 40).alias("funding"))


_CONTEXTS = (r"(?i)not\s+to\s+exceed\s+\$", r"(?i)allocation\s+notes?", r"(?i)increasing\s+assistance")


def _context_sql(t: str, p: str, radius: int) -> str:
    at, hit = f"(length(string_split_regex({t}, '{p}')[1]) + 1)", f"length(regexp_extract({t}, '{p}'))"
    start, end = f"greatest({at} - {radius}, 1)", f"({at} + {hit} + {radius})"
    return f"trim(regexp_replace(CASE WHEN {start} > 1 THEN '... ' ELSE '' END || substr({t}, {start}, {end} - {start}) || CASE WHEN {end} <= length({t}) THEN ' ...' ELSE '' END, '\\s+', ' ', 'g'))"


@query(f"SELECT matter_row_id, CASE {' '.join(f"WHEN regexp_matches(matter_title, '{p}') THEN {_context_sql('matter_title', p, 30)}" for p in _CONTEXTS)} WHEN matter_title IS NOT NULL THEN '' END AS context FROM tif_elms_matters")
def funding_context(read: Read):
    return read(MATTERS).select("matter_row_id", journal.context(F.col("matter_title"), _CONTEXTS, 30).alias("context"))


_EVENTS = {"redevelopment_agreement": r"(?i)redevelopment\s+agreement", "intergovernmental_agreement": r"(?i)intergovernmental\s+agreement|\biga\b", "bond_or_note": r"(?i)allocation\s+notes?|bonds?", "district": r"(?i)project\s+area|designation", "amendment": r"(?i)\bamend(?:ment|ed|ing)?\b"}


@query(
    f"""WITH e AS (SELECT matter_row_id, matter_title AS t, keyword_hits, array_to_string(list_filter([{", ".join(f"CASE WHEN regexp_matches(coalesce(matter_title, ''), '{p}') THEN '{n}' END" for n, p in _EVENTS.items())}], lambda x: x IS NOT NULL), '; ') AS e FROM tif_elms_matters),
l AS (SELECT *, CASE WHEN e = '' THEN CASE WHEN coalesce(keyword_hits, '') <> '' THEN 'general_reference' ELSE '' END ELSE e END AS events FROM e),
s AS (SELECT *, contains(events, 'agreement') OR contains(events, 'bond_or_note') AS p, contains(events, 'district') AS d FROM l)
SELECT matter_row_id, events, CASE WHEN p AND d THEN 'district_and_project' WHEN p THEN 'project' WHEN d THEN 'district' ELSE 'unknown' END AS scope,
  CASE WHEN contains(events, 'amendment') THEN 'revised' WHEN d THEN 'initial' ELSE '' END AS stage FROM s"""
)
def event_labels(read: Read):
    """Kinds of event that a title states, whether they concern a district or a project, and whether they are new."""
    events = universe.labelled(F.col("matter_title"), _EVENTS, F.when(F.coalesce("keyword_hits", F.lit("")) != "", "general_reference").otherwise(""))
    rows = read(MATTERS).select("matter_row_id", events.alias("events"))
    p, d = F.col("events").contains("agreement") | F.col("events").contains("bond_or_note"), F.col("events").contains("district")
    scope = F.when(p & d, "district_and_project").when(p, "project").when(d, "district").otherwise("unknown")
    return rows.select("matter_row_id", "events", scope.alias("scope"), F.when(F.col("events").contains("amendment"), "revised").when(d, "initial").otherwise("").alias("stage"))


_HIT, _WINDOW_LABELS, _WINDOW_LADDER = "(?i)assistance|allocation fund", {"time": "(?i)construction period|months", "money": r"\$", "reuse": "(?i)adaptive"}, ((r"\$", "high"), ("(?i)developer", "medium"))
_PAGES_SQL = """pages AS (SELECT pdf_file, page_number, string_agg(DISTINCT snippet, chr(10) ORDER BY snippet) AS t FROM tif_pdf_projected_realized_mentions WHERE page_number IS NOT NULL AND pdf_file IS NOT NULL AND snippet IS NOT NULL GROUP BY ALL)"""


@query(
    f"""WITH {_PAGES_SQL}, h AS (SELECT pdf_file, page_number, greatest(page_number - 1, 1) AS s, page_number + 1 AS e FROM pages WHERE regexp_matches(t, '{_HIT}')),
b AS (SELECT *, max(e) OVER (PARTITION BY pdf_file ORDER BY page_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM h),
i AS (SELECT *, sum(CASE WHEN p IS NULL OR s > p + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY pdf_file ORDER BY page_number ROWS UNBOUNDED PRECEDING) AS k FROM b),
w AS (SELECT pdf_file, min(s) AS cluster_start, max(e) AS cluster_end, count(*) AS hits FROM i GROUP BY pdf_file, k),
x AS (SELECT w.pdf_file, cluster_start, cluster_end, hits, string_agg(t, chr(10) ORDER BY page_number) AS t FROM w JOIN pages p ON w.pdf_file = p.pdf_file AND p.page_number BETWEEN cluster_start AND cluster_end GROUP BY ALL)
SELECT pdf_file, left(coalesce(nullif(replace({_norm("pdf_file")}, ' ', '-'), ''), 'item'), 64) || '-p' || lpad(CAST(cluster_start AS VARCHAR), 4, '0') || '-' || lpad(CAST(cluster_end AS VARCHAR), 4, '0') AS candidate_id, hits, length(t) AS characters,
  array_to_string(list_filter([{", ".join(f"CASE WHEN regexp_matches(t, '{p}') THEN '{n}' END" for n, p in _WINDOW_LABELS.items())}], lambda v: v IS NOT NULL), '; ') AS labels,
  CASE WHEN regexp_matches(t, '\\$') THEN 'high' WHEN regexp_matches(t, '(?i)developer') THEN 'medium' ELSE 'low' END AS priority FROM x"""
)
def candidate_windows(read: Read):
    """Candidate passages of documents: clusters of pages with a hit, with id, labels and priority."""
    pages = read(MENTIONS).filter("page_number is not null and pdf_file is not null and snippet is not null").groupBy("pdf_file", "page_number").agg(F.array_join(F.array_sort(F.collect_set("snippet")), "\n").alias("t"))
    found = journal.candidates(pages, ["pdf_file"], "page_number", "t", _HIT, 1, list(_WINDOW_LABELS.items()), _WINDOW_LADDER, "low", text.slug(F.col("pdf_file")))
    return found.select("pdf_file", "candidate_id", "hits", F.length("window_text").alias("characters"), "labels", "priority")


@query(
    f"""WITH {_HITS}, k AS (SELECT DISTINCT matter_row_id, tif_number, phrase AS name FROM h),
x AS (SELECT matter_row_id, unnest({_captured_sql(_T, _IN_PLACE)}) AS name FROM tif_elms_matters),
y AS (SELECT matter_row_id, trim(regexp_replace(trim(regexp_replace(name, '\\s+', ' ', 'g')), '(?i)^(?:the|an|a) ', ''), ' ,.;:-') AS name FROM x WHERE matter_row_id NOT IN (SELECT matter_row_id FROM k)),
u AS (SELECT matter_row_id, tif_number, name, 'known' AS origin, {_norm("name")} AS form FROM k UNION ALL SELECT matter_row_id, NULL, name, 'read', {_norm("name")} FROM y),
r AS (SELECT *, row_number() OVER (PARTITION BY matter_row_id, form ORDER BY tif_number IS NULL, name, tif_number) AS n FROM u)
SELECT matter_row_id, tif_number, name, origin FROM r WHERE n = 1"""
)
def district_candidates(read: Read):
    """Known districts of a title, else the names read from it."""
    read_names = read(MATTERS).select("matter_row_id", F.explode(F.transform(journal.captured(F.col("matter_title"), _IN_PLACE), journal.clean)).alias("name"))
    known = containment_hits(read).select("matter_row_id", "tif_number", F.col("phrase").alias("name"))
    return journal.district_rows(known, read_names, "matter_row_id", "tif_number", "name")


@query(
    """SELECT district_candidate_id, meeting_date, matched_tif_number, district_event_type_guess FROM tif_district_legislation_candidates WHERE lower(trim(district_match_status)) IN ('exact', 'strong_fuzzy')"""
)
def confirmed_timeline(read: Read):
    return journal.confirmed(read(CANDIDATES), "district_match_status", ("exact", "strong_fuzzy"), ("district_candidate_id", "meeting_date", "matched_tif_number", "district_event_type_guess"))


@query(
    """WITH f AS (SELECT matched_tif_number AS k, district_candidate_id AS id, try_cast(meeting_date AS DATE) AS d, try_cast(district_match_score AS DOUBLE) AS a FROM tif_district_legislation_candidates WHERE matched_tif_number IS NOT NULL),
e AS (SELECT k, d, id, row_number() OVER (PARTITION BY k ORDER BY d, id DESC) AS r FROM f WHERE d IS NOT NULL)
SELECT f.k, count(*) AS n, e.d AS first_date, e.id AS earliest, max(f.a) AS largest_amount FROM f LEFT JOIN e ON f.k = e.k AND e.r = 1 GROUP BY ALL"""
)
def earliest_and_largest(read: Read):
    rows = read(CANDIDATES).filter("matched_tif_number is not null").select(F.col("matched_tif_number").alias("k"), F.col("district_candidate_id").alias("id"), F.col("meeting_date").try_cast("date").alias("first_date"), F.col("district_match_score").try_cast("double").alias("a"))
    return journal.earliest_and_largest(rows, "k", "first_date", "a", "id")


_GENERIC = ("iga", "school", "park", "project")


def _informative_sql(c: str) -> str:
    n = _norm(c)
    return f"(regexp_matches({n}, '[a-z]') AND trim(regexp_replace(' ' || {n} || ' ', '( \\d+)+ ', ' ', 'g')) NOT IN ('iga', 'school', 'park', 'project') AND length(replace({n}, ' ', '')) >= 6)"


@query(
    f"""WITH a AS (SELECT {_tif("tif_number")} || '|' || {_norm("project_name")} AS spine, report_year, status, annual_row_id, project_name, {_tif("tif_number")} AS t, {_norm("project_name")} AS p FROM tif_annual_report_projects WHERE {_norm("project_name")} <> ''),
s AS (SELECT spine, t, p, count(DISTINCT report_year) AS years, max(CASE WHEN status = 'Active Project' THEN 1 ELSE 0 END) AS active, min(project_name) AS name FROM a GROUP BY ALL),
o AS (SELECT DISTINCT {_tif("tif_number")} AS t, {_norm("raw_project_name")} AS p FROM project_name_overrides WHERE {_TRUE}),
l AS (SELECT DISTINCT {_tif("tif_number")} AS t, {_norm("project_name")} AS p FROM tif_legacy_annual_report_projects_2010_2016),
j AS (SELECT s.*, o.t IS NOT NULL AS stated, l.t IS NOT NULL AS matched FROM s LEFT JOIN o ON s.t = o.t AND s.p = o.p LEFT JOIN l ON s.t = l.t AND s.p = l.p),
r AS (SELECT spine, years, array_to_string(list_filter([CASE WHEN NOT matched THEN 'matching_gap' END, CASE WHEN NOT matched AND NOT stated THEN 'missing_document' END, CASE WHEN years >= 2 AND matched THEN 'possible_amendments' END, CASE WHEN active = 1 THEN 'missing_outcome' END], lambda x: x IS NOT NULL), ' | ') AS reasons,
  CASE WHEN NOT matched THEN 'high' WHEN (years >= 2 AND matched) OR active = 1 THEN 'medium' ELSE 'low' END AS priority, CASE WHEN {_informative_sql("name")} THEN name ELSE p END AS term FROM j)
SELECT spine, years, coalesce(nullif(reasons, ''), 'baseline_complete') AS reasons, priority, CASE priority WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END AS rank, term, term || ' amendment' AS amendment_term FROM r ORDER BY rank DESC, spine"""
)
def gap_queue(read: Read):
    """Projects with the reasons why more about them should be looked for, a priority, and what to look for."""
    rows = read(ANNUAL).select(_key().alias("t"), text.norm_text(F.col("project_name")).alias("p"), "report_year", "status", "project_name").filter("p <> ''")
    spine = rows.groupBy("t", "p").agg(F.countDistinct("report_year").alias("years"), F.max((F.coalesce(F.col("status") == "Active Project", F.lit(False))).cast("int")).alias("active"), F.min("project_name").alias("name"))
    name = lambda c: [_key().alias("t"), text.norm_text(F.col(c)).alias("p")]
    spine = universe.flag(spine, read(OVERRIDES).filter(ids.truthy(F.col("active"))).select(*name("raw_project_name")), ["t", "p"], "stated")
    spine = universe.flag(spine, read(LEGACY).select(*name("project_name")), ["t", "p"], "matched")
    gap, often = F.col("matched") == 0, (F.col("years") >= 2) & (F.col("matched") == 1)
    found = universe.gaps(
        spine, {"matching_gap": gap, "missing_document": gap & (F.col("stated") == 0), "possible_amendments": often, "missing_outcome": F.col("active") == 1}, "baseline_complete", [(gap, "high"), (often | (F.col("active") == 1), "medium")], "low"
    )
    term = F.coalesce(F.get(universe.search_terms([F.col("name")], _GENERIC), F.lit(0)), F.col("p"))
    code = F.when(F.col("priority") == "high", 3).when(F.col("priority") == "medium", 2).otherwise(1)
    out = found.select(F.concat_ws("|", "t", "p").alias("spine"), "years", "reasons", "priority", code.alias("rank"), term.alias("term")).withColumn("amendment_term", F.concat("term", F.lit(" amendment")))
    return out.orderBy(F.desc("rank"), "spine")


@query(
    """SELECT audit_row_id, concat_ws(' | ', CASE WHEN coalesce(trim(extracted_project_name), '') = '' THEN 'no extracted name' END, CASE WHEN name_similarity < 0.88 THEN 'names differ' END,
  CASE WHEN coalesce(extracted_status, '') <> coalesce(source_status, '') THEN trim('status ' || coalesce(extracted_status, '') || ' / ' || coalesce(source_status, '')) END) AS note FROM tif_legacy_pdf_project_audit_sample"""
)
def audit_notes(read: Read):
    a, b = F.coalesce("extracted_status", F.lit("")), F.coalesce("source_status", F.lit(""))
    return read(AUDIT).select(
        "audit_row_id",
        universe.notes(F.when(F.coalesce(F.trim("extracted_project_name"), F.lit("")) == "", "no extracted name"), F.when(F.col("name_similarity") < 0.88, "names differ"), F.when(a != b, F.concat(F.lit("status "), a, F.lit(" / "), b))).alias("note"),
    )


# --- sections, project rows, matching ---------------------------------------------------------------------------------------


@query(
    f"""WITH {_PAGES_SQL}, f AS (SELECT pdf_file, min(page_number) AS section_start FROM pages WHERE regexp_matches(t, '(?i)assistance|estimated cost') GROUP BY 1),
n AS (SELECT p.pdf_file, page_number, section_start, page_number > section_start AND regexp_matches(t, '(?i)public hearing') AS stop, page_number > section_start AND NOT regexp_matches(t, '(?i)developer|project') AS off FROM pages p JOIN f ON p.pdf_file = f.pdf_file WHERE page_number >= section_start AND page_number < section_start + 6),
w AS (SELECT *, max(CASE WHEN stop THEN 1 ELSE 0 END) OVER (PARTITION BY pdf_file ORDER BY page_number ROWS UNBOUNDED PRECEDING) AS s, coalesce(max(CASE WHEN off THEN 1 ELSE 0 END) OVER (PARTITION BY pdf_file ORDER BY page_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS e FROM n)
SELECT pdf_file, page_number, section_start FROM w WHERE s = 0 AND e = 0"""
)
def section_windows(read: Read):
    """Pages of the section that begins with an anchor, up to a stop page or one that does not go on."""
    pages = read(MENTIONS).filter("page_number is not null and pdf_file is not null and snippet is not null").groupBy("pdf_file", "page_number").agg(F.array_join(F.array_sort(F.collect_set("snippet")), "\n").alias("t"))
    return reports.section_window(pages, ["pdf_file"], "page_number", "t", "(?i)assistance|estimated cost", "(?i)public hearing", "(?i)developer|project", 6).select("pdf_file", "page_number", "section_start")


@query()
def report_projects(read: Read):
    """Project rows of reports whose passages are those of the audit sample; tested against hand-made reports."""
    n = F.col("project_number").try_cast("int")
    passages = read(AUDIT).filter(n.isNotNull()).select("pdf_path", "report_year", n.alias("n"), "audit_row_id", F.coalesce("source_line", F.lit("")).alias("x"))
    report = passages.groupBy("pdf_path", "report_year").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "audit_row_id", "x"))), lambda s: F.concat(F.lit("Project "), s["n"].cast("string"), F.lit(": "), s["x"])), "\n").alias("t"))
    return reports.project_rows(report, ["pdf_path", "report_year"], "t")


_PHRASES = (("small business improvement fund", "sbif"), ("tax increment financing works", "tifworks"))
_STOP = ("llc", "inc", "corp", "corporation", "company", "co", "ltd", "development", "mixed", "use", "program", "project", "redevelopment", "agreement", "district", "city", "of", "the", "and", "for", "phase", "area", "fund", "business")


@query()
def entity_match(read: Read):
    """Annual names to legacy names of the district: override, exact, simplified, simplified report name, then the likeliest by four ratios; tested against difflib."""
    forms = lambda c, n, s: [text.norm_text(F.col(c)).alias(n), text.simplified(F.col(c), _PHRASES, _STOP).alias(s)]
    annual = read(ANNUAL).select(_key().alias("t"), *forms("project_name", "p", "s"), "project_name").filter("p <> '' and t <> ''").groupBy("t", "p", "s").agg(F.min("project_name").alias("name"))
    legacy = read(LEGACY).select(_key().alias("t"), *forms("project_name", "p", "s"), *forms("annual_report_name", "q", "d"), F.col("legacy_row_id").alias("target"))
    overrides = read(OVERRIDES).filter(ids.truthy(F.col("active"))).select(_key().alias("t"), text.norm_text(F.col("raw_project_name")).alias("p"), F.col("override_id").alias("target"))
    return match.entity_match(annual, overrides, legacy, 0.82)


_DROP = ("tif", "district", "redevelopment", "project", "area", "the", "tax", "increment", "financing")


@query()
def district_match(read: Read):
    """The ladder from equal keys through loose keys and contained phrases to likeness; tested against plain Python."""
    names = read(CANDIDATES).filter("district_name_raw is not null").select(F.col("district_name_raw").alias("name")).distinct()
    listed = _district_phrases(read).select(F.col("tif_number").alias("entry"), F.col("n").alias("listed")).unionByName(read(UNIVERSE).select(F.col("tif_number").alias("entry"), F.col("canonical_tif_district").alias("listed"))).distinct()
    canonical = read(UNIVERSE).select(F.col("tif_number").alias("entry"), F.col("canonical_tif_district").alias("listed")).withColumn("canonical", F.lit(1))
    return match.full_ladder(names, listed.join(canonical, ["entry", "listed"], "left").na.fill(0, ["canonical"]), _DROP, (*_DROP, "street", "st", "avenue", "ave"))


SQL["funding_near"] = f"""WITH x AS (SELECT matter_row_id, matter_title AS t, unnest({_places("matter_title", "\\$[0-9][0-9,]*(?:\\.[0-9]+)?")}, recursive := false) AS m FROM tif_elms_matters WHERE matter_title IS NOT NULL),
n AS (SELECT matter_row_id, try_cast(replace(replace(m.hit, '$', ''), ',', '') AS DOUBLE) AS v FROM x WHERE regexp_matches(substr(t, CAST(greatest(m.at - 59, 1) AS BIGINT), length(m.hit) + 120), '(?i)exceed|assistance|notes|grant'))
SELECT m.matter_row_id, max(n.v) AS funding FROM tif_elms_matters m LEFT JOIN n ON m.matter_row_id = n.matter_row_id GROUP BY 1"""

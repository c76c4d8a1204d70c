"""Queries of the llm operators over the test tables, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.llm import canonical, entity_link, mixing, name_variants, scan_noise, tokens, unicode_form
from ledgerweave.sources.tables import table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return name_variants.same_project_pairs(table(spark, folder, "tif_annual_report_projects"), table(spark, folder, "project_name_overrides"))


def p1_projects(spark: SparkSession, folder: str) -> DataFrame:
    rows = name_variants.projects(table(spark, folder, "tif_annual_report_projects"), table(spark, folder, "project_name_overrides"))
    return rows.select("annual_row_id", F.sha1("project").alias("project_id"))


def _scanned(spark: SparkSession, folder: str) -> DataFrame:
    return scan_noise.scanned_rows(
        table(spark, folder, "tif_legacy_annual_report_projects_2010_2016"), table(spark, folder, "tif_legacy_pdf_project_audit_sample"), table(spark, folder, "tif_pdf_projected_realized_mentions")
    )


def _typed(spark: SparkSession, folder: str) -> DataFrame:
    """Words of project names that were typed, not scanned."""
    return scan_noise.lexicon(table(spark, folder, "tif_annual_report_projects"), "project_name")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return scan_noise.noise(_scanned(spark, folder), _typed(spark, folder))


def p2_text(spark: SparkSession, folder: str) -> DataFrame:
    return scan_noise.repaired(_scanned(spark, folder), _typed(spark, folder))


def _p3(spark: SparkSession, folder: str) -> DataFrame:
    return entity_link.link(table(spark, folder, "tif_pdf_projected_realized_mentions"), table(spark, folder, "tif_elms_matters"), table(spark, folder, "tif_district_universe"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return _p3(spark, folder).select("mention_id", "matter_id")


def p3_confidence(spark: SparkSession, folder: str) -> DataFrame:
    return _p3(spark, folder)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return canonical.found(table(spark, folder, "tif_district_legislation_candidates"), table(spark, folder, "tif_district_universe"))


def p4_mapped(spark: SparkSession, folder: str) -> DataFrame:
    return canonical.mapped(table(spark, folder, "tif_district_legislation_candidates"), table(spark, folder, "tif_district_universe"))


def p6_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.encode(table(spark, folder, "documents"))


def p6_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.roundtrip(table(spark, folder, "documents"))


def p7_mix(spark: SparkSession, folder: str) -> DataFrame:
    rows = mixing.counted(table(spark, folder, "documents"))
    return mixing.choose(rows, table(spark, folder, "mix_targets")).withColumnRenamed("key", "doc_id").withColumnRenamed("n", "n_tokens")


def p7_shares(spark: SparkSession, folder: str) -> DataFrame:
    rows, targets = mixing.counted(table(spark, folder, "documents")), table(spark, folder, "mix_targets")
    return mixing.shares(rows, mixing.choose(rows, targets), targets)


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return unicode_form.same_look_pairs(table(spark, folder, "documents"))


def p8_forms(spark: SparkSession, folder: str) -> DataFrame:
    return unicode_form.normalised(table(spark, folder, "documents"))


# --- what must hold of the results, so that SQL can say it ------------------------------------------------------------


def p2_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every scanned row comes out once, and is null where it was."""
    return p2_text(spark, folder).select("tbl", "row_id", F.col("text").isNull().alias("is_null"))


def p4_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Names that stand on the list are mapped to themselves."""
    return p4_mapped(spark, folder).filter("district_match_status = 'exact'").select("district_candidate_id", "matched_canonical_tif_district")


def p6_same(spark: SparkSession, folder: str) -> DataFrame:
    """The ids of every text lead back to its bytes."""
    return p6_roundtrip(spark, folder).select("doc_id", "n_bytes", "same")


def p7_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """No source exceeds its budget or its repeats, and the shares reached add up."""
    report = p7_shares(spark, folder).join(table(spark, folder, "mix_targets").select("source", "max_repeats"), "source")
    return report.select("source", "target_share", (F.col("tokens") <= F.col("budget_tokens")).alias("within"), (F.col("most_repeats") <= F.col("max_repeats")).alias("repeats"), (F.col("short_by") == F.col("budget_tokens") - F.col("tokens")).alias("adds_up"))


def p8_stable(spark: SparkSession, folder: str) -> DataFrame:
    """A form is its own form, and a text of plain ASCII is its own but for its line ends."""
    rows = table(spark, folder, "documents").select("doc_id", "text").withColumn("form", unicode_form.one_form(F.col("text")))
    again = rows.withColumn("twice", unicode_form.one_form(F.col("form")))
    return again.select("doc_id", F.col("twice").eqNullSafe(F.col("form")).alias("stable"), F.when(F.col("text").rlike(r"\A[\x20-\x7e\n\t]*\z"), F.col("form") == F.col("text")).otherwise(True).alias("plain"))


QUERIES = {
    q.__name__: q
    for q in (
        p1_found, p1_projects, p2_found, p2_text, p2_rows, p3_found, p3_confidence, p4_found, p4_mapped, p4_exact, p6_ids, p6_roundtrip, p6_same, p7_mix, p7_shares, p7_bounds, p8_found, p8_forms, p8_stable,
    )
}
SQL: dict[str, str] = {
    "p2_rows": """SELECT 'tif_legacy_annual_report_projects_2010_2016' AS tbl, legacy_row_id AS row_id, project_name IS NULL AS is_null FROM tif_legacy_annual_report_projects_2010_2016
UNION ALL SELECT 'tif_legacy_pdf_project_audit_sample', audit_row_id, source_line IS NULL FROM tif_legacy_pdf_project_audit_sample
UNION ALL SELECT 'tif_pdf_projected_realized_mentions', mention_id, snippet IS NULL FROM tif_pdf_projected_realized_mentions""",
    "p4_exact": "SELECT district_candidate_id, district_name_raw AS matched_canonical_tif_district FROM tif_district_legislation_candidates WHERE district_name_raw IN (SELECT canonical_tif_district FROM tif_district_universe)",
    "p6_same": "SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes, TRUE AS same FROM documents",
    "p7_bounds": "SELECT source, target_share, TRUE AS within, TRUE AS repeats, TRUE AS adds_up FROM mix_targets",
    "p8_stable": "SELECT doc_id, TRUE AS stable, TRUE AS plain FROM documents",
}

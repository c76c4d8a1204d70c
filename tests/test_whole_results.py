"""Queries over small tables whose rows a filter used to leave out."""

import hashlib

import pytest

from ledgerweave.plans import queries


@pytest.fixture
def run(spark, tmp_path):
    """Runs a query over tables given as ``name=(rows, schema)``."""

    def of(query, **tables):
        for name, (data, schema) in tables.items():
            spark.createDataFrame(data, schema).write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))
        return queries.QUERIES[query](spark, str(tmp_path)).collect()

    return of


def test_every_text_is_hashed(run):
    texts = ["plain  text", "café – “x”", "Да \t\n漢字", "a  b", "\U0001f600", "", None]
    got = {r.doc_id: (r.text_hash, r.clean_chars) for r in run("text_hash", documents=(list(enumerate(texts)), "doc_id long, text string"))}
    chars = [10, 10, 5, 4, 1, 0]  # only space, tab and line ends are run together
    assert got == {i: (hashlib.sha1(t.encode()).hexdigest(), n) for i, (t, n) in enumerate(zip(texts[:-1], chars, strict=True))}


def test_titles_of_any_alphabet_have_snippets(run):
    got = run("best_snippets", tif_elms_matters=([("Café – agreement",), ("漢字",), ("Plain agreement",), (None,)], "matter_title string"))
    assert {r.title: r.snippet for r in got} == {"Café – agreement": "Café – agreement", "漢字": None, "Plain agreement": "Plain agreement"}


def test_names_with_marks_keep_them(run):
    names = ["Plain  Lofts", "O'Hare Citizens'", "A [B] C", "A|B", "x < y > z", "R&d &amp; lab", "{a}", None]
    got = {r.override_id: r.plain for r in run("strip_markup", project_name_overrides=([(i, n, "1") for i, n in enumerate(names)], "override_id long, canonical_project_name string, active string"))}
    assert got == {i: f"{' '.join(n.split())} & 1" for i, n in enumerate(names) if n is not None}


def test_comparison_is_over_all_years_and_rows(run):
    schema = "tif_number string, report_year int, project_number string"
    annual = [("T-1", 2014, "1"), ("T-001", 2014, "1"), ("T-001", 2015, "1"), ("T_002", 2016, "3"), (None, 2016, "1"), ("T-001", 2016, None)]
    legacy = [("T-001", 2014, "1"), ("T-001", 2013, "1"), ("T-002", 2016, "3"), ("T-001", 2016, None)]
    got = run("full_outer_compare", tif_annual_report_projects=(annual, schema), tif_legacy_annual_report_projects_2010_2016=(legacy, schema))
    want = [
        ("T-001", 2014, "1", 2, 1, "differs"), ("T-001", 2015, "1", 1, None, "left_only"), ("T-001", 2013, "1", None, 1, "right_only"), ("T-002", 2016, "3", 1, 1, "same"),
        (None, 2016, "1", 1, None, "left_only"), ("T-001", 2016, None, 1, None, "left_only"), ("T-001", 2016, None, None, 1, "right_only"),
    ]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)

import pytest

from ledgerweave.llm.name_variants import same_project_pairs
from ledgerweave.llm.project_names import alike, is_no_project, parts_of

ONE = [
    ("Monosrick Monitberg Lofts", "MONITBERG/MONOSRICK LFTS LLC"), ("Anthony Teloridge Public Library Branch", "Tony Telorideg Pub. Lib. Brach"), ("Theater Restoration, Feninfort & Grisinquist", "Feninfort + Grisinquist Theatre Restor."),
    ("IGA - Nadoette Fenuano Fieldhouse Renovation", "Nadoette Fenuano Fieldouse Renovation Intergovernmental Agreement"), ("4463 E. Lunalvik St Technology Center", "Tech Ctr - 4463 East Lunalvik Street"), ("Small Business Improvement Fund - Alpetto Corridor", "SBIF - Alpetto Corridor"),
    ("Povik Lofts Phase III", "Povik Lfts Ph. 3"), ("ElmozakMavorton Community Center", "Elmozak Mavorton Comm. Ctr"), ("Zimilette & Froizak Lofts", "Zimileyte & Froizak Lofts"), ("R. Urborpike Elementary School", "Robert Urborpike Elementary School"), ("Fenevdale, Bob - Apartments", "Robert Fenevdale Apts"),
]
TWO = [
    ("Povik Lofts Phase I", "Povik Lofts Phase II"), ("Povik Lofts North", "Povik Lofts South"), ("3055 N. Radaner Blvd Lofts", "3065 N. Radaner Blvd Lofts"), ("Povik Lofts", "Povik Apartments"), ("Deborah Ulmorlund Lofts", "Richard Ulmorlund Lofts"), ("4463 E. Lunalvik St Lofts", "4463 W. Lunalvik St Lofts"),
]


def like(a, b):
    p, q = parts_of(a), parts_of(b)
    return p.block == q.block and alike(list(p.words), list(p.initials), list(q.words), list(q.initials), not p.block.endswith("|")) is not None


@pytest.mark.parametrize("a,b", ONE)
def test_one_project(a, b):
    assert like(a, b) and like(b, a)


@pytest.mark.parametrize("a,b", TWO)
def test_two_projects(a, b):
    assert not like(a, b)


def annual(spark, rows):
    return spark.createDataFrame(rows, "annual_row_id long, tif_number string, tif_district string, project_name string, report_year int").selectExpr("*", "'x' as name", "'y' as block")


def overrides(spark, rows):
    return spark.createDataFrame(rows, "active string, tif_number string, raw_project_name string, canonical_project_name string, canonical_project_id string")


def test_pairs(spark):
    rows = [(2 * i + k, "T-1", "A", name, 2010 + k) for i, pair in enumerate(ONE) for k, name in enumerate(pair)]
    n = len(rows)
    rows += [(n + i, "T-2", "B", name, 2010) for i, pair in enumerate(TWO) for name in pair for i in [len(TWO) * 0 + TWO.index(pair) * 2 + pair.index(name)]]
    rows += [(900, "T-1", "A", None, 2010), (901, "T-1", "A", "N/A", 2010), (902, "T-1", "A", "No Projects Were Undertaken", 2011), (903, None, None, ONE[0][0], 2012), (904, None, "a ", ONE[0][1], 2013), (905, "T-3", "C", ONE[0][0], 2013)]
    said = [
        ("yes", "T-1", "Former Olko Foundry Site", "Zimilette & Froizak Lofts", None), ("0", "T-1", ONE[1][0], ONE[2][0], None), (None, "T-1", ONE[1][0], ONE[2][0], None), ("1", None, "q", "r", None), ("t", "T-1", None, "r", None),
        ("Y", "T-1", "Lot 30A Parcle 10700", None, "proj_T-001_povik-lofts-phase-iii"),
    ]
    rows += [(910, "T-1", "A", "former olko foundry site", 2001), (911, "T-1", "A", "Lot 30A Parcel 10700", 2002)]
    got = {tuple(r) for r in same_project_pairs(annual(spark, rows), overrides(spark, said)).collect()}
    want = {(2 * i, 2 * i + 1) for i in range(len(ONE))} | {(0, 904)}
    z, p = 2 * 8, 2 * 6
    want |= {(z, 910), (z + 1, 910), (p, 911), (p + 1, 911)}
    assert got == want


def test_empty_and_repeated(spark):
    none = annual(spark, [(1, "T-1", "A", "Povik Lofts", 2010)]).limit(0)
    said = overrides(spark, [("1", "T-1", "a", "b", None)]).limit(0)
    assert same_project_pairs(none, said).count() == 0
    rows = annual(spark, [(1, "T-1", "A", "Povik Lofts", 2010), (2, "T-1", "A", "Povik Lofts", 2010), (3, "T-1", "A", "Povik Lfts", 2011), (4, "T-1", "A", "Povik " + "Lofts " * 3000, 2012)])
    assert {tuple(r) for r in same_project_pairs(rows, said).collect()} == {(1, 3), (2, 3), (1, 4), (2, 4), (3, 4)}


@pytest.mark.parametrize("name", [None, "", " ", "-", "N/A", "None", "No Projects Were Undertaken"])
def test_no_project(name):
    assert is_no_project(name)

import random

import pytest

from ledgerweave.llm import canonical
from ledgerweave.llm.district_names import near, words_of

UNIVERSE = [
    ("T-001", "Ashfield Industrial Corridor", "Ashfield Industrial Corridor; Wesford Depot"), ("T-002", "33rd/Redton", "33rd/Redton"), ("T-003", "Newgrove North", "Newgrove North"), ("T-004", "Newgrove South", "Newgrove South"),
    ("T-005", "Holshaw", "Holshaw"), ("T-006", "Larchley Crossing", "Larchley Crossing"), ("T-007", "Bramford/Saltham", "Bramford/Saltham"), ("T-008", "27th/Oakbury", "27th/Oakbury"),
]
NAMES = {
    "ASHFIELD IC": "T-001", "AshfieldIndust.Corridor": "T-001", "the Ashfeild Industrial Corr Redevelopment Project Area": "T-001", "wesford depot TIF": "T-001", "Thirty-Third & Redton": "T-002", "Redton / 33": "T-002",
    "33rd Street and Redton": "T-002", "Newgrove N.": "T-003", "Newgrove So. RPA": "T-004", "Newgrove East": "", "Hoslhaw": "T-005", "(Larcley Crsg.)": "T-006", "T-6": "T-006", "TIF No. 007": "T-007", "Saltham--Bramf0rd Avenue": "T-007",
    "34th/Redton": "", "see Exhibit B": "", "T-002 (33rd Redton)": "T-002", "Twenty-Seventh--Oakbury": "T-008", "Forty Fifth Oakbury": "", "T-999": "", "Ashfield Avenue": "",
}


def tables(spark):
    universe = spark.createDataFrame(UNIVERSE, "tif_number string, canonical_tif_district string, district_name_variants string")
    rows = [(f"c{i}", n) for i, n in enumerate([*NAMES, *NAMES, None, "", "  ", "Holshaw", "x" * 5000])]
    return spark.createDataFrame(rows, "district_candidate_id string, district_name_raw string").withColumnRenamed("x", "x"), universe


def test_names_are_mapped(spark):
    candidates, universe = tables(spark)
    got = {r.district_candidate_id: r.tif_number for r in canonical.found(candidates, universe).collect()}
    want = {f"c{i}": NAMES[n] for i, n in enumerate([*NAMES, *NAMES])} | {f"c{2 * len(NAMES) + 4}": ""}
    assert got == want
    status = {r.district_candidate_id: r.district_match_status for r in canonical.mapped(candidates, universe).collect()}
    assert len(status) == candidates.count() and status[f"c{2 * len(NAMES) + 3}"] == "exact" and status[f"c{2 * len(NAMES)}"] == "unmatched"


def test_empty_tables(spark):
    candidates, universe = tables(spark)
    assert canonical.found(candidates.limit(0), universe).count() == 0
    assert {r.tif_number for r in canonical.found(candidates, universe.limit(0)).collect()} == {""}


def test_similarity_join_against_brute_force(spark):
    rng = random.Random(7)
    make = lambda n: [(f"{i}", sorted(set(rng.choices("abcdefghij", k=rng.randint(1, 7))))) for i in range(n)]
    a, b = make(40), make(40)
    for t in (0.4, 0.6, 0.8, 1.0):
        got = {(r.lid, r.rid): round(r.jaccard, 9) for r in canonical.similarity_join(spark.createDataFrame(a, "lid string, tokens array<string>"), spark.createDataFrame(b, "rid string, tokens array<string>"), t).collect()}
        want = {(i, j): round(len(set(x) & set(y)) / len(set(x) | set(y)), 9) for i, x in a for j, y in b if len(set(x) & set(y)) / len(set(x) | set(y)) >= t - 1e-12}
        assert got == want


@pytest.mark.parametrize("a,b,n", [("abc", "abc", 0), ("abc", "acb", 1), ("abc", "abcd", 1), ("abc", "xbd", 2), ("abc", "xyz", 3), ("abc", "abcxyz", 3)])
def test_edits(a, b, n):
    assert near(a, b) == n


def test_words_of_junk():
    assert words_of(None) == (None, [], []) and words_of("") == (None, [], []) and words_of("()--//") == (None, [], [])


def test_edits_against_the_textbook():
    def osa(a, b):
        d = [[max(i, j) if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (x != y))
                if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                    d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
        return d[-1][-1]

    rng = random.Random(1)
    for _ in range(20_000):
        a, b = ("".join(rng.choices("abc", k=rng.randint(0, 8))) for _ in range(2))
        assert near(a, b) == (min(osa(a, b), 3) if abs(len(a) - len(b)) <= 2 else 3), (a, b)

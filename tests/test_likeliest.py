"""Suggestions without blocks, against plain Python."""

import random
from decimal import ROUND_HALF_UP, Decimal
from difflib import SequenceMatcher

from ledgerweave.operators import match
from ledgerweave.plans import queries


def like(a, b):
    return SequenceMatcher(None, a, b).ratio()


def by_hand(left, right):
    out = set()
    for key, a, p in left:
        scores = []
        for rid, b, q in right:
            n = like(a or "", b or "")
            s = max(n, 0.65 * n + 0.35 * (like(p, q) if p and q else 0.0))
            scores.append((-Decimal(repr(s)).quantize(Decimal("0.001"), ROUND_HALF_UP), rid))
        score, rid = min(scores)
        score = -float(score)
        out.add((key, rid, score, "unmatched" if score < 0.72 else "suggested" if score < 0.9 else "strong_suggestion"))
    return out


def test_every_name_meets_every_other(spark):
    rng = random.Random(5)
    words = ["lunellan", "towrihomes", "st", "f1eldhouse", "renovat1on", "terisgan", "lofts", "4158", "n", "park", "é" * 3, "x" * 40]
    name = lambda: " ".join(rng.choice(words)[rng.randint(0, 2) :] for _ in range(rng.randint(1, 5)))
    place = lambda: rng.choice(["T-001", "T-010", "T-123", "", None])
    left = [(f"l{i}", name(), place()) for i in range(60)] + [("none", None, "T-001"), ("blank", "", None)]
    right = [(i, name(), place()) for i in range(80)] + [(900, None, "T-001"), (901, "", "")]
    a, b = spark.createDataFrame(left, "id string, name string, place string"), spark.createDataFrame(right, "rid int, name string, place string")
    got = match.likeliest(a, b, "id", "name", "place", "rid", 0.72, 0.9)
    assert {tuple(r) for r in got.collect()} == by_hand(left, right)
    assert {tuple(r) for r in match.likeliest(a, b.limit(0), "id", "name", "place", "rid", 0.72, 0.9).collect()} == {(x[0], None, None, "unmatched") for x in left}
    assert match.likeliest(a.limit(0), b, "id", "name", "place", "rid", 0.72, 0.9).count() == 0


def test_names_without_a_common_word_are_suggested(spark, tmp_path):
    legacy = [("T-1", "lunellan terisgan towrihomes"), ("T-1", "zzz")]
    listed = [(1, "T-001", "Lunelan Terizgan Townhomes"), (2, "T-002", "Povik Lofts")]
    spark.createDataFrame(legacy, "tif_number string, project_name string").write.parquet(str(tmp_path / "tif_legacy_annual_report_projects_2010_2016.parquet"))
    spark.createDataFrame(listed, "override_id int, tif_number string, canonical_project_name string").write.parquet(str(tmp_path / "project_name_overrides.parquet"))
    got = {r.id: (r.override_id, r.status) for r in queries.QUERIES["project_suggestions"](spark, str(tmp_path)).collect()}
    assert got["T-001|lunellan terisgan towrihomes"] == (1, "strong_suggestion") and got["T-001|zzz"][1] == "unmatched"

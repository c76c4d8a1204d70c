"""The likeliest row of a block, against plain Python, with few likenesses computed."""

import random
from difflib import SequenceMatcher

from ledgerweave.functions.similarity import likeness
from ledgerweave.operators import match


def test_best_of_blocks_against_difflib(spark):
    rng = random.Random(11)
    words = ["lunellan", "towrihomes", "st", "f1eldhouse", "renovat1on", "terisgan", "lofts", "é" * 3, "x" * 40, "lunelan", "mixed use"]
    name = lambda: rng.choice(["", None, *[" ".join(rng.choice(words)[rng.randint(0, 1) :] for _ in range(rng.randint(1, 5))) for _ in range(8)]])
    left = [(f"l{i}", rng.choice(["A", "B", None]), name(), name()) for i in range(150)]
    right = [(i, rng.choice(["A", "B", None]), name(), name()) for i in range(150)]
    want = set()
    for key, t, *a in left:
        like = [(-round(max(SequenceMatcher(None, x, y).ratio() if x and y else 0.0 for x, y in zip(a, b)), 4), rid) for rid, u, *b in right if t is not None and t == u]  # noqa: B905
        if like and min(like)[0] <= -0.82:
            want.add((key, min(like)[1], -min(like)[0]))
    a, b = spark.createDataFrame(left, "id string, t string, a string, c string"), spark.createDataFrame(right, "rid int, t string, b string, d string")
    got = match.best_fuzzy(a, b, ["t"], "id", [("a", "b"), ("c", "d")], "rid", 0.82)
    assert {(r.id, r.rid, r.score) for r in got.collect()} == want and len(want) > 20


def test_a_score_that_rounds_to_the_least_is_accepted(spark):
    common = "".join(random.Random(1).choices("abcdefghij", k=189))
    a, b = spark.createDataFrame([("l", "A", common + "1" * 73)], "id string, t string, a string"), spark.createDataFrame([(1, "A", common + "2" * 10)], "rid int, t string, b string")
    assert [(r.rid, r.score) for r in match.best_fuzzy(a, b, ["t"], "id", [("a", "b")], "rid", 0.82).collect()] == [(1, 0.82)]


def test_likeness_is_that_of_difflib():
    rng = random.Random(3)
    for letters, most in (("ab", 14), ("abc d", 40), ("é\U0001f600x ", 30), ("ab", 230)):
        for _ in range(300):
            x, y = ("".join(rng.choices(letters, k=rng.randint(0, most))) for _ in "ab")
            assert likeness(x, y) == SequenceMatcher(None, x, y).ratio()


def test_few_likenesses_are_computed(monkeypatch):
    """A name that has the letters of others of its block, but in another order, costs no likeness."""
    calls = []
    real = SequenceMatcher.ratio
    monkeypatch.setattr(SequenceMatcher, "ratio", lambda self: calls.append(1) or real(self))
    monkeypatch.setattr(match, "likeness", lambda a, b: calls.append(1) or likeness(a, b), raising=False)
    rng = random.Random(5)
    right = ["".join(rng.choices("abcdefgh", k=30)) for _ in range(9000)]
    left = [t[::-1] for t in right[:99]] + [right[7][:-1]]
    found = match._best_of_block({"a": left}, {"b": [*right, right[7]]}, [("a", "b")], 0.82)
    assert {(i, j) for i, j, _ in found} == {(99, 7), (99, 9000)} and len(calls) < 20
    # more letters than columns, letters beyond them, and blanks
    rare = ["".join(map(chr, range(0x4E00, 0x4E00 + 90))), "a" * 60 + "b" * 12, ""]
    found = match._best_of_block({"a": [rare[0][:-3], "a" * 61 + "b" * 10, "", *[rare[0][k:] for k in (0, 4)]]}, {"b": rare}, [("a", "b")], 0.82)
    assert sorted({(i, j) for i, j, _ in found}) == [(0, 0), (1, 1), (3, 0), (4, 0)]

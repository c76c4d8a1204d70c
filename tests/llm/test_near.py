"""Edits between two words, against a table of all prefixes."""

from __future__ import annotations

from itertools import product
from random import Random
from sys import setprofile

from ledgerweave.llm.district_names import near


def table(a: str, b: str) -> int:
    d = {(i, j): i + j for i in range(len(a) + 1) for j in range(len(b) + 1) if not i or not j}
    for i, j in product(range(1, len(a) + 1), range(1, len(b) + 1)):
        d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return min(d[len(a), len(b)], 3)


def test_all_short_words():
    words = ["".join(w) for n in range(6) for w in product("abc", repeat=n)]
    rng = Random(1)
    for a in words:
        for b in rng.sample(words, 60):
            assert near(a, b) == table(a, b), (a, b)


def test_edited_words():
    rng = Random(2)
    for _ in range(5000):
        a = "".join(rng.choices("abcd", k=rng.randint(4, 12)))
        b = a
        for _ in range(rng.randint(1, 3)):
            i = rng.randrange(len(b))
            b = rng.choice((b[:i] + b[i + 1 :], b[:i] + rng.choice("abcd") + b[i:], b[:i] + rng.choice("abcd") + b[i + 1 :], b[:i] + b[i : i + 2][::-1] + b[i + 2 :])) or "a"
        assert near(a, b) == table(a, b), (a, b)


def test_few_calls():
    """Words that share nothing are told apart without a table."""
    near.cache_clear()
    calls = []
    setprofile(lambda frame, event, arg: calls.append(1) if event == "c_call" else None)
    try:
        assert near("abcdefghij", "klmnopqrst") == 3
    finally:
        setprofile(None)
    assert len(calls) < 12

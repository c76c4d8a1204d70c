"""Names that share only rewritings of very many names are linked like others."""

import random

from ledgerweave.llm import name_variants
from ledgerweave.llm.name_variants import RARE, name_links

SYLLABLES = ("po", "vik", "zel", "mar", "fen", "uano", "gri", "quist", "ald", "ber")


def links(spark, names):
    df = spark.createDataFrame([("T-1", n, []) for n in sorted(names)], "group string, name string, years array<int>")
    return {(r.a, r.b): r.score for r in name_links(df).collect()}


def test_names_of_a_frequent_word_are_linked(spark):
    others = {f"{a}{b.title()[::-1]}{c}ok Hardware".title() for a in SYLLABLES for b in SYLLABLES for c in ("x", "y")}
    got = links(spark, others | {"Zimilette Hardware", "Similettn Hardware"})
    assert got[("Similettn Hardware", "Zimilette Hardware")] < RARE


def test_frequent_forms_give_what_all_pairs_give(spark, monkeypatch):
    rng = random.Random(3)
    word = lambda: rng.choice(["bob", "robert", "ted", "r", "t", *("".join(rng.sample(SYLLABLES, k)) for k in (1, 2, 2, 3))])

    def typed(words):
        words = [w[:i] + rng.choice(["", "x", w[i : i + 2][::-1]]) + w[i + 1 :] if rng.random() < 0.3 else w for w in words for i in [rng.randrange(len(w))]]
        rng.shuffle(words)
        return rng.choice([" ", " ", " ", ""]).join(words) + rng.choice([" lofts", " lofts", " lofts 12", ""])

    names = {typed(ws) for _ in range(70) for ws in [[word() for _ in range(rng.choice([1, 2, 2, 3, 9]))]] for _ in range(4)} | {"A. B. Lofts 12", "C. D. Lofts 12", "Lofts 12"}
    monkeypatch.setattr(name_variants, "RARE", -9.0)
    every = links(spark, names)
    monkeypatch.setattr(name_variants, "RARE", 9.0)
    assert links(spark, names) == every and len(every) > 100

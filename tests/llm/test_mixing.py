import os
import random

import pytest

from ledgerweave.llm import mixing, tokens


def best(lengths, counts, budget):
    reach = {0}
    for n, c in zip(lengths, counts, strict=True):
        reach = {r + k * n for r in reach for k in range(c + 1) if r + k * n <= budget}
    return max(reach)


def test_fit_meets_what_can_be_met():
    rng = random.Random(1)
    for _ in range(200):
        lengths = sorted(rng.sample(range(1, 40), rng.randint(1, 6)))
        counts = [rng.randint(1, 4) for _ in lengths]
        total = sum(n * c for n, c in zip(lengths, counts, strict=True))
        budget, repeats = rng.randint(0, 3 * total), rng.randint(1, 3)
        whole, extra = mixing.fit(lengths, counts, budget, repeats)
        used = whole * total + sum(n * k for n, k in zip(lengths, extra, strict=True))
        assert used <= max(budget, 0) and all(0 <= k <= c for k, c in zip(extra, counts, strict=True)) and whole + (max(extra) > 0) <= repeats
        if whole < repeats:
            assert used == whole * total + best(lengths, counts, budget - whole * total)


def test_fit_of_large_histograms_is_close():
    lengths = list(range(3, 2000, 7))
    counts = [50 + n % 13 for n in lengths]
    total = sum(n * c for n, c in zip(lengths, counts, strict=True))
    _, extra = mixing.fit(lengths, counts, total // 3, 1)
    assert sum(n * k for n, k in zip(lengths, extra, strict=True)) == total // 3


def test_choice_keeps_budgets_and_repeats(spark):
    rng = random.Random(2)
    rows = spark.createDataFrame([(i, rng.choice(["a", "b", "b", "x", None]), rng.choice([0, 5, 5, 5, 7, 11])) for i in range(400)], "key long, source string, n long")
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.2, 1), ("none", 0.3, 4)], "source string, target_share double, max_repeats int")
    chosen = mixing.choose(rows, targets).collect()
    assert len({r.key for r in chosen}) == len(chosen) and {r.source for r in chosen} == {"a", "b"}
    limits = {"a": 2, "b": 1}
    assert all(1 <= r.times <= limits[r.source] and r.n > 0 for r in chosen)
    total = sum(r.n for r in rows.collect())
    report = {r.source: r for r in mixing.shares(rows, mixing.choose(rows, targets), targets).collect()}
    for s, share in (("a", 0.5), ("b", 0.2)):
        used = sum(r.n * r.times for r in chosen if r.source == s)
        have = sum(r.n for r in rows.collect() if r.source == s) * limits[s]
        assert used == report[s].tokens and (used == have if have < round(share * total) else abs(used - round(share * total)) <= 4)
    assert report["none"].tokens == 0
    assert sorted(map(tuple, chosen)) == sorted(map(tuple, mixing.choose(rows, targets).collect()))
    assert mixing.choose(rows.limit(0), targets).count() == 0 and mixing.choose(rows, targets.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.exists(tokens.RANK_FILE), reason="no rank file here")
def test_counted_reads_null_as_no_tokens(spark):
    df = spark.createDataFrame([(1, None, "a", 9), (2, "", "a", 9), (3, "two words", None, 9)], "doc_id long, text string, source string, n long")
    assert sorted((r.key, r.source, r.n) for r in mixing.counted(df).collect()) == [(1, "a", 0), (2, "a", 0), (3, None, 2)]

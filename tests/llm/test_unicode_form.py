import random

import pytest

from ledgerweave.llm import unicode_form
from ledgerweave.llm.unicode_form import compile_mapping, same_look_pairs, transducer

SAME = [
    ("Café", "Café"), ("office", "oﬃce"), ("Hello", "Ｈｅｌｌｏ"), ("a b", "a b"), ("ab", "a‍b"), ("ab", "a­b"), ("scope", "ѕсоре"),
    ("ę́", "ę́"), ("a-b", "a‑b"), ("ї", "ї"), ("ï", "ї"), ("á", "a​́"), ("x\ny", "x\r\ny"), ("IV", "Ⅳ"),
]
APART = [("Cafe", "Café"), ("a", "A"), ("a-b", "a–b"), ("O", "0"), ("l", "1"), ("a b", "a  b"), ("a b", "a\nb"), ("\U0001f469‍\U0001f466", "\U0001f469\U0001f466"), ("\U0001f44d", "\U0001f44d\U0001f3fd")]


@pytest.mark.parametrize("a,b", SAME)
def test_same_look(a, b):
    t = transducer()
    assert t(a) == t(b)


@pytest.mark.parametrize("a,b", APART)
def test_a_reader_can_tell(a, b):
    t = transducer()
    assert t(a) != t(b)


def test_mapping_is_final_and_rewriting_twice_is_once():
    table = compile_mapping()
    assert not any(c in table for form in table.values() for c in form)
    t, rng = transducer(), random.Random(5)
    pool = list(table)[:3000] + list("abc ̨́‍é\r\n") * 50
    for _ in range(300):
        text = "".join(rng.choices(pool, k=30))
        assert t(t(text)) == t(text)


def test_conflicts_are_found(monkeypatch):
    monkeypatch.setitem(unicode_form.LOOK_ALIKE, "clash", ("Ａ", "B"))
    with pytest.raises(ValueError):
        compile_mapping()


def test_pairs_against_brute_force(spark):
    words = [a for p in SAME + APART for a in p] + [None, "", " ", "​", "Cafe", "Cafe"]
    rows = [(i, w, "x") for i, w in enumerate(words)] + [(0, words[0], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, look string")
    t = transducer()
    want = {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if i < j and a and b and a != b and t(a) == t(b) and t(a).strip()}
    got = [tuple(r) for r in same_look_pairs(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert same_look_pairs(df.limit(0)).count() == 0


def test_long_text(spark):
    long = "ае " * 200_000
    df = spark.createDataFrame([(1, long), (2, "ae " * 200_000)], "doc_id long, text string")
    assert [tuple(r) for r in same_look_pairs(df).collect()] == [(1, 2)]

import os

import pytest
from pyspark.sql import functions as F

from ledgerweave.llm import tokens

pytestmark = pytest.mark.skipif(not os.path.exists(tokens.RANK_FILE), reason="no rank file here")
tiktoken = pytest.importorskip("tiktoken")


def encoder():
    with open(tokens.RANK_FILE, "rb") as f:
        return tokens._encoder(f.read())


def test_null_empty_blank_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n"), (4, "Hello world"), (4, "Hello world")], "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = sorted((r.doc_id, list(r.ids)) for r in tokens.encode(df).collect())
    e = encoder()
    assert got == [(1, []), (2, []), (3, e.encode_ordinary(" \n")), (4, e.encode_ordinary("Hello world")), (4, e.encode_ordinary("Hello world"))]
    assert tokens.encode(df.limit(0)).count() == 0


TEXTS = ["it's 3's  we'll\n\n x1y2 --- 漢字，漢字 ", "a" * 5000 + "1" * 3000 + " b", "  \t\n" * 900, "Zażółć gęślą jaźń " * 300, "x y z " * 200, "can't've " * 500, "a1" * 2000, "'s" * 1500]


@pytest.mark.parametrize("text", TEXTS)
@pytest.mark.parametrize("size", [1, 7, 100, 1000])
def test_parts_change_nothing(text, size):
    e = encoder()
    assert "".join(tokens.parts(text, size)) == text
    assert tokens.encode_text(e, text, size) == e.encode_ordinary(text)


def test_round_trip(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(99, None)], "doc_id long, text string")
    assert all(r.same for r in tokens.roundtrip(df).collect())

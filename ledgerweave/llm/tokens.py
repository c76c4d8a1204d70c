"""Encoding of whole texts with a public byte-level BPE vocabulary (problem 6).

The vocabulary is a local rank file; its path is a parameter. The driver reads it once (under 1 MB, a
fixed size) and sends it to the workers, which build the encoder once per process.

Defined cases: an empty text and a null text both give the empty list of ids; blank texts are encoded
like any other; a text of any length is encoded whole; repeated rows give repeated rows; an empty table
gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RANK_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Splits text before the merges; belongs to the public vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Longer texts are encoded in parts of about this many characters.
PART = 100_000
#: Places that no token of PATTERN spans, and before which the text has no influence on what follows.
_SAFE = r"(?<=[\p{L}\p{N}\p{P}])(?=[ \n])|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})"

_encoders: dict[str, object] = {}


def _encoder(ranks: bytes):
    import tiktoken

    key = hashlib.md5(ranks).hexdigest()
    if key not in _encoders:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        _encoders[key] = tiktoken.Encoding("local", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
    return _encoders[key]


def parts(text: str, size: int = PART) -> Iterator[str]:
    """Cut a long text at safe places, each part at least ``size`` long where there is such a place."""
    import regex

    safe, at = regex.compile(_SAFE), 0
    while len(text) - at > size:
        m = safe.search(text, at + size)
        if m is None:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


def encode_text(encoder, text: str | None, size: int = PART) -> list[int]:
    if not text:
        return []
    if len(text) <= size:
        return encoder.encode_ordinary(text)
    return [i for part in parts(text, size) for i in encoder.encode_ordinary(part)]


def _ranks(spark: SparkSession, rank_file: str):
    with open(rank_file, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def ids_of(spark: SparkSession, text: Column, rank_file: str = RANK_FILE) -> Column:
    """Token ids of a text column."""
    ranks = _ranks(spark, rank_file)

    @F.pandas_udf("array<int>")
    def ids(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoder(ranks.value)
        for batch in texts:
            yield pd.Series([encode_text(encoder, t) for t in batch], dtype=object)

    return ids(text)


def count_of(spark: SparkSession, text: Column, rank_file: str = RANK_FILE) -> Column:
    """Number of tokens of a text column; only the number leaves the worker."""
    ranks = _ranks(spark, rank_file)

    @F.pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoder(ranks.value)
        for batch in texts:
            yield pd.Series([len(encode_text(encoder, t)) for t in batch], dtype="int64")

    return count(text)


def text_of(spark: SparkSession, ids: Column, rank_file: str = RANK_FILE) -> Column:
    """Text of a list of ids: the bytes of all ids are joined before they are read as UTF-8."""
    ranks = _ranks(spark, rank_file)

    @F.pandas_udf("string")
    def text(lists: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoder(ranks.value)
        for batch in lists:
            yield pd.Series([None if x is None else encoder.decode_bytes(list(map(int, x))).decode("utf-8", "replace") for x in batch], dtype=object)

    return text(ids)


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", rank_file: str = RANK_FILE) -> DataFrame:
    """``(key, ids)`` of every row."""
    return df.select(F.col(key), F.col(text).alias("_t")).select(key, ids_of(df.sparkSession, F.col("_t"), rank_file).alias("ids"))


def roundtrip(df: DataFrame, key: str = "doc_id", text: str = "text", rank_file: str = RANK_FILE) -> DataFrame:
    """``(key, n_tokens, n_bytes, same)``: whether the decoded ids are the text again (null reads as empty)."""
    spark = df.sparkSession
    rows = df.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_t")).withColumn("_ids", ids_of(spark, F.col("_t"), rank_file))
    return rows.select(key, F.size("_ids").cast("long").alias("n_tokens"), F.octet_length("_t").cast("long").alias("n_bytes"), (text_of(spark, F.col("_ids"), rank_file) == F.col("_t")).alias("same"))

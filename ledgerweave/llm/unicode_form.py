"""One form for texts that look the same (problem 8).

A transducer over grapheme clusters rewrites each cluster to the form under which all clusters of the
same look are equal. Its mapping is computed once, from rules over Unicode's own tables and the list of
look-alike letters below, and checked for conflicts (``compile_mapping``). Applying it is one pass: runs
that need no change are skipped, else the longest match at the position is rewritten.

What counts as one look: full-width and half-width forms, presentation ligatures and Roman numerals as their letters,
composed and decomposed accents, kinds of space of one character each, hyphen and non-breaking hyphen,
invisible format characters, and letters of other scripts drawn like a Latin letter. What a reader can
tell apart stays apart: case, accents, dashes of another length, digits and letters, number of spaces,
line ends (except that CR LF and CR are LF), a joined emoji and its parts.

Defined cases: null stays null; the empty text stays empty; a text of any length is rewritten whole.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerweave.session import cut

#: Letters of other scripts and the Latin letters they are drawn like. Fixed values.
LOOK_ALIKE = {
    "Cyrillic": ("АВЕКМНОРСТХЅІЈԚԜѴԌҮаеорсухѕіјһԁԛԝӏѵ", "ABEKMHOPCTXSIJQWVGYaeopcyxsijhdqwlv"),
    "Greek": ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿοϲϳ", "ABEZHIKMNOPTYXCJocj"),
    "Armenian": ("օ", "o"),
    "Latin": ("ɡ", "g"),
    "hyphens": ("\u2010\u2011", "--"),
}
#: Characters without a look of their own.
INVISIBLE = "\u00ad\u034f\u061c\u180e\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\u2061\u2062\u2063\u2064\u2066\u2067\u2068\u2069\ufeff"
#: Signs after which an invisible joiner or a variation selector changes the look (emoji).
_PICTURE = "©®\u203c-\u3299\U0001f000-\U0001faff"
_JOINER = "\u200d"


def compile_mapping() -> dict[str, str]:
    """Character to its form, for every character that is not its own form.

    Conflict checks: no character has two forms, and every form is itself final (rewriting twice is
    rewriting once).
    """
    table: dict[str, str] = {}

    def put(char: str, form: str) -> None:
        if char != form and table.setdefault(char, form) != form:
            raise ValueError(f"conflicting forms of U+{ord(char):04X}: {table[char]!r}, {form!r}")

    for i in range(0x80, sys.maxunicode + 1):
        char = chr(i)
        kind = unicodedata.decomposition(char).split(" ")[0]
        if kind in ("<wide>", "<narrow>") or (kind == "<compat>" and (0xFB00 <= i <= 0xFB04 or i == 0xFB06 or 0x2160 <= i <= 0x217F)):
            put(char, unicodedata.normalize("NFKC", char))
        elif unicodedata.category(char) == "Zs":
            put(char, " ")
    for chars, forms in LOOK_ALIKE.values():
        for char, form in zip(chars, forms, strict=True):
            put(char, form)
    for char in INVISIBLE:
        put(char, "")
    for char, form in list(table.items()):
        final = "".join(table.get(x, x) for x in form)
        if any(x in table for x in final):
            raise ValueError(f"the form of U+{ord(char):04X} is not final")
        table[char] = final
    return table


class Transducer:
    """Longest-match rewriting of clusters; clusters met are kept, as their number is small."""

    def __init__(self) -> None:
        import regex

        self.table = compile_mapping()
        self.seen: dict[str, str] = {}
        invisible = regex.escape(INVISIBLE)
        # an emoji sequence, a cluster with marks or invisible characters in it, or a lone character
        emoji, tail = rf"[{_PICTURE}]", "[\ufe0e\ufe0f\U0001f3fb-\U0001f3ff]*"
        self.pattern = regex.compile(
            rf"{emoji}(?:{tail}{_JOINER}{emoji})+{tail}"
            r"|\r\n?"
            rf"|[\x00-\x0c\x0e-\x7f](?:[{invisible}]*\p{{M}})+"
            rf"|[^\x00-\x7f](?:[{invisible}]*\p{{M}})*"
        )

    def _form(self, cluster: str) -> str:
        if cluster[0] == "\r":
            return "\n"
        if _JOINER in cluster and len(cluster) > 2 and cluster[0] not in self.table and not unicodedata.category(cluster[0]).startswith(("L", "Z", "M")):
            return cluster
        parts = unicodedata.normalize("NFD", "".join(self.table.get(c, c) for c in cluster))
        return unicodedata.normalize("NFC", "".join(self.table.get(c, c) for c in parts))

    def _rewrite(self, match) -> str:
        cluster = match.group()
        form = self.seen.get(cluster)
        if form is None:
            form = self._form(cluster)
            if len(self.seen) < 100_000:
                self.seen[cluster] = form
        return form

    def __call__(self, text: str | None) -> str | None:
        if text is None or (text.isascii() and "\r" not in text):
            return text
        out = self.pattern.sub(self._rewrite, text)
        # an invisible character may have stood between a letter and its mark, or a rewritten letter before one
        return out if out.isascii() else unicodedata.normalize("NFC", out)


@lru_cache(maxsize=1)
def transducer() -> Transducer:
    return Transducer()


@F.pandas_udf(T.StringType())
def _form(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    rewrite = transducer()
    for batch in texts:
        yield batch.map(rewrite, na_action="ignore").astype(object)


def one_form(text: Column) -> Column:
    return _form(text)


@F.pandas_udf(T.StructType([T.StructField("look", T.BinaryType()), T.StructField("raw", T.BinaryType())]))
def _digests(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Digests of the form and of the text itself; null where the text has no visible character."""
    from hashlib import blake2b

    rewrite = transducer()
    for batch in texts:
        looks, raws = [], []
        for text in batch:
            form = rewrite(text)
            if form is None or not form.strip():
                looks.append(None)
                raws.append(None)
            else:
                looks.append(blake2b(form.encode("utf-8", "surrogatepass"), digest_size=16).digest())
                raws.append(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest())
        yield pd.DataFrame({"look": pd.Series(looks, dtype=object), "raw": pd.Series(raws, dtype=object)})


def normalised(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, form, changed)`` of every row."""
    rows = df.select(F.col(key), F.col(text).alias("_t")).withColumn("form", one_form(F.col("_t")))
    return rows.select(key, "form", (~F.col("form").eqNullSafe(F.col("_t"))).alias("changed"))


def same_look_pairs(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key_a, key_b)``: rows whose texts have one form but are not equal as strings, smaller key first.

    Texts travel as 128-bit digests. Groups of exact copies only are left out before the join: a form
    stays if two different texts have it. Null, empty and invisible texts are in no pair; a row is in no
    pair with an equal text; repeated rows with one key are one row; an empty table gives no pair.
    """
    digest = df.select(F.col(key).alias("_k"), _digests(F.col(text)).alias("_d"))
    rows = digest.select("_k", F.col("_d.look").alias("_look"), F.col("_d.raw").alias("_raw")).filter("_k is not null and _look is not null").distinct()
    rows = cut(rows)  # two digests a row; the texts are read and rewritten once
    mixed = rows.groupBy("_look").agg(F.min("_raw").alias("_lo"), F.max("_raw").alias("_hi")).filter("_lo <> _hi").select("_look")
    kept = cut(rows.join(mixed, "_look", "left_semi"))
    # different texts of one look are paired first, whatever their copies; then each pair goes to its rows
    texts = kept.select("_look", "_raw").distinct()
    both = texts.select("_look", F.col("_raw").alias("_ra")).join(texts.select("_look", F.col("_raw").alias("_rb")), "_look").filter("_ra < _rb").select("_ra", "_rb")
    a = kept.select(F.col("_raw").alias("_ra"), F.col("_k").alias("_ka"))
    b = kept.select(F.col("_raw").alias("_rb"), F.col("_k").alias("_kb"))
    pairs = both.join(a, "_ra").join(b, "_rb").filter("_ka <> _kb")
    return pairs.select(F.least("_ka", "_kb").alias(f"{key}_a"), F.greatest("_ka", "_kb").alias(f"{key}_b")).distinct()

"""Lines at the edges of scanned pages, and the text between them (used by problem 2).

Running headers are learnt from the corpus: a header is a line set like a heading that recurs, digits masked, over many rows
and at any place of a text, whose first or last words hardly ever stand anywhere but at that edge of a line, and beside which
the text breaks off in many ways. Nothing about their wording is given.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of a line that identify it, at its beginning or end.
ANCHOR = 3
#: Share of the texts of several lines that a header recurs in at least; bounds how many headers there can be.
SUPPORT = 0.001
#: Least number of rows with a header, in small tables.
LEAST = 4
#: Least share of a header's lines that have text before them, and that have text after them.
ANYWHERE = 0.2
#: Least share of an anchor's occurrences that stand at the edge of a line.
STABLE = 0.8
#: Most of a header's lines that one and the same word stands beside.
SAME = 0.5

#: How page numbers are written. Fixed patterns.
PAGES = (
    r"P a g e \| \d+", r"(?:Page|PAGE) \d+(?: (?:of|OF) \d+)?", r"pg\. \d+", r"(?<![\w-])- \d{1,4} -(?![\w-])", r"\[\d{1,4}\]", r"\[?\bp\. ?\d{1,4}\b\]?",
    r"(?<=\n)[ \t]*\d{1,3}[ \t]*(?=\n|\Z)", r"\A[ \t]*\d{1,3}[ \t]*(?=\n)", r"(?<=[a-z][-‐­]) +\d{1,3} +(?=[a-z])",
)
_PAGE = re.compile("|".join(PAGES))
_PAGE_LINE = re.compile(rf"(?:{'|'.join(PAGES[:6])}|\d+)\Z")
_LAST = re.compile(r"([a-z]\s[a-z0-9]{1,20}\.) +\d{1,3} *\Z")
_HINTS = ("age ", "AGE ", "a g e", "pg.", "[", "p. ")
_HINT = re.compile(r"[-‐­] +\d|\n[ \t]*\d{1,3}[ \t]*(?:\n|\Z)")
_LOWER = re.compile(r"(?:^| )(?!(?:of|and|the|for|in|at|to|on|by)(?: |$))[a-z]")
_NUMBER_BESIDE = re.compile(r"^\d{1,4} {2,}| {2,}\d{1,4}$")
_HYPHEN = re.compile(r"([-‐­])(\s+)(?!(?:and|or|to)\b)(?=[\w@(])")
_MARKS = re.compile(r"[ \t]*\n?[ \t]*[\x01\x02]+[ \t]*")
_HEADER_AT, _NUMBER_AT, _RUN, _HELD = "\x01", "\x02", "\x03", "\x04"
_AROUND = r".,;:!?()\[\]{}\"'“”‘’*"

Anchor = tuple[bool, str, str, str, int]


def _plain_ends(text: str) -> str:
    return text.replace("\r\n", "\n").replace("\r", "\n") if "\r" in text else text


def _mask(text: str) -> str:
    return re.sub(r"\d+", "#", text)


def _literal(masked: str) -> str:
    return re.escape(masked).replace(r"\#", r"\d+")


def _edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of the first and last words of heading-like lines and of the words beside them; the number of texts of several lines."""
    found, texts = {}, 0
    for batch in batches:
        for text in batch["text"]:
            if not text or ("\n" not in text and "\r" not in text):
                continue
            lines = [x.strip() for x in _plain_ends(text).split("\n")]
            lines = [x for x in lines if x and not (len(x) < 20 and _PAGE_LINE.match(x))]
            texts += 1
            for i, line in enumerate(lines):
                if _LOWER.search(line):
                    continue
                words = _mask(_NUMBER_BESIDE.sub("", line)).split()
                if len(words) < 2:
                    continue
                masked = " ".join(words)
                later, followed = i > 0, i < len(lines) - 1
                beside = (lines[i - 1].rpartition(" ")[2].rstrip("-‐­") if later else None, lines[i + 1].partition(" ")[0] if followed else None)
                for first, anchor, word in ((True, " ".join(words[:ANCHOR]), beside[0]), (False, " ".join(words[-ANCHOR:]), beside[1])):
                    if re.search(r"[.;,](?: |$)|[-‐­]$", anchor):
                        continue
                    row = found.setdefault((first, anchor, word), [0, 0, 0, masked, masked, 0])
                    row[0] += 1
                    row[1] += later
                    row[2] += followed
                    row[3], row[4], row[5] = min(row[3], masked), max(row[4], masked), max(row[5], len(words))
            if len(found) > 200_000:
                yield pd.DataFrame([(*k, *v) for k, v in found.items()], columns=_EDGE)
                found = {}
    found[True, None, None] = [texts, 0, 0, None, None, 0]
    yield pd.DataFrame([(*k, *v) for k, v in found.items()], columns=_EDGE)


_EDGE = ["first", "anchor", "beside", "c", "later", "followed", "lo", "hi", "n"]


def header_anchors(rows: DataFrame, text: str = "text") -> list[Anchor]:
    """``(at the beginning, anchor, smallest line, greatest line, most words)`` of the running headers of a corpus.

    All statistics are over all rows, counted per task first; what reaches the driver is bounded by ``SUPPORT``.
    """
    texts = rows.select(F.col(text).alias("text"))
    edges = texts.mapInPandas(_edges, "first boolean, anchor string, beside string, c long, later long, followed long, lo string, hi string, n long")
    by_beside = edges.groupBy("first", "anchor", "beside").agg(*[F.sum(x).alias(x) for x in ("c", "later", "followed")], F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("n").alias("n"))
    by_anchor = by_beside.groupBy("first", "anchor").agg(*[F.sum(x).alias(x) for x in ("c", "later", "followed")], F.max(F.when(F.col("beside").isNotNull(), F.col("c"))).alias("same"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("n").alias("n"))
    likely = by_anchor.filter((F.col("c") >= LEAST) & (F.col("later") >= ANYWHERE * F.col("c")) & (F.col("followed") >= ANYWHERE * F.col("c")) & (F.col("same") <= SAME * F.when(F.col("first"), F.col("later")).otherwise(F.col("followed"))))
    total = F.max(F.when(F.col("anchor").isNull(), F.col("c")))
    several = by_anchor.agg(total).first()[0] or 0
    found = likely.filter(F.col("anchor").isNotNull() & (F.col("c") >= SUPPORT * several)).collect()
    if not found:
        return []
    # how often the words of an anchor stand anywhere in texts of several lines
    patterns = {r["anchor"]: (max(r["anchor"].split("#"), key=len), re.compile(f"(?<!\\S){_literal(r['anchor'])}(?!\\S)")) for r in found}

    def anywhere(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch["text"]:
                if text and ("\n" in text or "\r" in text):
                    running = " ".join(text.split())
                    for anchor, (piece, pattern) in patterns.items():
                        if piece.strip() in running:
                            counts[anchor] += len(pattern.findall(running))
        yield pd.DataFrame(list(counts.items()), columns=["anchor", "c"])

    counts = dict(texts.mapInPandas(anywhere, "anchor string, c long").groupBy("anchor").sum("c").collect())
    return sorted((r["first"], r["anchor"], r["lo"], r["hi"], r["n"]) for r in found if r["c"] >= STABLE * counts.get(r["anchor"], 0))


class Scanner:
    """Takes headers and page numbers out of a text and puts split words together."""

    def __init__(self, anchors: Sequence[Anchor]) -> None:
        out, self.pieces = {_literal(lo) for _, _, lo, hi, _ in anchors if lo == hi}, set()
        for first, anchor, lo, hi, n in anchors:
            if lo != hi:  # the anchor, with words of the letter case met beside it
                free = n - len(anchor.split(" "))
                word = r"[A-Z0-9(&-][A-Z0-9/.'&()-]*" if (lo + hi).upper() == lo + hi else r"[A-Z0-9(&-][\w/.'&():-]*"
                out.add(_literal(anchor) + f"(?: {word}){{0,{free}}}" if first else f"(?:{word} ){{0,{free}}}" + _literal(anchor))
            self.pieces.add(max((lo if lo == hi else anchor).split("#"), key=len).strip())
        one = "(?:" + "|".join(sorted(out, key=lambda p: (-len(p), p))) + ")"
        self.header = re.compile(rf"(?:(?<![\w,.$-])\d{{1,4}} {{2,}})(?<!\S\x02){one}|(?<![^\s\x02]){one}(?: {{2,}}\d{{1,4}}(?![\w,]))?") if out else None
        self.alone = re.compile(one) if out else None

    def _out(self, m: re.Match) -> str:
        return _HEADER_AT if self.alone.fullmatch(m.group()) else _HEADER_AT + _NUMBER_AT

    def __call__(self, text: str | None) -> tuple[bool, bool, str]:
        """Whether there is a header, a page number, and the text without both as tokens with single spaces between."""
        if not text:
            return False, False, ""
        x = _plain_ends(text)
        if any(c in x for c in "\x01\x02\x03\x04"):
            x = re.sub("[\x01-\x04]", "", x)
        if any(h in x for h in _HINTS) or _HINT.search(x) or _bare_only(x):
            x = _PAGE.sub(_NUMBER_AT, x)
        if x.rstrip(" ")[-1:].isdigit():
            x = _LAST.sub(r"\1" + _NUMBER_AT, x)
        if self.header and any(p in x for p in self.pieces):
            x = self.header.sub(self._out, x)
        header, page = _HEADER_AT in x, _NUMBER_AT in x
        if header or page:
            x = _MARKS.sub(lambda m: "\n" if "\n" in m.group() else " ", x)
        if "·" in x:  # a misread p, with the space that its tail leaves
            x = re.sub(r"(?<=\w)·[ \t]?(?=\w)", "·", x)
        if "-" in x or "‐" in x or "­" in x:
            x = _HYPHEN.sub(lambda m: _joined(m, x), x)
        return header, page, " ".join(x.split())


def _bare_only(x: str) -> bool:
    return x[:4].lstrip(" \t")[:1].isdigit() and "\n" in x


def _joined(m: re.Match, x: str) -> str:
    before, after = x[m.start() - 1 : m.start()], x[m.end() : m.end() + 1]
    if not (before.isalnum() or before in ("@", "(", "'")) or (m.group(1) != "-" and "\n" not in m.group(2) and after.isupper()):
        return m.group()
    return _RUN if m.group(1) == "-" else _HELD


def whole_words(body: str) -> str:
    """The text of a scanner's tokens, parts of split words run together."""
    return re.sub(f"[{_RUN}{_HELD}]", "", re.sub(f"{_RUN}(?=[A-Z])", "-", body))


def scanned(rows: DataFrame, anchors: Sequence[Anchor]) -> DataFrame:
    """``(tbl, row_id, header, page, body)`` of rows ``(tbl, row_id, text)``.

    ``body`` has the tokens without headers and page numbers, single spaces between; one that was split at a line end is
    whole again, with a mark where it was split.
    """

    @F.pandas_udf("header boolean, page boolean, body string")
    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(anchors)
        for batch in texts:
            yield pd.DataFrame([scanner(t) for t in batch], columns=["header", "page", "body"])

    return rows.select("tbl", "row_id", scan("text").alias("s")).select("tbl", "row_id", "s.header", "s.page", "s.body")


def token_counts(scans: DataFrame) -> DataFrame:
    """``(token, n)`` of all tokens, counted per task first."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for body in batch["body"]:
                counts.update(body.split(" "))
            if len(counts) > 500_000:
                yield pd.DataFrame(list(counts.items()), columns=["token", "n"])
                counts.clear()
        yield pd.DataFrame(list(counts.items()), columns=["token", "n"])

    return scans.select("body").mapInPandas(count, "token string, n long").filter("token <> ''").groupBy("token").agg(F.sum("n").alias("n"))


def tokens_but(scans: DataFrame, clean: Sequence[str]) -> DataFrame:
    """``(tbl, row_id, token)``: the distinct tokens of each row that are not among the clean ones."""
    sent = scans.sparkSession.sparkContext.broadcast(frozenset(clean))

    def rest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(t, r, w) for t, r, b in zip(batch["tbl"], batch["row_id"], batch["body"], strict=True) for w in set(b.split(" ")).difference(sent.value) if w]
            yield pd.DataFrame(out, columns=["tbl", "row_id", "token"])

    return scans.select("tbl", "row_id", "body").mapInPandas(rest, "tbl string, row_id long, token string")


def bare(c: Column) -> Column:
    """A token lower-cased, without punctuation around it."""
    c = F.regexp_replace(F.regexp_replace(c, "­", ""), "‐", "-")
    tail = F.regexp_replace(c, f"[{_AROUND}]+$", "")
    misread_c = c.rlike(r"^\([a-z0-9]{2}[^)]*$")
    return F.lower(F.regexp_replace(F.when(misread_c, tail).otherwise(F.regexp_replace(tail, f"^[{_AROUND}]+", "")), "^-+|-+$", ""))


def run_together(token: Column) -> Column:
    """The token as it stands: parts of a split word run together, a hyphen kept before a capital letter."""
    return F.regexp_replace(F.regexp_replace(token, _RUN + r"(?=\p{Lu})", "-"), f"[{_RUN}{_HELD}]", "")


def with_hyphens(token: Column) -> Column:
    """The token with a hyphen wherever it was split; empty if it was not."""
    return F.when(token.rlike(f"[{_RUN}{_HELD}]"), F.regexp_replace(token, f"[{_RUN}{_HELD}]", "-")).otherwise("")

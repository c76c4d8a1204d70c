"""Remote sources whose transport is a function: per-key calls, catalogs, counts, crawls, downloads and probes.

``fetch(url) -> bytes`` runs inside the tasks and may raise; a failure becomes a row, not an abort.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerweave.functions.text import norm_text, report_year
from ledgerweave.functions.url import absolute, is_pdf, links_of
from ledgerweave.operators.rank import first_per_key
from ledgerweave.sources.files import valid_pdf
from ledgerweave.sources.paged import with_retry

Fetch = Callable[[str], bytes]

_ANSWER = T.StructType([T.StructField("url", T.StringType()), T.StructField("status", T.StringType()), T.StructField("code", T.IntegerType()), T.StructField("content", T.BinaryType()), T.StructField("note", T.StringType())])


def fetched(urls: DataFrame, url: str, fetch: Fetch, tries: int = 3, pause: float = 1.0) -> DataFrame:
    """``(url, status, code, content, note)`` of distinct URLs: status ``ok`` or ``failed``, the HTTP code where the error has one."""

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for u in batch["url"]:
                try:
                    rows.append((u, "ok", 200, with_retry(lambda u=u: fetch(u), tries, pause), ""))
                except Exception as error:  # noqa: BLE001
                    rows.append((u, "failed", getattr(error, "code", None), None, str(error)[:500]))
            yield pd.DataFrame(rows, columns=_ANSWER.names).astype({"code": "Int32"})

    return urls.select(F.col(url).alias("url")).filter("url is not null").distinct().mapInPandas(call, _ANSWER)


def fan_out(parents: DataFrame, key: str, keep: Sequence[str], to_url: Callable[[str], str], fetch: Fetch, child: T.StructType, tries: int = 3, pause: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """One call per parent: child rows with the parent's columns, and ``(key, status, note)`` of the calls. Answers are JSON arrays."""
    asked = parents.select(key).filter(F.col(key).isNotNull()).distinct()
    made = F.pandas_udf(lambda keys: keys.map(to_url), "string")
    urls = asked.withColumn("url", made(F.col(key).cast("string")))
    answers = urls.join(fetched(urls, "url", fetch, tries, pause), "url")
    rows = answers.filter("status = 'ok'").select(key, F.explode(F.from_json(F.col("content").cast("string"), T.ArrayType(child))).alias("_c")).select(key, "_c.*")
    return parents.select(key, *keep).join(rows, key), answers.select(key, "status", "note")


def catalog_hits(catalog: DataFrame, name: str, term: str) -> DataFrame:
    """Entries of a catalog whose normal form holds a term."""
    return catalog.filter(norm_text(F.col(name)).contains(term))


def source_counts(spark: SparkSession, sources: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """``(source, status, n)`` of each source, counted where it is; one that cannot be read is ``failed``."""
    rows = []
    for name, open_source in sources.items():
        try:
            rows.append((name, "ok", open_source().count()))
        except Exception:  # noqa: BLE001
            rows.append((name, "failed", None))
    return spark.createDataFrame(rows, "source string, status string, n long")


def crawl(start: DataFrame, fetch: Fetch, words: Sequence[str], suffix: str = ".html", tries: int = 3, pause: float = 1.0) -> DataFrame:
    """``(link, page, report_year)`` of the PDFs two levels below index pages ``(url)``.

    Of an index the links that hold all words and end with the suffix are followed; every page and PDF counts once. The year
    is that of the PDF's URL, else that of its page's.
    """

    def links(pages: DataFrame) -> DataFrame:
        html = fetched(pages, "url", fetch, tries, pause).filter("status = 'ok'")
        found = html.select("url", F.posexplode(links_of(F.col("content").cast("string"))).alias("i", "raw"))
        return found.select("url", "i", absolute(F.col("raw"), F.col("url")).alias("link")).filter("link is not null")

    inner = links(start).filter(followed(F.col("link"), words, suffix)).select(F.col("link").alias("url")).distinct()
    pdfs = links(inner).filter(is_pdf(F.lit(""), F.col("link")))
    once = first_per_key(pdfs, ["link"], [F.asc("url"), F.asc("i")])
    return once.select("link", F.col("url").alias("page"), F.coalesce(report_year(F.col("link")), report_year(F.col("url"))).alias("report_year"))


def followed(link, words: Sequence[str], suffix: str):
    """Whether a link holds all words and ends with the suffix, in any letter case."""
    low = F.lower(link)
    out = low.endswith(suffix)
    for word in words:
        out = out & low.contains(word)
    return out


def downloads(links: DataFrame, url: str, stored: DataFrame, fetch: Fetch, most: int = 0, least: int = 500, tries: int = 3, pause: float = 1.0) -> DataFrame:
    """``(url, status, code, content, note)``: ``exists`` where a valid file is stored already, else ``downloaded``, ``invalid`` (no PDF; its bytes are dropped) or ``failed``.

    ``stored`` has ``(url, content)``; ``most`` is the greatest number of attempts, 0 for all.
    """
    wanted = links.select(F.col(url).alias("url")).filter("url is not null").distinct()
    there = stored.filter(valid_pdf(F.col("content"), least)).select("url").distinct()
    todo = wanted.join(there, "url", "left_anti")
    if most:
        todo = todo.orderBy("url").limit(most)
    got = fetched(todo, "url", fetch, tries, pause)
    good = valid_pdf(F.col("content"), least)
    new = got.select("url", F.when(F.col("status") == "failed", "failed").when(good, "downloaded").otherwise("invalid").alias("status"), "code", F.when(good, F.col("content")).alias("content"), "note")
    old = wanted.join(there, "url", "left_semi").select("url", F.lit("exists").alias("status"), F.lit(None).cast("int").alias("code"), F.lit(None).cast("binary").alias("content"), F.lit("").alias("note"))
    return new.unionByName(old)


def csv_bodies(answers: DataFrame) -> DataFrame:
    """Answers that should be CSV, those that begin like a JSON error set to ``failed``."""
    head = F.substring(F.col("content").cast("string"), 1, 120)
    return answers.withColumn("status", F.when(head.rlike(r"^\s*\{"), "failed").otherwise(F.col("status")))


def raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line_no, line)`` of one text file in its order."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line"))


def with_ocr(pages: DataFrame, text: str, image: str, ocr: Callable[[bytes], str], least: int = 25) -> DataFrame:
    """Page texts, those with fewer than ``least`` characters read from the page's image by ``ocr``; ``method`` says which."""
    read = F.pandas_udf(lambda images: images.map(lambda b: None if b is None else ocr(bytes(b))), "string")
    short = F.length(F.trim(F.coalesce(text, F.lit("")))) < least
    # only the short pages reach Python
    seen = pages.filter(short).withColumn(text, F.coalesce(read(F.col(image)), text)).withColumn("method", F.lit("ocr"))
    return pages.filter(~short).withColumn("method", F.lit("text")).unionByName(seen)


def existing_union(openers: Mapping[str, Callable[[], DataFrame]], columns: Sequence[str], tag: str = "source") -> DataFrame:
    """UNION ALL of the given columns of same-shaped sources, tagged; sources that do not exist are left out."""
    from pyspark.errors import AnalysisException

    out = None
    for name, open_source in openers.items():
        try:
            part = open_source().select(*columns, F.lit(name).alias(tag))
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            continue
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise FileNotFoundError(", ".join(openers))
    return out

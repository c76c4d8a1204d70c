"""URLs and links as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def absolute(link: Column, page: Column) -> Column:
    """A link of a page as an absolute URL; null for fragments, scripts and mail addresses."""
    host = F.regexp_extract(page, r"^(https?://[^/]+)", 1)
    folder = F.regexp_replace(F.regexp_replace(page, r"[?#].*$", ""), r"/[^/]*$", "/")
    return (
        F.when(link.rlike(r"(?i)^(javascript:|mailto:|#)") | (F.trim(link) == ""), None)
        .when(link.rlike(r"(?i)^https?://"), link)
        .when(link.startswith("//"), F.concat(F.lit("https:"), link))
        .when(link.startswith("/"), F.concat(host, link))
        .otherwise(F.concat(folder, link))
    )


def tail(url: Column) -> Column:
    """Last part of the path, without query and fragment."""
    return F.element_at(F.split(F.regexp_replace(url, r"[?#].*$", ""), "/"), -1)


def links_of(html: Column) -> Column:
    """Targets of the links of an HTML text, in order."""
    return F.regexp_extract_all(html, F.lit("""(?i)<a\\s[^>]*href=["']([^"']*)["']"""), F.lit(1))


def is_pdf(name: Column, url: Column) -> Column:
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    return low(name).contains(".pdf") | low(url).contains(".pdf")

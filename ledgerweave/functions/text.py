"""Normal forms of text as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm_text(c: Column) -> Column:
    """Lower case, every run of other characters than a-z and 0-9 one space, trimmed; null reads as empty."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", " "))


def clean_space(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def slug(c: Column, most: int = 64, default: str = "item") -> Column:
    return F.left(F.coalesce(F.nullif(F.replace(norm_text(c), F.lit(" "), F.lit("-")), F.lit("")), F.lit(default)), F.lit(most))


def safe_filename(c: Column, most: int = 140, default: str = "file") -> Column:
    name = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), "[^A-Za-z0-9._-]+", "_"), "^_+|_+$", "")
    return F.left(F.coalesce(F.nullif(name, F.lit("")), F.lit(default)), F.lit(most))


def without_words(c: Column, stop: Sequence[str]) -> Column:
    """Normal form without the given words."""
    words = F.filter(F.split(norm_text(c), " "), lambda t: ~t.isin(*stop))
    return F.array_join(words, " ")


def rewritten(c: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Normal form with substrings replaced in order (substrings, not words)."""
    out = norm_text(c)
    for old, new in pairs:
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.trim(F.regexp_replace(out, " +", " "))


def person_name(c: Column) -> Column:
    """``Last, First Jr.`` as ``first last``: letters only, generational suffix dropped."""
    swapped = F.when(c.contains(","), F.concat_ws(" ", F.trim(F.substring_index(c, ",", -1)), F.trim(F.substring_index(c, ",", 1)))).otherwise(c)
    letters = F.regexp_replace(F.lower(F.coalesce(swapped, F.lit(""))), "[^a-z]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(letters, r"\b(jr|sr|ii|iii|iv)\b", " "), " +", " "))


def strip_markup(c: Column) -> Column:
    """Text of wiki or HTML markup: references, templates and tags dropped, links and quotes unwrapped, common entities read."""
    out = F.regexp_replace(c, r"(?is)<ref[^>]*/>|<ref[^>]*>.*?</ref>", "")
    out = F.regexp_replace(out, r"\{\{[^{}]*\}\}", "")
    out = F.regexp_replace(out, r"<[^>]+>", "")
    out = F.regexp_replace(out, r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]", "$1")
    out = F.regexp_replace(out, r"'{2,}", "")
    for entity, char in (("&nbsp;", " "), ("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def before_first(c: Column, tokens: Sequence[str]) -> Column:
    """Text before the earliest of several tokens (whole text if none occurs)."""
    at = F.least(*[F.nullif(F.position(F.lit(t), c), F.lit(0)) for t in tokens], F.lit(None).cast("int"))
    return F.when(at.isNull(), c).otherwise(F.substring(c, F.lit(1), at - 1))


def ward_number(c: Column) -> Column:
    """First whole token that is a number from 1 to 50."""
    return F.nullif(F.regexp_extract(c, r"\b([1-9]|[1-4][0-9]|50)\b", 1), F.lit("")).try_cast("int")


def http_status(c: Column) -> Column:
    return F.nullif(F.regexp_extract(F.lower(c), r"http (\d{3})", 1), F.lit("")).try_cast("int")


def first_filled(*cs: Column) -> Column:
    """First of several columns that is not blank."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in cs])


def informative(c: Column, generic: Sequence[str], least: int = 6, simple: Column | None = None, simple_least: int = 5) -> Column:
    """Whether a term can be searched for: it has a word with letters, is not one generic word (numbers aside), and is long enough
    without spaces, as it stands or in its simplified form."""
    size = lambda x: F.length(F.replace(x, F.lit(" "), F.lit("")))
    n = norm_text(c)
    words = F.filter(F.split(n, " "), lambda w: w.rlike("[a-z]"))
    lone = (F.size(words) == 1) & F.coalesce(F.get(words, F.lit(0)).isin(*generic), F.lit(False))
    long_enough = size(n) >= least
    return (F.size(words) > 0) & ~lone & (long_enough if simple is None else long_enough | (size(simple) >= simple_least))


def ints_of(c: Column, default: Sequence[int]) -> Column:
    """All whole numbers of a text in order; the default where there is none."""
    found = F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"\d+"), F.lit(0)), lambda x: x.try_cast("int"))
    return F.when(F.size(found) > 0, found).otherwise(F.array(*[F.lit(x) for x in default]))


def unique_join(items: Column, sep: str = "; ", most: int | None = None) -> Column:
    """Items in order, those of one normal form once, blanks left out, joined."""
    keys = F.transform(items, norm_text)
    kept = F.filter(items, lambda x, i: (norm_text(x) != "") & (F.array_position(keys, norm_text(x)) == i + 1))
    return F.array_join(F.slice(kept, 1, most) if most else kept, sep)


def simplified(c: Column, phrases: Sequence[tuple[str, str]], stop: Sequence[str]) -> Column:
    """Normal form with phrases rewritten, then without the given words."""
    return F.array_join(F.filter(F.split(rewritten(c, phrases), " "), lambda t: ~t.isin(*stop)), " ")


#: Misread words of scanned reports and how they read. Fixed values.
REPAIRS = (
    ("develo ment", "development"),
    ("develo pment", "development"),
    ("im rovement", "improvement"),
    ("pro· eel", "project"),
    ("pro'ect", "project"),
    ("on oin", "ongoing"),
    ("com lete", "complete"),
    ("sstimated", "estimated"),
)


def repaired(c: Column, repairs: Sequence[tuple[str, str]] = REPAIRS) -> Column:
    """Text with misread phrases replaced in any letter case, list signs and rules as spaces, CR as line ends; null reads as empty."""
    out = F.coalesce(c, F.lit(""))
    for bad, good in repairs:
        literal = "".join(x if x.isalnum() or x == " " else f"\\{x}" for x in bad)
        out = F.regexp_replace(out, f"(?i){literal}", good)
    return F.translate(F.regexp_replace(F.translate(out, "•|[]", "    "), "[_`~]+", " "), "\r", "\n")


def clean_name(c: Column, around: str = " -:;,.") -> Column:
    """A name in one line, list signs dropped, without the signs around it."""
    return F.btrim(F.regexp_replace(F.translate(F.coalesce(c, F.lit("")), "\f•*", "   "), r"\s+", " "), F.lit(around))


def without_status(c: Column, status: str) -> Column:
    """A name cut off where a status begins, cleaned."""
    return clean_name(F.regexp_replace(clean_name(c), f"(?i)\\b(?:{status})\\b.*$", ""))


def norm_scanned(c: Column, repairs: Sequence[tuple[str, str]] = (("proiect", "project"), ("companj", "company"))) -> Column:
    """Normal form of scanned text, misread words replaced first."""
    low = F.lower(F.coalesce(c, F.lit("")))
    for bad, good in repairs:
        low = F.replace(low, F.lit(bad), F.lit(good))
    return norm_text(low)


def ward_of_email(c: Column) -> Column:
    return F.nullif(F.regexp_extract(F.lower(c), r"ward\s*0*([0-9]{1,2})", 1), F.lit("")).try_cast("int")


def report_year(c: Column) -> Column:
    """The first year of 20xx in a text."""
    return F.nullif(F.regexp_extract(c, r"(20\d{2})", 1), F.lit("")).try_cast("int")


def first_capture(c: Column, patterns: Sequence[str]) -> Column:
    """First group of the first pattern that captures anything; null if none does."""
    return F.coalesce(*[F.nullif(F.regexp_extract(c, p, 1), F.lit("")) for p in patterns])


def spaced_stem(path: Column) -> Column:
    """File name without folder, identifier, suffix and ending, words in camel case set apart."""
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[A-Za-z]+$", "")
    stem = F.regexp_replace(F.regexp_replace(stem, r"^T[_-]\d{3}_", ""), r"AR\d{2,4}$", "")
    return F.trim(F.regexp_replace(stem, "([a-z])([A-Z])", "$1 $2"))


def canonical_id(override: Column, master: Column, place: Column, name: Column) -> Column:
    """Identifier of an entity: as stated, else that of its master row, else made of place and name."""
    return F.coalesce(F.nullif(F.trim(override), F.lit("")), F.concat(F.lit("master_"), master), F.concat(F.lit("proj_"), place, F.lit("_"), slug(name)))

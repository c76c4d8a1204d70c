"""How names of districts are typed: words of a name, and whether two words are one (used by problem 4).

Everything here is a pure function of one string, so that it runs in Arrow batches over distinct names.
"""

from __future__ import annotations

import re
from functools import lru_cache

#: Abbreviations of the words that say what kind of place a name denotes. Fixed values.
KIND_WORDS = {
    "industrial": ("industrial", "indust", "ind", "indl"),
    "corridor": ("corridor", "corr", "cor"),
    "avenue": ("avenue", "ave", "av"),
    "street": ("street", "st", "str"),
    "boulevard": ("boulevard", "blvd", "bvd"),
    "parkway": ("parkway", "pkwy"),
    "road": ("road", "rd"),
    "place": ("place", "pl"),
    "square": ("square", "sq"),
    "commons": ("commons", "cmns", "common"),
    "crossing": ("crossing", "xing", "crsg"),
    "yards": ("yards", "yds", "yard"),
    "village": ("village", "vill", "vlg"),
    "terrace": ("terrace", "ter"),
    "landing": ("landing", "lndg", "ldg"),
    "depot": ("depot", "dpt"),
    "basin": ("basin", "bsn"),
    "triangle": ("triangle", "tri"),
    "plaza": ("plaza", "plz"),
    "gardens": ("gardens", "gdns"),
    "north": ("north", "n", "no"),
    "south": ("south", "s", "so"),
    "east": ("east", "e"),
    "west": ("west", "w"),
}
#: Words that two-part names may carry without being part of them.
STREET_WORDS = {"avenue", "street", "boulevard", "road", "place", "parkway"}
#: Phrases around a name that do not belong to it.
FRAME = re.compile(
    r"\b(?:tax increment (?:financing|redevelopment)|redevelopment project area|project area|redevelopment plan|t\.? ?i\.? ?f\.?(?= |$|\))|rpa|city of \w+|district|proposed|the|said|area|redevelopment)\b"
)
_NUMBER = re.compile(r"\bt(?:if)?\s*(?:[-_ ]|no\.?|number|#)*\s*(?:t[-_ ]*)?(\d{1,3})\b")
_ONES = "zeroth first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth thirteenth fourteenth fifteenth sixteenth seventeenth eighteenth nineteenth".split()
_TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
_DIGIT_AS_LETTER = str.maketrans("015836", "olsbeb")


def _ordinals() -> dict[str, str]:
    """Ordinal words from first to ninety-ninth."""
    out = {word: str(i) for i, word in enumerate(_ONES)}
    for i, ten in enumerate(_TENS, start=2):
        out[ten[:-1] + "ieth"] = str(10 * i)
        for j in range(1, 10):
            out[f"{ten}{_ONES[j]}"] = out[f"{ten}-{_ONES[j]}"] = out[f"{ten} {_ONES[j]}"] = str(10 * i + j)
    return out


_KIND = {short: long for long, shorts in KIND_WORDS.items() for short in shorts}
_ORDINAL = _ordinals()
_LONG_ORDINALS = sorted({k.replace("-", "").replace(" ", "") for k in _ORDINAL if len(k) > 7})
_GLUED = re.compile(
    r"^(\w{5,}?)(?:(industrialcorridor|industrialcorr|indcorr|indcorridor|industcorridor|industcorr|ic)|(industrial|indust|ind|corridor|corr|avenue|ave|street|st|boulevard|blvd|square|sq|commons|cmns|crossing|crsg|xing|yards|yds|village|vill|vlg|terrace|landing|depot|basin|triangle|plaza|gardens|north|south|east|west))$"
)


@lru_cache(maxsize=200_000)
def near(a: str, b: str) -> int:
    """Edits between two words, a swap of neighbours being one (optimal string alignment); 3 stands for more than 2."""
    if a == b:
        return 0
    if len(a) < len(b):
        a, b = b, a
    n, m = len(a), len(b)
    if n - m > 2:
        return 3
    i = 0
    while i < m and a[i] == b[i]:
        i += 1
    while m > i and a[n - 1] == b[m - 1]:
        n, m = n - 1, m - 1
    a, b, n, m = a[i:n], b[i:m], n - i, m - i
    if not m:
        return n
    # the first letters differ and the last ones, so that of two edits one is at the front and one at the end
    front = n > 1 and m > 1 and a[0] == b[1] and a[1] == b[0]
    end = n > 1 and m > 1 and a[-1] == b[-2] and a[-2] == b[-1]
    if n == m:
        if n == 1 or (n == 2 and front):
            return 1
        two = a[1:-1] == b[1:-1] or a[1:] == b[:-1] or a[:-1] == b[1:] or (front and a[2:-1] == b[2:-1]) or (end and a[1:-2] == b[1:-2]) or (front and end and n > 3 and a[2:-2] == b[2:-2])
    elif n == m + 1:
        two = a[1:-1] == b[1:] or a[1:-1] == b[:-1] or (front and a[2:-1] == b[2:]) or (end and a[1:-2] == b[:-2])
    else:
        two = a[1:-1] == b
    return 2 if two else 3


@lru_cache(maxsize=100_000)
def _kind_of(word: str) -> str | None:
    """The kind word that a word stands for, spelt out, abbreviated or with one typo."""
    if word in _KIND:
        return _KIND[word]
    if len(word) >= 4:
        for long in KIND_WORDS:
            if len(long) >= 5 and near(word, long) == 1:
                return long
    return None


@lru_cache(maxsize=100_000)
def _ordinal_of(word: str) -> str | None:
    """The number that an ordinal word stands for, with at most one typo in a long one."""
    if word in _ORDINAL:
        return _ORDINAL[word]
    if len(word) > 8:
        for o in _LONG_ORDINALS:
            if near(word, o) == 1:
                return _ORDINAL[o]
    return None


@lru_cache(maxsize=100_000)
def _ten_of(word: str) -> int | None:
    return next((i for i, t in enumerate(_TENS, start=2) if near(word, t) <= (len(word) > 5)), None)


@lru_cache(maxsize=100_000)
def _is_frame(word: str) -> bool:
    return word in _FRAME_WORDS or (len(word) >= 7 and any(near(word, f) == 1 for f in _FRAME_WORDS if len(f) >= 7))


def words_of(name: str | None) -> tuple[str | None, list[str], list[str]]:
    """District number written in the name, stems (place words and street numbers), and kind words.

    Order is not kept: parts of a name are typed in either order.
    """
    if name is None:
        return None, [], []
    text = re.sub(r"([a-z])(?=[A-Z][a-z])|([a-z])(?=[A-Z]{2,}\b)", r"\1\2 ", name)
    text = re.sub(r"\s+", " ", text.lower()).strip()
    number = None
    if m := _NUMBER.search(text):
        number = m.group(1).zfill(3)
        text = text[: m.start()] + " " + text[m.end() :]
    text = re.sub(r"\bt\. ?i\. ?f\.?", " ", text)
    text = FRAME.sub(" ", text)
    stems, kinds, ten = [], [], None
    for raw in re.findall(r"[a-z0-9]+", text):
        if ten is not None:  # "thirty" was read: with "eighth" it is one number
            unit = next((i for i in range(1, 10) if near(raw.translate(_DIGIT_AS_LETTER), _ONES[i]) <= 1), None)
            if unit is not None:
                stems.append(str(10 * ten + unit))
                ten = None
                continue
            stems.append(_TENS[ten - 2])
            ten = None
        if m := re.fullmatch(r"(\d{1,3})(?:st|nd|rd|th)?", raw):
            stems.append(m.group(1))
            continue
        word = raw.translate(_DIGIT_AS_LETTER)
        ten = _ten_of(word)
        if ten is not None or word == "and" or _is_frame(word):
            continue
        if ordinal := _ordinal_of(word):
            stems.append(ordinal)
        elif word == "ic":
            kinds += ["industrial", "corridor"]
        elif kind := _kind_of(word):
            kinds.append(kind)
        elif m := _GLUED.match(word):
            kinds += ["industrial", "corridor"] if m.group(2) else [_KIND[m.group(3)]]
            stems.append(m.group(1))
        elif len(word) > 1:
            stems.append(word)
    if len(stems) > 1:
        kinds = [k for k in kinds if k not in STREET_WORDS]
    return number, sorted(set(stems)), sorted(set(kinds))


_FRAME_WORDS = {"tif", "rpa", "tax", "increment", "financing", "redevelopment", "district", "project", "area", "city", "proposed", "the", "said"}

"""Misread characters of scanned words (used by problem 2).

Pure functions of one string, so that they run in Arrow batches.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import combinations_with_replacement

#: What is read (left) in place of what is printed (right). Fixed values.
MISREAD = (
    ("0", "o"), ("1", "l"), ("1", "i"), ("5", "s"), ("6", "b"), ("8", "b"), ("9", "g"), ("2", "z"), ("@", "a"), ("(", "c"), ("rn", "m"), ("ri", "n"), ("li", "h"), ("1i", "h"), ("l1", "h"),
    ("cl", "d"), ("c1", "d"), ("ii", "u"), ("vv", "w"), ("f", "t"), ("c", "e"), ("y", "v"), ("j", "y"), ("d", "ct"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff"), ("'", "p"), ("·", "p"), ("l", "i"), ("nn", "m"), ("in", "m"), ("h", "li"), ("d", "cl"), ("m", "rn"), ("n", "ri"),
)
#: Digits as they are misread in numbers. Fixed values.
_DIGIT = str.maketrans("olizsgbq", "01125968")
#: Most misreadings looked for in one word.
MOST = 3


def parts(word: str) -> list[str]:
    """Parts of a compound, between hyphens and slashes."""
    return [p for p in re.split(r"[-/]", word) if p]


_RING = (1 << 61) - 1


def anagram(word: str) -> int:
    """A number that all orders of the same letters share; what a misreading adds to it depends on the letters changed only."""
    return sum(ord(c) ** 5 for c in word) % _RING


_DIFFERENCE = [(read, printed, anagram(printed) - anagram(read)) for read, printed in MISREAD]


def odd(word: str) -> bool:
    """Whether letters and signs that are no letters stand in one word in a way that no right word has."""
    if len(word) < 3 or not re.search(r"[a-z]", word) or re.fullmatch(r"\d+(?:st|nd|rd|th|[a-z])|[a-z]\d+|\$?[\d,.]+", word):
        return False
    return bool(re.search(r"[0-9@(ﬁﬂﬀ·]|[a-z]'[a-z]{2,}", word)) and len(re.findall(r"[a-z]", word)) * 2 >= len(word)


def suspect(word: str) -> bool:
    """Whether a part of some word could be misread: it holds what a misreading leaves."""
    return len(word) >= 3 and (odd(word) or (word.isalpha() and any(read in word for read, _ in MISREAD)))


#: Signs and digits with one reading.
_ONE_READING = "05689@(ﬁﬂﬀ"


def targets(word: str) -> list[int]:
    """Anagram numbers of the words that up to MOST misreadings may have made into this one; the word holds what each of them leaves.

    Signs and digits with one reading are read so at once and do not count towards MOST.
    """
    base, fixed = anagram(word), 0
    for read, _, difference in _DIFFERENCE:
        if read in _ONE_READING:
            base += difference * word.count(read)
            fixed += word.count(read)
    maybe = [(difference, word.count(read)) for read, _, difference in _DIFFERENCE if read in word and read not in _ONE_READING]
    out = {base} if fixed else set()
    for n in range(1, MOST + 1):
        for combo in combinations_with_replacement(range(len(maybe)), n):
            if all(combo.count(k) <= maybe[k][1] for k in set(combo)):
                out.add(base + sum(maybe[k][0] for k in combo))
    return sorted({x % _RING for x in out})


@lru_cache(maxsize=500_000)
def misreadings(read: str, printed: str) -> int | None:
    """Fewest misreadings that make ``printed`` into ``read``; null if none do."""
    best = [[None] * (len(printed) + 1) for _ in range(len(read) + 1)]
    best[0][0] = 0
    for i in range(len(read) + 1):
        for j in range(len(printed) + 1):
            if best[i][j] is None:
                continue
            if i < len(read) and j < len(printed) and read[i] == printed[j]:
                if best[i + 1][j + 1] is None or best[i + 1][j + 1] > best[i][j]:
                    best[i + 1][j + 1] = best[i][j]
            for r, p in MISREAD:
                if read.startswith(r, i) and printed.startswith(p, j):
                    a, b = i + len(r), j + len(p)
                    if best[a][b] is None or best[a][b] > best[i][j] + 1:
                        best[a][b] = best[i][j] + 1
    return best[-1][-1]


def number_of(word: str) -> str | None:
    """A number with misread digits as it should read; null if it is no such number."""
    if re.fullmatch(r"[12zoilsgbq\d]{4}", word) and sum(c.isdigit() for c in word) >= 2 and not word.isdigit():
        year = word.translate(_DIGIT)
        if word[0] == "z":
            year = "2" + year[1:]
        return year if re.fullmatch(r"(?:19|20)\d\d", year) else None
    if re.fullmatch(r"\$?[\doilzsgbq]{1,3}(?:,[\doilzsgbq]{3})+(?:\.\d\d)?", word) and re.search(r"[a-z]", word):
        return word.translate(_DIGIT).lstrip("$")
    return None


def plain(word: str) -> str:
    """An odd word that no known word explains, read sign by sign."""
    out = word.translate(str.maketrans("056989@(", "osbgbga" + "c"))
    for read, printed in (("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff")):
        out = out.replace(read, printed)
    return re.sub(r"1", lambda m: "i" if 0 < m.start() < len(out) - 1 and out[m.start() - 1] not in "aeiou" and out[m.start() + 1] not in "aeiou" else "l", out)

"""How names of projects are typed: their parts, their canonical rewritings, and whether two are one (problems 1 and 3).

Pure functions of strings, so that they run in Arrow batches over distinct names.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import product
from typing import NamedTuple

from ledgerweave.llm.district_names import near

#: Words that say what a project is, each with its abbreviations. Fixed values.
TYPE_WORDS = {
    "apartments": ("apts", "apt", "apartment"),
    "arts": (),
    "branch": ("br",),
    "brownfield": ("brownfld",),
    "building": ("bldg",),
    "business": (),
    "campus": (),
    "cannery": (),
    "center": ("ctr", "centre"),
    "cleanup": (),
    "commercial": ("comml",),
    "community": ("comm",),
    "conversion": ("conv",),
    "corridor": ("corr",),
    "cultural": ("cult",),
    "development": ("dev", "devt"),
    "elementary": ("elem",),
    "exchange": (),
    "expansion": ("expan", "exp"),
    "fieldhouse": ("fldhse",),
    "former": (),
    "foundry": (),
    "gateway": (),
    "hospital": ("hosp",),
    "hotel": (),
    "housing": ("hsg",),
    "improvements": ("impr", "improvement", "imprvmts"),
    "industrial": ("ind", "indust"),
    "library": ("lib",),
    "lofts": ("lfts", "loft"),
    "manufacturing": ("mfg",),
    "medical": ("med",),
    "mixed": (),
    "park": ("pk",),
    "parking": ("pkg",),
    "public": ("pub",),
    "rail": (),
    "rehabilitation": ("rehab",),
    "renovation": ("reno", "renov"),
    "residences": ("res", "residence"),
    "restoration": ("restor",),
    "school": ("sch",),
    "senior": ("sr",),
    "shopping": ("shpg",),
    "site": (),
    "station": ("stn", "sta"),
    "streetscape": ("strscp",),
    "structure": ("struct",),
    "supportive": ("supp",),
    "technology": ("tech",),
    "theater": ("theatre",),
    "townhomes": ("twnhms", "townhome"),
    "transit": (),
    "use": (),
    "works": (),
    "yard": (),
}
#: Nicknames and the given names they stand for. Fixed values.
NICKNAMES = {
    "abe": ("abraham",), "al": ("albert", "alfred"), "alex": ("alexander",), "andy": ("andrew",), "barb": ("barbara",), "becky": ("rebecca",),
    "ben": ("benjamin",), "beth": ("elizabeth",), "betty": ("elizabeth",), "bill": ("william",), "billy": ("william",), "bob": ("robert",), "bobby": ("robert",),
    "cathy": ("catherine",), "charlie": ("charles",), "chris": ("christopher",), "chuck": ("charles",), "dan": ("daniel",), "dave": ("david",),
    "deb": ("deborah",), "debbie": ("deborah",), "dick": ("richard",), "don": ("donald",), "ed": ("edward",), "eddie": ("edward",), "frank": ("francis", "francisco"),
    "fred": ("frederick",), "greg": ("gregory",), "gwen": ("gwendolyn",), "hank": ("henry",), "jack": ("john",), "jake": ("jacob",), "jim": ("james",), "joe": ("joseph",),
    "josie": ("josephine",), "jo": ("josephine",), "kate": ("katherine",), "kathy": ("katherine",), "ken": ("kenneth",), "larry": ("lawrence",), "liz": ("elizabeth",),
    "lou": ("louis",), "maggie": ("margaret",), "meg": ("margaret",), "mike": ("michael",), "nate": ("nathaniel",), "ned": ("edward",), "nick": ("nicholas",),
    "paco": ("francisco",), "pancho": ("francisco",), "pat": ("patricia", "patrick"), "patty": ("patricia",), "peggy": ("margaret",), "pete": ("peter",), "ray": ("raymond",), "rich": ("richard",),
    "rick": ("richard",), "rob": ("robert",), "ron": ("ronald",), "sam": ("samuel",), "steve": ("stephen", "steven"), "sue": ("susan",), "susie": ("susan",),
    "ted": ("theodore", "edward"), "theo": ("theodore",), "tim": ("timothy",), "tom": ("thomas",), "tony": ("anthony",), "trish": ("patricia",), "vince": ("vincent",), "will": ("william",),
}
#: Legal forms, programme names and fillers that are not part of a name. Fixed values.
FILLERS = {"the", "and", "of", "at", "llc", "inc", "lp", "ltd", "corp", "co", "project", "proj", "rda", "iga", "tif", "redevelopment", "agreement", "intergovernmental"}
STREETS = {"street": "st", "avenue": "ave", "boulevard": "blvd", "parkway": "pkwy", "st": "st", "ave": "ave", "av": "ave", "blvd": "blvd", "pkwy": "pkwy", "road": "rd", "rd": "rd"}
SIDES = {"north": "n", "south": "s", "east": "e", "west": "w", "n": "n", "s": "s", "e": "e", "w": "w"}
PHASES = {"i": "1", "ii": "2", "iii": "3", "iv": "4", "v": "5", "vi": "6", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6"}
#: Typed where there is no project. Fixed values.
NO_PROJECT = {"", "none", "na", "noprojectswereundertaken", "noprojects", "noproject", "tbd", "unknown", "null", "nil", "notapplicable", "nonereported"}

_FUND = ("small", "business", "improvement", "fund")
_PHASE = re.compile(r"\b(?:phase|phas|phsae|pahse|phaes|ph)\b\.?\s*([ivx]+|\d+|one|two|three|four|five|six)\b")
_ALIASES = [(alias, word) for word, aliases in TYPE_WORDS.items() for alias in (word, *aliases)]
_EXACT = dict(_ALIASES)
TYPE_ALIASES = frozenset(_EXACT)


def _letters(word: str) -> int:
    out = 0
    for c in word:
        out |= 1 << (ord(c) & 31)
    return out


class Near:
    """Listed words that can be within two edits of a word: an edit changes at most two of the letters that occur, and one of the length."""

    def __init__(self, words: list[str]) -> None:
        self.words = [(w, len(w), _letters(w)) for w in words]

    def __call__(self, word: str) -> list[str]:
        n, letters = len(word), _letters(word)
        return [w for w, m, x in self.words if -2 <= n - m <= 2 and (letters ^ x).bit_count() <= 4]


class Parts(NamedTuple):
    """``block``: what must be equal (type words, phase, side, numbers). ``words``: the name proper, in the order typed."""

    block: str
    words: tuple[str, ...]
    initials: tuple[str, ...]


_LONG_ALIASES, _LONG_FILLERS, _LONG_NICKNAMES = Near([a for a, _ in _ALIASES if len(a) >= 5]), Near([f for f in FILLERS if len(f) >= 7]), Near([n for n in NICKNAMES if len(n) >= 5])


@lru_cache(maxsize=200_000)
def _is_fund(word: str) -> bool:
    return any(near(word, f) <= 1 + (len(f) > 6) for f in _FUND)


@lru_cache(maxsize=200_000)
def _type_word(word: str) -> str | None:
    if word in _EXACT:
        return _EXACT[word]
    if len(word) >= 4:
        best = min(((near(word, alias), _EXACT[alias]) for alias in _LONG_ALIASES(word)), default=(9, ""))
        if best[0] == 1 or (best[0] == 2 and len(word) >= 6 and word[0] == best[1][0]):
            return best[1]
    return None


@lru_cache(maxsize=200_000)
def _is_filler(word: str) -> bool:
    return word in FILLERS or (word not in _EXACT and len(word) >= 6 and any(near(word, f) <= 1 + (len(f) >= 15) for f in _LONG_FILLERS(word)))


@lru_cache(maxsize=200_000)
def _street_word(word: str) -> str:
    """A long street word with up to two typos, spelt right; else the word."""
    if len(word) < 5 or word in STREETS or word in SIDES or _EXACT.get(word):
        return word
    best = min((near(word, s), s) for s in STREETS if len(s) >= 5)
    return best[1] if best[0] <= (2 if len(word) >= 7 else 1) and word[:2] in (best[1][:2], best[1][0] + best[1][2]) else word


def is_no_project(name: str | None) -> bool:
    return name is None or re.sub(r"[^a-z0-9]", "", name.lower()) in NO_PROJECT


@lru_cache(maxsize=200_000)
def parts_of(name: str) -> Parts:
    text = re.sub(r"([a-z])(?=[A-Z][a-z])", r"\1 ", name).lower()
    text = re.sub(r"\bl\.? ?l\.? ?c\b\.?|\bl\.? ?p\b\.?(?!\w)", " ", text)
    kinds, phase = set(), ""
    if m := _PHASE.search(text):
        phase = PHASES.get(m.group(1), m.group(1))
        text = text[: m.start()] + " " + text[m.end() :]
    tokens = re.findall(r"[a-z0-9]+(?:'[a-z]+)?", text)
    fund = [t for t in tokens if _is_fund(t)]
    if "sbif" in tokens or len(fund) >= 3:
        kinds.add("sbif")
        tokens = [t for t in tokens if t != "sbif" and t not in fund]
    words, initials, numbers, sides = [], [], [], []
    numbered = any(re.fullmatch(r"\d{1,5}", t) for t in tokens)
    if numbered:
        tokens = [_street_word(t) for t in tokens]
    address = numbered and any(t in STREETS for t in tokens)
    for i, token in enumerate(tokens):
        if re.fullmatch(r"\d+[a-z]?", token):
            numbers.append(token)
        elif token in SIDES and (len(token) > 1 or address):
            sides.append(SIDES[token])
        elif address and token in STREETS:
            kinds.add(STREETS[token])
        elif _is_filler(token):
            continue
        elif token in ("lot", "parcel", "parcle"):
            kinds.add(token[:4])
        elif kind := _type_word(token):
            kinds.add(kind)
        elif len(token) == 1:
            initials.append(token)
        else:
            token = token.replace("kw", "qu").replace("fyld", "field")  # spelt as heard
            words.append(token[:-3] if len(token) >= 9 and token.endswith("and") else token)  # "and" run on to the word
    block = "|".join((" ".join(sorted(kinds)), phase, "".join(sorted(sides)), " ".join(sorted(numbers))))
    return Parts(block, tuple(words), tuple(initials))


GIVEN = {x for xs in NICKNAMES.values() for x in xs} | set(NICKNAMES)
_LONG_GIVEN = Near([g for g in GIVEN if len(g) >= 6])


@lru_cache(maxsize=200_000)
def rewritings(word: str) -> tuple[str, ...]:
    """The given names that a nickname stands for (one typo allowed in a longer one), else the word."""
    if word in NICKNAMES:
        return NICKNAMES[word]
    if len(word) >= 4 and word not in GIVEN:
        near_ones = {full for nick in _LONG_NICKNAMES(word) if near(word, nick) == 1 for full in NICKNAMES[nick]}
        if near_ones:
            return (word, *sorted(near_ones))
    return (word,)


@lru_cache(maxsize=200_000)
def is_given(word: str) -> bool:
    return any(r in GIVEN or any(near(r, g) == 1 for g in _LONG_GIVEN(r)) for r in rewritings(word))


def _like(a: str, b: str, most: int) -> int:
    """Edits between two words of names, nicknames resolved; 3 if they are not one word."""
    if a == b:
        return 0
    best = min(near(x, y) for x in rewritings(a) for y in rewritings(b))
    short = min(len(a), len(b))
    return best if best == 0 or (short >= 4 and best <= (most if short >= 6 else 1)) else 3


def alike(left: list[str], left_initials: list[str], right: list[str], right_initials: list[str], numbered: bool) -> int | None:
    """Edits between two names of one block whose words all pair up; null if they do not.

    Order does not count. Words run together count as the words; an initial pairs with a word that
    begins with it. One typo is allowed in the only word of a name; two in a long word beside others or a number.
    """
    if len(left) + len(left_initials) != len(right) + len(right_initials):
        best = min((near(x, y) for x in _joined(left) for y in _joined(right)), default=3)
        return best if best <= 1 and left and right else None
    most = 2 if numbered or len(left) > 1 or min(map(len, [*left, *right]), default=0) >= 9 else 1
    total, rest, unpaired = 0, list(right), []
    for word in left:
        best = min(((_like(word, x, most), x) for x in rest), default=(3, ""))
        if best[0] < 3:
            total += best[0]
            rest.remove(best[1])
        else:
            unpaired.append(word)
    for words, initials in ((unpaired, list(right_initials)), (rest, list(left_initials))):
        for word in words:
            hit = next((x for x in initials if any(r.startswith(x) for r in rewritings(word))), None)
            if hit is None:
                return None
            initials.remove(hit)
    return total if total <= 3 else None


def dropped(left: list[str], right: list[str]) -> bool:
    """Whether one name is the other without one of its place words. A given name is never the part left out."""
    short, long = sorted((left, right), key=len)
    if len(short) + 1 != len(long) or not short:
        return False
    rest = list(long)
    for word in short:
        hit = next((x for x in rest if _like(word, x, 1) < 3), None)
        if hit is None:
            return False
        rest.remove(hit)
    return not is_given(rest[0]) and not any(is_given(w) for w in short)


#: Words of a name from which on its single words are rewritings too.
LONG = 8


def forms_of(words: list[str], initials: list[str], numbered: bool = False) -> list[str]:
    """Canonical rewritings of a whole name under which it can be met; its legal forms are dropped already.

    Rules, over every choice of the given names that its nicknames stand for: words in one order; one word as its initial; one word
    left out, and then one letter of another; one letter of an only word; the words run together. Names at most one typo apart in one word, or with
    one word that only one of them has, share a rewriting. A name with a house number is also met by that alone. Names of more than
    ``LONG`` words are met by each of their words instead, as their rewritings would grow with the square of their length.
    """
    out = {"#"} if numbered or not words else set()
    if len(words) >= LONG:
        out |= {f"{x}~" for word in words for r in rewritings(word) for x in (r, *_without_letter(r))}
    for chosen in () if len(words) > LONG else product(*[rewritings(w) for w in words]):
        whole = sorted((*chosen, *initials))
        out |= {" ".join(whole), *_joined(list(chosen))}
        for i, word in enumerate(chosen):
            rest = [*chosen[:i], *chosen[i + 1 :], *initials]
            out.add(" ".join(sorted((*rest, word[0]))))
            if not rest:
                out |= set(_without_letter(word))
            else:
                out |= {" ".join(sorted(x)) for x in (rest, *[(*rest[:j], y, *rest[j + 1 :]) for j, w in enumerate(rest) for y in _without_letter(w)])}
    return sorted(out)


def _without_letter(word: str) -> list[str]:
    return [word[:i] + word[i + 1 :] for i in range(len(word))] if len(word) >= 4 else []


def _joined(words: list[str]) -> set[str]:
    return {"".join(words), "".join(reversed(words))} if words else set()


def _shorter(word: str, most: int) -> set[str]:
    """The word with up to ``most`` letters left out; words that many edits apart share one."""
    out = last = {word}
    for _ in range(most):
        last = {w[:i] + w[i + 1 :] for w in last for i in range(len(w))}
        out = out | last
    return out


def met_by(words: list[str], initials: list[str]) -> tuple[list[list[str]], list[str], list[str]]:
    """Keys of each word of a name, of its words run together, and of the whole name.

    Of two names that are ``alike``, or one of which is the other with a word ``dropped``, the keys of any word of either (of the shorter one) meet those of
    the whole other name, or the keys of the words run together meet. A name without words has its number of initials for a word.
    """
    each = []
    for word in words:
        spelt = rewritings(word)
        most = 0 if len(word) < 4 else 1 if len(word) < 6 else 2
        each.append(({f"w:{x}" for r in spelt for x in _shorter(r, most)}, {f"i:{r[0]}" for r in spelt}))
    together = {f"j:{x}" for j in _joined(words) for x in _shorter(j, 1)}
    whole = {f"i:{x}" for x in initials} | {f"n:{len(words) + len(initials)}"} | set().union(*[keys for keys, _ in each])
    return [sorted(keys | first) for keys, first in each] or [[f"n:{len(initials)}"]], sorted(together), sorted(whole)

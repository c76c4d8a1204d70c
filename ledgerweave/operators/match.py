"""Entity matching in tiers, and likeness within blocks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from difflib import SequenceMatcher
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerweave.functions.similarity import likeness, ratio
from ledgerweave.functions.text import canonical_id, without_words
from ledgerweave.operators.joins import salted_join
from ledgerweave.operators.rank import first_per_key
from ledgerweave.session import cut, spread


def tiered_match(left: DataFrame, tiers: Sequence[tuple[str, DataFrame, Sequence[str]]], order: Sequence[Column], value: str, status: str = "match_status") -> DataFrame:
    """Left rows with ``value`` of the first tier that has their key.

    A tier is ``(name, right, keys)``; right rows have the keys, ``value`` and the columns of ``order``. Keys that are blank match nothing. Each tier
    is one equi-join with the first right row of a key; the results are coalesced in the order of the tiers.
    """
    out = left
    names = []
    for name, right, keys in tiers:
        filled = right
        for k in keys:
            filled = filled.filter(F.trim(k) != "")
        once = first_per_key(filled, keys, order).select(*keys, F.col(value).alias(f"_{name}"))
        out = out.join(once, list(keys), "left")
        names.append(name)
    hit = F.coalesce(*[F.when(F.col(f"_{n}").isNotNull(), F.lit(n)) for n in names], F.lit("unmatched"))
    return out.withColumn(value, F.coalesce(*[F.col(f"_{n}") for n in names])).withColumn(status, hit).drop(*[f"_{n}" for n in names])


#: Left rows of a block that one task holds against the block, those of them that are bounded at once, right rows at once, and pairs at once.
PART, LEFTS, RIGHTS, PAIRS = 2000, 500, 4000, 500_000
#: What is rounded to the best score, or to the least one accepted, can be so much less.
ROUNDED = 0.00011


class Texts:
    """Texts in order of length with the codes of their letters one after the other, for upper bounds of likeness.

    ``kinds`` are the letters of the right texts by frequency; letters that the right texts lack have the last code.
    """

    def __init__(self, texts: Sequence[str], kinds: np.ndarray | None = None) -> None:
        self.rows = np.array(sorted(range(len(texts)), key=lambda i: len(texts[i])), dtype=np.int64)
        self.texts = [texts[i] for i in self.rows]
        self.lengths = np.array([len(t) for t in self.texts], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        letters = np.frombuffer("".join(self.texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        if kinds is None:
            found, counts = np.unique(letters, return_counts=True)
            kinds = found[np.argsort(-counts, kind="stable")]
        self.kinds = kinds
        order = np.argsort(kinds)
        at = np.minimum(np.searchsorted(kinds[order], letters), max(len(kinds) - 1, 0))
        self.codes = np.where(kinds[order][at] == letters, order[at], len(kinds)) if len(kinds) else np.zeros(len(letters), dtype=np.int64)

    def counts(self, rows: slice, used: int) -> np.ndarray:
        """How often each of the first ``used`` kinds stands in the texts ``rows``."""
        lengths = self.lengths[rows]
        codes = self.codes[self.starts[rows.start] : self.starts[rows.start] + lengths.sum()] if len(lengths) else self.codes[:0]
        owner, known = np.repeat(np.arange(len(lengths)), lengths), codes < used
        return np.bincount(owner[known] * used + codes[known], minlength=len(lengths) * used).reshape(len(lengths), used)

    def in_order(self, other: Texts, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Letters that the texts ``i`` and the others ``j``, pair by pair, have in common in one order at most.

        The longest common subsequence by a bit-parallel scan, a text of more than 64 letters in parts.
        """
        kinds = len(self.kinds)
        order = np.argsort(-other.lengths[j], kind="stable")
        i, j = i[order], j[order]
        own, which = np.unique(i, return_inverse=True)
        total = np.zeros(len(i), dtype=np.int64)
        start, length = other.starts[j], other.lengths[j]
        for at in range(0, int(self.lengths[own].max(initial=0)), 64):
            n = np.clip(self.lengths[own] - at, 0, 64)
            bit = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            masks = np.zeros((len(own), kinds + 1), dtype=np.uint64)
            np.bitwise_or.at(masks, (np.repeat(np.arange(len(own)), n), self.codes[np.repeat(self.starts[own] + at, n) + bit]), np.uint64(1) << bit.astype(np.uint64))
            masks[:, kinds] = 0
            free = np.full(len(i), 2**64 - 1, dtype=np.uint64)
            for column in range(int(length.max(initial=0))):
                n = int(np.searchsorted(-length, -column, side="left"))  # the texts longer than this column
                v = free[:n]
                u = v & masks[which[:n], other.codes[start[:n] + column]]
                free[:n] = (v + u) | (v - u)
            total += 64 - np.bitwise_count(free).astype(np.int64)
        out = np.empty(len(i), dtype=np.int64)
        out[order] = total
        return out


class Letters:
    """For pairs that can have enough letters in common, in any order, by the product of two matrices.

    A column is the n-th letter of a kind, for the most frequent kinds; what a left text has beyond these columns counts as in common. One
    more column has the lengths, so that the product is compared with one number of each left text.
    """

    KINDS, OF_A_KIND = 64, 8

    def __init__(self, left: Texts, right: Texts) -> None:
        self.left, self.right, self.used = left, right, min(len(right.kinds), self.KINDS)
        self.of_left = left.counts(slice(0, len(left.texts)), self.used)
        highest = np.zeros(self.used, dtype=np.int64)
        for at in range(0, len(right.texts), RIGHTS):
            highest = np.maximum(highest, right.counts(slice(at, at + RIGHTS), self.used).max(axis=0, initial=0))
        most = np.minimum(np.minimum(self.of_left.max(axis=0, initial=0), highest), self.OF_A_KIND)
        self.kind = np.repeat(np.arange(self.used), most)
        self.nth = np.arange(len(self.kind)) - np.repeat(np.cumsum(most) - most, most)
        others = (left.codes >= self.used) & (left.codes < len(right.kinds))
        beyond = np.bincount(np.repeat(np.arange(len(left.texts)), left.lengths)[others], minlength=len(left.texts))
        self.beyond = beyond + np.where(highest > self.OF_A_KIND, np.maximum(self.of_left - self.OF_A_KIND, 0), 0).sum(axis=1)

    def pairs(self, rows: slice, low: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of the left texts ``rows`` and right ones that can reach ``low``, one number of each of the ``rows``."""
        lengths, least = self.left.lengths[rows], max(float(low.min()), 1e-6)
        begin, end = np.searchsorted(self.right.lengths, [lengths[0] * least / (2 - least) - 1e-3, lengths[-1] * (2 - least) / least + 1e-3]) if least < 2 else (0, 0)
        a = np.concatenate([self.of_left[rows][:, self.kind] > self.nth, -low[:, None] / 2], axis=1, dtype=np.float32)
        enough = (low * lengths / 2 - self.beyond[rows] - 1e-3).astype(np.float32)
        for at in range(int(begin), int(end), RIGHTS):
            some = slice(at, min(at + RIGHTS, int(end)))
            b = self.columns(some)
            i, j = np.divmod(np.flatnonzero(a @ b.T >= enough[:, None]), len(b))
            for part in range(0, len(i), PAIRS):
                yield i[part : part + PAIRS] + rows.start, j[part : part + PAIRS] + at

    def columns(self, rows: slice) -> np.ndarray:
        return np.concatenate([self.right.counts(rows, self.used)[:, self.kind] > self.nth, self.right.lengths[rows, None]], axis=1, dtype=np.float32)


def _best_of_block(a: dict[str, list], b: dict[str, list], pairs: Sequence[tuple[str, str]], accept: float) -> list[tuple[int, int, float]]:
    """``(left row, right row, score)`` of all pairs whose score can be rounded to the best one of the left row and to ``accept``."""
    low, found = np.full(len(next(iter(a.values()))), accept), []
    for x, y in pairs:
        of: dict[str, list[int]] = {}  # blanks count for nothing
        for row, t in enumerate(b[y]):
            if t:
                of.setdefault(t, []).append(row)
        filled = [row for row, t in enumerate(a[x]) if t]
        right = Texts(list(of))
        left = Texts([a[x][row] for row in filled], right.kinds)
        mine = np.array(filled, dtype=np.int64)[left.rows]
        letters = Letters(left, right)
        for begin in range(0, len(filled), LEFTS):
            rows = slice(begin, min(begin + LEFTS, len(filled)))
            for i, j in letters.pairs(rows, low[mine[rows]] - ROUNDED):
                most = 2.0 * left.in_order(right, i, j) / (left.lengths[i] + right.lengths[j])
                may = np.flatnonzero(most >= low[mine[i]] - ROUNDED)
                for k in may[np.argsort(-most[may], kind="stable")].tolist():
                    row, s = int(mine[i[k]]), right.texts[j[k]]
                    if most[k] >= low[row] - ROUNDED:
                        r = likeness(left.texts[i[k]], s)
                        if r >= low[row] - ROUNDED:
                            found += [(row, other, r) for other in of[s]]
                            low[row] = max(low[row], r)
    return [f for f in found if f[2] >= low[f[0]] - ROUNDED]


def best_fuzzy(left: DataFrame, right: DataFrame, block: Sequence[str], key: str, pairs: Sequence[tuple[str, str]], right_key: str, accept: float, suggest: bool = False) -> DataFrame:
    """``(key, right_key, score, accepted)``: of each left row the likeliest right row of its block.

    The score is the greatest likeness of several pairs of columns, blanks counting for nothing; ties go to the smaller key. Where only accepted pairs
    are wanted, a task holds a part of a block's left rows against all its right rows: pairs that by their letters, and then by
    their letters in order, cannot reach ``accept`` and the best found so far are left out before the likeness runs. With ``suggest`` the best pair
    below ``accept`` is wanted too, so all pairs of an equi-join on the block, a hot block in parts, are scored.
    """
    lefts, rights = sorted({a for a, _ in pairs}), sorted({b for _, b in pairs})
    if suggest:
        met = salted_join(left.select(key, *block, *lefts), right.select(right_key, *block, *rights), block).select(key, right_key, *lefts, *rights)
        each = [F.when((F.col(x) != "") & (F.col(y) != ""), ratio(F.col(x), F.col(y))).otherwise(0.0) for x, y in pairs]
        scored = met.select(key, right_key, (F.greatest(*each) if len(each) > 1 else each[0]).alias("score"))
    else:
        parts = left.groupBy(*block).agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("_parts"))
        a = left.select(key, *block, *lefts).join(parts, list(block)).withColumn("_part", F.pmod(F.xxhash64(key), F.col("_parts")).cast("int")).drop("_parts")
        b = right.select(right_key, *block, *rights).join(parts, list(block)).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
        tasks = 3 * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        grouped = [d.repartition(tasks, *block, "_part").groupBy(*block, "_part") for d in (a, b)]

        def best_of(x: pa.Table, y: pa.Table) -> pa.Table:
            texts = lambda t, names: {c: [v or "" for v in t.column(c).to_pylist()] for c in names}
            found = _best_of_block(texts(x, lefts), texts(y, rights), pairs, accept) if x.num_rows and y.num_rows else []
            i, j, scores = ([f[k] for f in found] for k in range(3))
            return pa.table([x.column(key).take(pa.array(i, pa.int64())), y.column(right_key).take(pa.array(j, pa.int64())), pa.array(scores, pa.float64())], names=[key, right_key, "score"])

        schema = T.StructType([T.StructField(key, left.schema[key].dataType), T.StructField(right_key, right.schema[right_key].dataType), T.StructField("score", T.DoubleType())])
        scored = grouped[0].cogroup(grouped[1]).applyInArrow(best_of, schema)
    scored = scored.select(key, right_key, F.round("score", 4).alias("score"))
    best = scored.groupBy(key).agg(F.min(F.struct((-F.col("score")).alias("s"), F.col(right_key).alias("k"))).alias("b"))
    out = best.select(key, F.col("b.k").alias(right_key), (-F.col("b.s")).alias("score"), (-F.col("b.s") >= accept).alias("accepted"))
    return out if suggest else out.filter("accepted")


def name_ladder(names: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """``(key, entry, rung)``: the first rung on which a name meets a listed one: exact normal form, then loose form.

    ``names`` has ``(key, form, loose)``, ``listed`` ``(entry, form, loose, canonical)``. A canonical entry goes before a variant.
    """
    rungs = []
    for rung, column in (("exact", "form"), ("loose", "loose")):
        right = first_per_key(listed.filter(f"{column} <> ''"), [column], [F.desc("canonical"), F.asc("entry")]).select(column, F.col("entry").alias(f"_{rung}"))
        names = names.join(right, column, "left")
        rungs.append(rung)
    hit = F.coalesce(*[F.when(F.col(f"_{r}").isNotNull(), F.lit(r)) for r in rungs], F.lit("unmatched"))
    return names.select(key, F.coalesce(*[F.col(f"_{r}") for r in rungs]).alias("entry"), hit.alias("rung"))


def name_audit(pairs: DataFrame, a: str, b: str, least: float) -> DataFrame:
    """Name pairs with their likeness and a verdict: fail where a name is blank, warning below ``least``, else pass."""
    blank = (F.coalesce(F.trim(a), F.lit("")) == "") | (F.coalesce(F.trim(b), F.lit("")) == "")
    scored = pairs.withColumn("score", F.round(ratio(F.col(a), F.col(b)), 4))
    return scored.withColumn("verdict", F.when(blank, "fail").when(F.col("score") < least, "warning").otherwise("pass"))


class CommonLetters:
    """A list of names, for upper bounds of the letters that a name and each of them have in common in one order.

    The longest common subsequence, by a bit-parallel scan of all names at once; a name of more than 64 letters is scanned in parts,
    whose sum is no less.
    """

    def __init__(self, names: Sequence[str]) -> None:
        self.order = np.array(sorted(range(len(names)), key=lambda i: -len(names[i])), dtype=int)
        self.codes = {c: i for i, c in enumerate(sorted(set().union(*names)))}
        longest = [names[i] for i in self.order]
        self.columns = []
        for j in range(len(longest[0]) if longest else 0):
            while len(longest[-1]) <= j:
                longest.pop()
            self.columns.append(np.array([self.codes[n[j]] for n in longest], dtype=np.int32))
        self.lengths = np.array([len(n) for n in names], dtype=int)

    def bound(self, name: str) -> np.ndarray:
        """Upper bounds of the likeness of ``name`` and each of the names."""
        common = np.zeros(len(self.order), dtype=int)
        for at in range(0, len(name), 64):
            masks = np.zeros(len(self.codes), dtype=np.uint64)
            for i, c in enumerate(name[at : at + 64]):
                if c in self.codes:
                    masks[self.codes[c]] |= np.uint64(1 << i)
            free = np.full(len(self.order), 2**64 - 1, dtype=np.uint64)
            for column in self.columns:
                v = free[: len(column)]
                u = v & masks[column]
                free[: len(column)] = (v + u) | (v - u)
            common[self.order] += 64 - np.bitwise_count(free).astype(int)
        total = len(name) + self.lengths
        return np.where(total == 0, 1.0, np.minimum(2.0 * common / np.maximum(total, 1), 1.0))


def likeliest(left: DataFrame, right: DataFrame, key: str, name: str, place: str, right_key: str, least: float, strong: float) -> DataFrame:
    """``(key, right_key, score, status)`` of every left row: the likeliest of all right rows by name, helped by the place.

    The score is the name's likeness, or 0.65 of it and 0.35 of the place's, whichever is more; a blank place is like none. The right rows are a list of names that every task has: of each left
    name they are worked through from the highest upper bound of the score down, until the bound is below the best
    score found, so that no pair that could be the best is left out. No right rows: unmatched, without a score.
    """
    listed = right.groupBy(F.coalesce(name, F.lit("")).alias("n"), F.coalesce(place, F.lit("")).alias("p")).agg(F.min(right_key).alias("k")).toPandas()
    names, places = sorted(set(listed["n"])), sorted(set(listed["p"]))
    of_name, of_place = listed["n"].map({n: i for i, n in enumerate(names)}).to_numpy(dtype=int), listed["p"].map({p: i for i, p in enumerate(places)}).to_numpy(dtype=int)
    keys = listed["k"].tolist()
    kinds = {f.name: f.dataType for f in [*left.schema, *right.schema]}
    schema = T.StructType([T.StructField(key, kinds[key]), T.StructField(right_key, kinds[right_key]), T.StructField("score", T.DoubleType())])

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters = CommonLetters(names)

        @lru_cache(maxsize=20_000)
        def against(i: int) -> SequenceMatcher:
            return SequenceMatcher(None, "", names[i])

        @lru_cache(maxsize=20_000)
        def near(p: str) -> np.ndarray:
            return np.array([SequenceMatcher(None, p, q).ratio() if p and q else 0.0 for q in places])

        @lru_cache(maxsize=1)
        def bounds(a: str) -> np.ndarray:
            return letters.bound(a)

        for batch in batches:
            out = []
            for k, a, p in zip(batch[key], batch[name].fillna(""), batch[place].fillna(""), strict=True):
                d = near(p)[of_place]
                n = bounds(a)[of_name]
                most = np.maximum(n, 0.65 * n + 0.35 * d)
                top, found = 0.0, []
                for i in np.argsort(-most, kind="stable"):
                    # what is rounded to the best score can be less than it by a thousandth
                    if most[i] < top - 0.0011:
                        break
                    m = against(of_name[i])
                    m.set_seq1(a)
                    r = m.ratio()
                    score = max(r, 0.65 * r + 0.35 * d[i])
                    top = max(top, score)
                    found.append((k, keys[i], score))
                out += [x for x in found if x[2] >= top - 0.0011] or [(k, None, None)]
            yield pd.DataFrame(out, columns=[key, right_key, "score"])

    scored = spread(left.select(key, name, place)).mapInPandas(best, schema).withColumn("score", F.round("score", 3))
    one = first_per_key(scored, [key], [F.desc("score"), F.asc(right_key)])
    status = F.when(F.coalesce(F.col("score") < least, F.lit(True)), "unmatched").when(F.col("score") < strong, "suggested").otherwise("strong_suggestion")
    return one.select(key, right_key, "score", status.alias("status"))


def entity_match(annual: DataFrame, overrides: DataFrame, listed: DataFrame, accept: float) -> DataFrame:
    """``(t, p, target, match_status, score, project_id)`` of distinct names ``(t, p, s, name)``: place, normal form, simplified form, as typed.

    Tiers, each tried only where the ones before found nothing: statements ``(t, p, target)``; entries ``(t, p, s, q, d, target)`` of the place
    by equal normal form, simplified form, and simplified second name ``d``; then the likeliest entry of the place by the greatest of four
    likenesses (both forms to both names), if it reaches ``accept``. An entry of that kind is to be reviewed.
    """
    tiers = [
        ("manual_override", overrides, ["t", "p"]), ("exact", listed, ["t", "p"]), ("normalized", listed, ["t", "s"]), ("normalized_second", listed.select("t", F.col("d").alias("s"), "target"), ["t", "s"]),
    ]
    tiered = cut(tiered_match(annual, tiers, [F.asc("target")], "target"))
    rest = tiered.filter("match_status = 'unmatched'").select("t", "p", "s", F.concat_ws("|", "t", "p").alias("id"))
    entries = listed.groupBy("t", F.col("p").alias("lp"), F.col("s").alias("ls"), F.col("q").alias("lq"), F.col("d").alias("ld")).agg(F.min("target").alias("fuzzy"))
    likely = best_fuzzy(rest, entries, ["t"], "id", [("s", "ls"), ("p", "lp"), ("s", "ld"), ("p", "lq")], "fuzzy", accept).select("id", "fuzzy", "score")
    joined = tiered.withColumn("id", F.concat_ws("|", "t", "p")).join(likely, "id", "left")
    status = F.when(F.col("fuzzy").isNotNull(), "fuzzy_review").when(F.col("match_status") == "normalized_second", "normalized").otherwise(F.col("match_status"))
    target = F.coalesce("target", "fuzzy")
    return joined.select("t", "p", target.alias("target"), status.alias("match_status"), "score", canonical_id(F.lit(""), target.cast("string"), F.col("t"), F.col("name")).alias("project_id"))


#: Scores of the rungs above likeness: equal keys, equal loose keys, one phrase in the other. Fixed values.
CANONICAL, EQUAL, LOOSE_CANONICAL, LOOSE, CONTAINED = 1.02, 1.0, 0.99, 0.98, 0.93


def full_ladder(names: DataFrame, listed: DataFrame, drop: Sequence[str], loose_drop: Sequence[str]) -> DataFrame:
    """``(name, entry, score, status)``: the listed entry that a name reaches on the highest rung.

    Keys are normal forms without ``drop`` words, loose keys without ``loose_drop`` words; a loose key counts if it has two words or a digit. ``listed``
    has ``(entry, listed, canonical)`` and is a reference list that every task has. Below the rungs counts the greater of likeness and
    common words; entries that cannot beat the best are passed over by an upper bound. Ties go to the smaller entry.
    """
    keys = [without_words(F.col("listed"), drop).alias("key"), without_words(F.col("listed"), loose_drop).alias("loose")]
    rows = listed.select("entry", "canonical", *keys).filter("key <> ''").groupBy("entry", "key", "loose").agg(F.max("canonical").alias("canonical")).orderBy("entry", "key").collect()
    entries = [(r["entry"], r["key"], r["loose"], bool(r["canonical"])) for r in rows]

    def climb(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters, words = CommonLetters([k for _, k, _, _ in entries]), [set(k.split()) for _, k, _, _ in entries]
        equal: dict[str, list[int]] = {}
        loose: dict[str, list[int]] = {}
        for i, (_, k, lo, _) in enumerate(entries):
            equal.setdefault(k, []).append(i)
            if len(lo.split()) > 1 or any(c.isdigit() for c in lo):
                loose.setdefault(lo, []).append(i)

        def best(key: str, loosely: str) -> tuple[float, str] | None:
            if not key or not entries:
                return None
            found = [(CANONICAL if entries[i][3] else EQUAL, i) for i in equal.get(key, [])] + [(LOOSE_CANONICAL if entries[i][3] else LOOSE, i) for i in loose.get(loosely, [])]
            top = max(((s, -i) for s, i in found), default=(-1.0, 0))
            if top[0] < EQUAL:
                own = set(key.split())
                bounds = letters.bound(key)
                for i, (_, k, _, _) in enumerate(entries):
                    common = len(own & words[i])
                    if len(own) > 1 and len(words[i]) > 1 and (f" {key} " in f" {k} " or f" {k} " in f" {key} "):
                        score = CONTAINED
                    elif max(bounds[i], common / len(own | words[i])) < top[0]:
                        continue
                    else:
                        score = max(SequenceMatcher(None, key, k).ratio(), common / len(own | words[i]))
                    top = max(top, (score, -i))
            return top[0], entries[-top[1]][0]

        for batch in batches:
            yield pd.DataFrame([(n, *(b[::-1] if (b := best(k, lo)) else (None, None))) for n, k, lo in zip(batch["name"], batch["key"], batch["loose"], strict=True)], columns=["name", "entry", "score"])

    forms = names.select("name", without_words(F.col("name"), drop).alias("key"), without_words(F.col("name"), loose_drop).alias("loose"))
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("entry", listed.schema["entry"].dataType), T.StructField("score", T.DoubleType())])
    scored = spread(forms).mapInPandas(climb, schema).withColumn("score", F.round("score", 3))
    status = F.when(F.col("score") >= 0.999, "exact").when(F.col("score") >= 0.86, "strong_fuzzy").when(F.col("score") >= 0.72, "fuzzy_review").otherwise("unmatched")
    return scored.select("name", F.when(F.col("score") >= 0.72, F.col("entry")).alias("entry"), "score", status.alias("status"))

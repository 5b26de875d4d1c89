"""Matching entities across sources without keys (problem 1).

Method: each side's rows are reduced to distinct profiles (title words, author
surnames with initials, year).  Candidates come from MinHash blocking across
attributes: a block is named by one MinHash of the authors together with one of
the title words, rare ones weighing more, so a common title or a common name
alone fills no block; where one side has no authors, bands of the title's MinHash
are used.  Each candidate
pair gets similarity features, and a logistic model fitted to weak labels (the
plainly same and the plainly different pairs) turns them into a probability,
calibrated on weak labels held out from the fit.

Blocks are joined by key; a key is one of many of its profile, and where one is hot
the adaptive skew rule splits the join.  Only
pairs that pass a native test of shared words go on to the costlier features.
The weak labels of at most ``most_pairs`` candidates of each kind, chosen by their
hash, reach the driver; everything else is distributed and sees all rows.  Pairs in
which a side names nobody have a model of their own, fitted to planted pairs: about
``PLANTED`` named profiles pass through blocks, test and features as if without names,
and their names tell what is so.

Defined results for odd input: rows with a null, blank or placeholder title match
nothing; with authors missing on a side the title must name the work by itself;
impossible years count as missing; every repeated row of a work matches; empty
tables give an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import difflib
import html
import math
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from scholarlake.llm import mojibake
from scholarlake.llm.common import settle

#: Titles that say there is none (fixed values).
PLACEHOLDERS = ("untitled", "no title", "n a", "na", "none", "null", "unknown", "title", "tbd", "missing title", "no title available", "title not available")
#: What is added to a title without changing the work (fixed values).
_SUFFIX = re.compile(r"\s*[\[(]\s*(?:extended(?: version| abstract)?|preprint|full version|short paper|long version|technical report|supplementary material|v\s?\d+|version \d+|draft|working paper|revised|arxiv(?: preprint)?)\s*[\])]\s*$", re.I)
_TAG = re.compile(r"<[^<>]{1,100}>")
_WORD = re.compile(r"[⺀-힯]|(?:[^\W_⺀-힯]|�)+")
_COMMAND = re.compile(r"\\[A-Za-z]+\s*(?=\{)|\\[A-Za-z]{3,}\s")
_NUMBER = re.compile(r"\d+|i{1,3}|iv|vi{0,3}|ix|x")
_PARTICLES = frozenset("van von de der den di da dos du la le del el al bin ibn ter".split())
SURNAME_HASHES, TITLE_HASHES, RARE_WORDS = 3, 8, 2


#: The marks that Western letters are decomposed into.
_MARKS = dict.fromkeys(c for c in range(0x300, 0x370) if unicodedata.combining(chr(c)))
#: Braces, signs and hyphens that stand inside words; a dash parts them.
_INSIDE = dict.fromkeys(map(ord, "{}™®$\\\u00ad\u200b'’‑-"))


@lru_cache(maxsize=1 << 16)
def fold(text: str) -> str:
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFKD", text.replace("ß", "ss").replace("ø", "o").replace("Ø", "O").replace("ł", "l").replace("Ł", "L").replace("ı", "i").replace("æ", "ae")).casefold()
    text = text.translate(_MARKS)
    return text if text.isascii() else "".join(c for c in text if not unicodedata.combining(c))


def title_words(title: str | None) -> list[str]:
    if not title:
        return []
    if not title.isascii() and (found := mojibake.examine(title)):
        title = found[3]
    if "<" in title:
        title = _TAG.sub("", title)
    if "&" in title:
        title = html.unescape(title)
    title = title.strip().rstrip(".")
    if title.rstrip()[-1:] in (")", "]"):
        title = _SUFFIX.sub("", title)
    if "\\" in title:
        title = _COMMAND.sub("", title)
    return _WORD.findall(fold(title.translate(_INSIDE)))


@lru_cache(maxsize=1 << 16)
def person(name: str) -> tuple[str, str] | None:
    """(surname, initial) of one author's name."""
    if not name.isascii() and (found := mojibake.examine(name)):
        name = found[3]
    name = re.sub(r"[\d*†‡§]+", " ", name).strip()
    last, comma, first = name.partition(",")
    parts = fold(last).replace(".", " ").split()
    if comma:
        words = [p for p in parts if p not in _PARTICLES] or parts
        surname, given = "".join(words), fold(first).replace(".", " ").split()
    else:
        if any(len(p) > 1 for p in parts):
            while len(parts[-1]) == 1:  # "Velekra E"
                parts.insert(0, parts.pop())
        surname, given = (parts[-1] if parts else ""), parts[:-1]
        given = [g for g in given if g not in _PARTICLES]
    surname = re.sub(r"\W", "", surname)
    return (surname, given[0][0] if given else "") if surname else None


def people(authors: list[str | None] | None) -> list[tuple[str, str]]:
    out = []
    for name in authors or ():
        name = name or ""
        for part in re.split(r"\s*;\s*|\s+and\s+", name) if ";" in name or "and" in name else (name,):
            if part and (p := person(part)):
                out.append(p)
    return list(dict.fromkeys(out))


def _hash(text: str, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(text, seed)


_PROFILE = pa.schema([("id", pa.int64()), ("pid", pa.int64()), ("words", pa.list_(pa.string())), ("names", pa.list_(pa.string())), ("year", pa.int32())])
_PROFILE_SQL = "id bigint, pid bigint, words array<string>, names array<string>, year int"
_KEY = pa.schema([("key", pa.int64()), ("pid", pa.int64()), ("planted", pa.bool_())])
#: Named profiles, about, that also stand for profiles without names, to learn from.
PLANTED = 10_000
#: A word's chance to be a title's MinHash falls with this power of its share of titles.
RARITY = 0.75


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for i, title, authors, year in zip(*(c.to_pylist() for c in batch.columns)):
            words = title_words(title)
            if sum(map(len, words)) < 4 or " ".join(words) in PLACEHOLDERS:
                continue
            names = people(authors)
            year = year if year and 1900 <= year <= 2100 else None
            pid = _hash(repr((words, sorted(names), year)), 3) - (1 << 63)
            rows.append((i, pid, words, [f"{s} {g}".strip() for s, g in names], year))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _PROFILE)], schema=_PROFILE)


@lru_cache(maxsize=1 << 17)
def _draws(word: str, share: float, number: int) -> tuple[tuple[float, str], ...]:
    """One exponential draw a hash function, at the weight of the word's rarity, with the word."""
    weight = share**-RARITY
    return tuple((-math.log((_hash(word, s) + 1) / 2.0**64) / weight, word) for s in range(number))


@lru_cache(maxsize=1 << 16)
def _named(name: str, number: int) -> tuple[tuple[int, str], ...]:
    """One hash a hash function, with the name."""
    return tuple((_hash(name, 100 + s), name) for s in range(number))


def _rare(words: list[str], known: dict[str, float]) -> list[str]:
    return sorted({w for w in words if w not in known and len(w) > 3})


def _blocks(batches: Iterator[pa.RecordBatch], common: Broadcast, hashes: tuple[int, int], rare_words: int, planted: int) -> Iterator[pa.RecordBatch]:
    """(key, pid, planted) of the blocks of each profile: one of the MinHashes of the
    authors with one of the title's weighted MinHashes; rare words by
    themselves, as they fill no large block; and a title without rare words that
    goes with one author list at most, so that it can stand for a work alone.
    One in ``planted`` named profiles also stands in the blocks that it would have
    without its names (none if 0)."""
    known = common.value
    rarest = min(known.values(), default=1.0)
    for batch in batches:
        keys, pids, marks = [], [], []
        for pid, words, names, lists in zip(*(c.to_pylist() for c in batch.columns)):
            rare = _rare(words, known)
            drawn = [_draws(w, known.get(w, rarest), hashes[0]) for w in set(words)]
            # half of the hash functions leave rare words out: those may be misspelt
            plain = [_draws(w, known[w], hashes[0]) for w in set(words) if w in known] or drawn
            low = [min([d[s] for d in (drawn if s % 2 else plain)])[1] for s in range(hashes[0])]
            two = {"|".join(sorted((low[i], low[(i + 1) % len(low)]))) for i in range(len(low))}
            mine_names = [_named(n, hashes[1]) for n in names]
            lowest = {min([n[s] for n in mine_names])[1] for s in range(hashes[1])} if names else set()
            telling = {_hash(f"rare|{w}", 11) for w in sorted(rare, key=lambda w: _hash(w, 5))[:rare_words]}
            alone = set() if rare else {_hash(f"alone|{t}", 9) for t in ("".join(words), *two)}
            mine = {_hash(f"{n}|{t}", 7) for n in lowest for t in set(low)} | telling | (alone if (lists or 0) <= 1 else set())
            masked = telling | (alone if (lists or 1) <= 2 else set()) if planted and names and pid % planted == 0 else set()
            keys += [k - (1 << 63) for k in (*mine, *masked)]
            marks += [False] * len(mine) + [True] * len(masked)
            pids += [pid] * (len(mine) + len(masked))
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(pids, pa.int64()), pa.array(marks, pa.bool_())], schema=_KEY)


#: Similarity from which words may be the same; below it, only that it is below matters.
LEAST_ALIKE = 0.8


@lru_cache(maxsize=1 << 16)
def _alike(a: str, b: str) -> float:
    """The similarity of two words, or 0 where letters that one of them lacks rule out
    ``LEAST_ALIKE``."""
    if a == b:
        return 1.0
    la, lb = len(a), len(b)
    if min(la, lb) < 4 or abs(la - lb) > 2:
        return 0.0
    sa, sb = set(a), set(b)
    if 2 * min(la - len(sa - sb), lb - len(sb - sa)) < LEAST_ALIKE * (la + lb):
        return 0.0
    return difflib.SequenceMatcher(None, a, b, autojunk=False).ratio()


@lru_cache(maxsize=1 << 14)
def _titles(wa: tuple[str, ...], wb: tuple[str, ...]) -> tuple[frozenset[str], frozenset[str], frozenset[str], frozenset[str], float]:
    """The words of both titles, those of each without a counterpart, and the similarity
    of the titles without order; profiles of one title meet many times."""
    sa, sb = frozenset(wa), frozenset(wb)
    only_a, only_b = sa - sb, sb - sa
    for w in sorted(only_a):
        best = max(sorted(only_b), key=lambda x: _alike(w, x), default=None)
        if best is not None and _alike(w, best) >= LEAST_ALIKE:
            only_a, only_b = only_a - {w}, only_b - {best}
    # written as one word on a side, as two on the other
    for w, x, y in [(w, x, y) for w in only_a for x in only_b for y in only_b if x + y == w]:
        only_a, only_b = only_a - {w}, only_b - {x, y}
    for w, x, y in [(w, x, y) for w in only_b for x in only_a for y in only_a if x + y == w]:
        only_b, only_a = only_b - {w}, only_a - {x, y}
    squashed = difflib.SequenceMatcher(None, "".join(sorted(wa)), "".join(sorted(wb)), autojunk=False).ratio() if (only_a or only_b) and len(only_a) + len(only_b) < len(sa | sb) else float(not (only_a or only_b))
    return sa, sb, only_a, only_b, squashed


FEATURES = ("title", "squashed", "left_over", "replaced", "names", "first", "initials", "year", "no_year", "no_names", "title_names", "far_year", "conflict", "alone")


def features(wa: list[str], na: list[str], ya: int | None, wb: list[str], nb: list[str], yb: int | None, rare_a: set[str], rare_b: set[str], unique: bool) -> list[float]:
    """Similarities of two profiles.  Words that only differ by a slip are taken
    for the same; ``replaced`` is the share of telling words that stand on each
    side without a counterpart: another system, another field, another work.  ``alone``
    holds where a side names no authors and the title does not stand for one
    work: it has no rare word and others share it."""
    sa, sb, only_a, only_b, squashed = _titles(tuple(wa), tuple(wb))
    union = len(sa | sb) or 1
    weight_a = sum(2.0 if w in rare_a else 1.0 for w in only_a)
    weight_b = sum(2.0 if w in rare_b else 1.0 for w in only_b)
    same = len(sa) - len(only_a)
    title = same / max(1, same + len(only_a) + len(only_b))
    left_over = (weight_a + weight_b) / (union + 2)
    replaced = min(weight_a, weight_b) / (min(len(sa), len(sb)) + 1)
    if na and nb:
        la, lb = {n.split(" ")[0]: n.split(" ")[1:] for n in na}, {n.split(" ")[0]: n.split(" ")[1:] for n in nb}
        both = set(la) & set(lb)
        clash = {s for s in both if la[s] and lb[s] and la[s][0] != lb[s][0]}
        both -= clash  # another person of that surname
        extra = sum(1 for x in set(la) - both if any(_alike(x, y) >= 0.85 for y in set(lb) - both))
        names = (len(both) + extra) / max(1, min(len(la), len(lb))) * 0.5 + (len(both) + extra) / max(1, max(len(la), len(lb))) * 0.5
        first = 1.0 if na[0].split(" ")[0] == nb[0].split(" ")[0] else 0.0
        initials = len(both) / (len(both) + len(clash)) if both else 0.0
        none = 0.0
    else:
        names = first = initials = 0.0
        none = 1.0
    telling_a, telling_b = {w for w in only_a if w in rare_a or _NUMBER.fullmatch(w)}, {w for w in only_b if w in rare_b or _NUMBER.fullmatch(w)}
    conflict = float(bool(telling_a and telling_b))
    gap = abs(ya - yb) if ya and yb else None
    alone = none * float(not sa & rare_a & sb and (not unique or left_over > 0.25 or gap is None or gap > 1))
    return [title, squashed, left_over, replaced, names, first, initials, min(gap, 5) / 5 if gap is not None else 0.2, float(gap is None), none, title * names, float(gap is not None and gap > 3), conflict, alone]


_PAIR = pa.schema([("l", pa.int64()), ("r", pa.int64()), ("planted", pa.bool_()), ("x", pa.list_(pa.float64())), ("label", pa.int32())])


def without_names(x: list[float], alone: bool) -> list[float]:
    """The features that a pair would have if a side named no authors."""
    masked = dict.fromkeys(("names", "first", "initials", "title_names"), 0.0) | {"no_names": 1.0, "alone": float(alone)}
    return [masked.get(n, v) for n, v in zip(FEATURES, x)]


def _featured(batches: Iterator[pa.RecordBatch], common: Broadcast) -> Iterator[pa.RecordBatch]:
    """The features of each pair, and its weak label.  A planted pair has the features
    it would have without names, and the label that its names give it.  A pair without
    names must share a rare word, or have a title of its own (``single``)."""
    known = common.value
    for batch in batches:
        rows = []
        for a, b, planted, single, screened, wa, na, ya, wb, nb, yb, ta, tb in zip(*(c.to_pylist() for c in batch.columns)):
            ra, rb = set(_rare(wa, known)), set(_rare(wb, known))
            if screened and not single and (planted or not na or not nb) and ra.isdisjoint(rb):
                continue
            x = features(wa, na, ya, wb, nb, yb, ra, rb, (ta or 0) <= 1 and (tb or 0) <= 1)
            label = weak_label(x)
            if planted:
                gap = abs(ya - yb) if ya and yb else None
                open_ = not set(wa) & ra & set(wb)
                alone = (ta or 1) <= 2 and (tb or 0) <= 2
                x = without_names(x, bool(open_ and (not alone or x[2] > 0.25 or gap is None or gap > 1)))
            rows.append((a, b, planted, x, label))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _PAIR)], schema=_PAIR)


def weak_label(x: list[float]) -> int | None:
    """1 for the plainly same, 0 for the plainly different, None between."""
    f = dict(zip(FEATURES, x))
    if f["no_names"]:
        return None
    if f["title"] >= 0.99 and f["names"] >= 0.99 and f["initials"] >= 0.99 and f["year"] <= 0.4:
        return 1
    if f["replaced"] <= 0.01 and f["left_over"] < 0.2 and f["names"] >= 0.74 and f["initials"] >= 0.99 and not f["far_year"]:
        return 1
    if f["conflict"]:
        return 0
    if f["names"] <= 0.15 and f["title"] < 0.99 or f["names"] == 0.0:
        return 0
    if f["replaced"] >= 0.3 or f["title"] <= 0.3:
        return 0
    return None


#: What the features say before any label is seen, in their order, and the bias (fixed values).
PRIOR, PRIOR_BIAS = (3.0, 1.5, -4.0, -7.0, 3.0, 0.5, 1.0, -1.0, 0.0, 2.0, 3.0, -2.0, -6.0, -6.0), -5.5


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int) -> tuple[np.ndarray, float]:
    """Weights and bias, drawn towards the prior."""
    prior = np.array(PRIOR)
    w, bias = prior.copy(), PRIOR_BIAS
    for _ in range(steps):
        p = _sigmoid(x @ w + bias)
        w -= 1.0 * (x.T @ (weight * (p - y)) + 0.01 * (w - prior))
        bias -= 1.0 * float((weight * (p - y)).sum() + 0.01 * (bias - PRIOR_BIAS))
    return w, bias


def _platt(z: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int) -> tuple[float, float]:
    """Slope and offset of the calibrated log odds."""
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = _sigmoid(a * z + b)
        a -= 0.1 * (float((weight * (p - y) * z).sum()) + 0.05 * (a - 1))
        b -= 0.1 * (float((weight * (p - y)).sum()) + 0.05 * b)
    return a, b


def _even(y: np.ndarray) -> np.ndarray:
    """Weights by which each class weighs the same."""
    return np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, len(y) - y.sum()))


def fit(named: list[tuple[list[float], int]], nameless: list[tuple[list[float], int]], steps: int = 600) -> dict[str, dict]:
    """Two logistic models from weak labels (features, label), for pairs with names on
    both sides (each class weighing the same) and for pairs without, each with a
    calibration (Platt) on the fifth of the labels that was held out.

    A pair without names labels nothing by itself.  The second model is fitted to planted
    pairs, in their natural numbers: named profiles blocked, filtered and compared as if
    they had no names, whose names then tell what is so.  ``error`` is the mean distance
    of calibrated and true probability over ten bins of held-out rows."""
    out = {}
    for kind, rows in (("named", named), ("nameless", nameless)):
        model = {"w": list(PRIOR), "bias": PRIOR_BIAS, "a": 1.0, "b": 0.0, "error": None, "labels": len(rows)}
        x, y = np.array([r[0] for r in rows]), np.array([float(r[1]) for r in rows])
        if len(set(y)) == 2:
            held = np.arange(len(y)) % 5 == 4
            if len(set(y[~held])) < 2 or len(set(y[held])) < 2:
                held[:] = False
            weigh = _even if kind == "named" else lambda t: np.full(len(t), 1 / len(t))
            w, bias = _logistic(x[~held], y[~held], weigh(y[~held]), steps)
            model |= {"w": w.tolist(), "bias": bias}
            if held.any():
                z = np.clip(x[held] @ w + bias, -8, 8)
                a, b = _platt(z, y[held], weigh(y[held]), steps)
                model |= {"a": a, "b": b, "error": _calibration_error(_sigmoid(a * z + b), y[held])}
        out[kind] = model
    return out


def _calibration_error(p: np.ndarray, y: np.ndarray) -> float:
    bins = np.minimum(9, (p * 10).astype(int))
    return round(float(sum(abs(p[bins == k].mean() - y[bins == k].mean()) * (bins == k).mean() for k in range(10) if (bins == k).any())), 4)


def matches(left: DataFrame, left_id: str, right: DataFrame, right_id: str, title: str = "title", authors: str = "authors", year: str = "year", least: float = 0.5, most_pairs: int = 50_000, frequent: float = 0.0005, rare_words: int = RARE_WORDS, screen: bool = True) -> DataFrame:
    """One row per pair of rows that describe the same work: both ids and
    ``confidence``, at least ``least``.  Without ``screen`` all pairs of a block are
    compared, also those that the native test leaves out."""
    spark = left.sparkSession

    def side(df: DataFrame, key: str) -> DataFrame:
        thin = df.where(F.col(f"`{title}`").isNotNull()).select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{title}`"), F.col(f"`{authors}`"), F.col(f"`{year}`").cast("int"))
        return settle(thin.mapInArrow(_profiles, _PROFILE_SQL))

    rows_l, rows_r = side(left, left_id), side(right, right_id)
    cols = [F.first(c).alias(c) for c in ("words", "names", "year")]
    l, r = (x.groupBy("pid").agg(*cols) for x in (rows_l, rows_r))

    # words of more than a share of all titles: at most (words of a title) / share of them
    n = rows_l.count() + rows_r.count()
    all_words = rows_l.select("words").unionAll(rows_r.select("words")).select(F.explode(F.array_distinct("words")).alias("w"))
    common = {x.w: x["count"] / n for x in all_words.groupBy("w").count().where(F.col("count") > max(3, int(frequent * n))).collect()}

    # how many author lists each title goes with, over both sides
    whole = F.xxhash64(F.array_join("words", ""))
    titles = l.unionAll(r).where(F.size("names") > 0).select(whole.alias("t"), F.transform("names", lambda x: F.split(x, " ")[0]).alias("s")).groupBy("t").agg(F.count_distinct(F.array_sort("s")).alias("n"))
    sent = spark.sparkContext.broadcast(common)
    l, r = (settle(x.withColumn("t", whole).join(titles, "t", "left").select("pid", "words", "names", "year", "n")) for x in (l, r))

    one_in = max(1, n // PLANTED)
    keyed = lambda x, planted: x.select("pid", "words", "names", "n").mapInArrow(partial(_blocks, common=sent, hashes=(TITLE_HASHES, SURNAME_HASHES), rare_words=rare_words, planted=planted), "key bigint, pid bigint, planted boolean")
    key_l, key_r = keyed(l, one_in).withColumnRenamed("pid", "l"), keyed(r, 0).select("key", F.col("pid").alias("r"))
    pairs = key_l.join(key_r, "key").select("l", "r", "planted").distinct()
    renamed = lambda x, p, q: x.select(F.col("pid").alias(p), *[F.col(c).alias(f"{c}_{q}") for c in ("words", "names", "year", "n")])
    full = pairs.join(renamed(l, "l", "a"), "l").join(renamed(r, "r", "b"), "r")
    # pairs that no feature could save are left out natively, before Python sees them
    shared = F.size(F.array_intersect("words_a", "words_b"))
    small = F.least(F.size(F.array_distinct("words_a")), F.size(F.array_distinct("words_b")))
    start = lambda c: F.transform(c, lambda n: F.substring(n, 1, 3))
    both_named = (F.size("names_a") > 0) & (F.size("names_b") > 0)
    # a planted profile's own author list does not count
    own = F.col("planted").cast("int")
    single = (F.coalesce("n_a", F.lit(0)) <= 1 + own) & (F.coalesce("n_b", F.lit(0)) <= 1 + own) & F.coalesce(F.abs(F.col("year_a") - F.col("year_b")) <= 1, F.lit(False))
    if screen:
        full = full.where((shared * 2 >= small) & F.when(both_named & ~F.col("planted"), F.arrays_overlap(start("names_a"), start("names_b"))).otherwise(True))
    featured = settle(full.select("l", "r", "planted", single.alias("single"), F.lit(screen).alias("screened"), "words_a", "names_a", "year_a", "words_b", "names_b", "year_b", "n_a", "n_b").mapInArrow(partial(_featured, common=sent), "l bigint, r bigint, planted boolean, x array<double>, label int"))
    judged = featured.where("label is not null")

    def sample(rows: DataFrame) -> list[tuple[list[float], int]]:
        total = rows.count()
        chosen = rows if total <= most_pairs else rows.where(F.pmod(F.xxhash64("l", "r"), F.lit(1_000_000)) < int(1_000_000 * most_pairs / total))
        return [(list(x.x), x.label) for x in chosen.orderBy(F.xxhash64("l", "r")).limit(most_pairs).select("x", "label").collect()]

    model = fit(sample(judged.where("not planted")), sample(judged.where("planted")))
    featured = featured.where("not planted")

    def chance(m: dict) -> Column:
        z = F.lit(m["bias"])
        for i, w in enumerate(m["w"]):
            z = z + F.element_at("x", i + 1) * w
        return 1 / (1 + F.exp(-(F.lit(m["a"]) * F.greatest(F.lit(-8.0), F.least(F.lit(8.0), z)) + m["b"])))

    nameless = F.element_at("x", FEATURES.index("no_names") + 1) > 0
    confidence = F.when(nameless, chance(model["nameless"])).otherwise(chance(model["named"]))
    matched = featured.select("l", "r", F.round(confidence, 6).alias("confidence")).where(F.col("confidence") >= least)
    out = matched.join(rows_l.select(F.col("pid").alias("l"), F.col("id").alias(left_id)), "l").join(rows_r.select(F.col("pid").alias("r"), F.col("id").alias("__right")), "r")
    return out.select(left_id, F.col("__right").alias(right_id), "confidence")

"""Text functions: titles, abstracts, and the few that Spark has no builtin for.

Everything is a Column expression except Ratcliff-Obershelp similarity and
Unicode decomposition, which are Arrow-batched pandas UDFs.
"""

from __future__ import annotations

import difflib
import html
import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F, types as T
from pyspark.sql.functions import pandas_udf

#: White space beyond ASCII, as a regex class body (fixed values).
SPACES = r"\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{0B}\x{1C}-\x{1F}"
#: The same signs one by one, for trimming without a regular expression.
BLANKS = "".join(c for c in map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: Phrases that mark a version at a title's end (fixed values).
VERSION_PHRASES = ("extended version", "extended abstract", "preprint", "arxiv", r"v\d+", r"version \d+", "workshop version", "camera ready", "camera-ready", "under review", "technical report")
MIN_ABSTRACT = 80


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.btrim(c, F.lit(BLANKS))


def blank_to_null(c: Column) -> Column:
    """The stripped text; null for null, empty and blank."""
    text = strip(c.cast("string"))
    # no nullif: its rewritten form does not take the result of a Python function
    return F.when(text != "", text)


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, f"[{SPACES}]+", " "))


def dedup_title(c: Column) -> Column:
    """Key of title deduplication: lower case, one version phrase at the end
    dropped, everything but a-z, 0-9 and blanks deleted.  Null becomes ''."""
    low = F.lower(F.coalesce(c, F.lit("")))
    tail = f"[{SPACES}]*[(\\[]?[{SPACES}]*({'|'.join(VERSION_PHRASES)})[{SPACES}]*[)\\]]?[{SPACES}]*$"
    return collapse(F.regexp_replace(F.regexp_replace(low, tail, ""), f"[^a-z0-9{SPACES}]", ""))


def match_title(c: Column) -> Column:
    """Key of title matching: signs become blanks.  Null becomes ''."""
    return collapse(F.regexp_replace(F.lower(F.coalesce(F.trim(c), F.lit(""))), f"[^a-z0-9{SPACES}]+", " "))


def recovery_title(c: Column) -> Column:
    """Key of the titles of recovered abstracts: signs are deleted, blanks stay."""
    return F.trim(F.regexp_replace(F.lower(c), f"[^a-z0-9{SPACES}]", ""))


def clean_abstract(c: Column, least: int = MIN_ABSTRACT) -> Column:
    """No tags, single blanks, no leading label; null below ``least`` characters."""
    text = collapse(F.regexp_replace(c, "<[^>]+>", " "))
    text = F.regexp_replace(text, "(?i)^abstract[: ]+", "")
    return F.when(F.length(text) >= least, text)


def from_inverted_index(c: Column) -> Column:
    """The text of a JSON object of word -> positions; gaps are skipped, and of
    two words at one position the later in the object wins.  Null if not one."""
    index = F.from_json(c, "map<string,array<int>>")
    entries = F.map_entries(index)
    placed = F.flatten(F.transform(entries, lambda e, i: F.transform(e["value"], lambda p: F.struct(p.alias("p"), i.alias("i"), e["key"].alias("w")))))
    last = F.filter(F.array_sort(placed), lambda x: x["p"].isNotNull())
    kept = F.filter(last, lambda x, i: (i == F.size(last) - 1) | (F.get(last, i + 1)["p"] != x["p"]))
    return F.nullif(collapse(F.array_join(F.transform(kept, lambda x: x["w"]), " ")), F.lit(""))


def clip(c: Column, limit: int = 70) -> Column:
    text = collapse(F.coalesce(c, F.lit("")))
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.substring(text, 1, limit - 1), F.lit("…")))


def similarity_bound(a: Column, b: Column) -> Column:
    """An upper bound of the similarity, from lengths alone."""
    la, lb = F.length(a), F.length(b)
    return F.when(la + lb > 0, 2.0 * F.least(la, lb) / (la + lb)).otherwise(0.0)


@pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of two normalised titles; 0 where one is empty."""
    return pd.Series([1.0 if x == y and x else difflib.SequenceMatcher(None, x, y).ratio() if x and y else 0.0 for x, y in zip(a, b)], dtype="float64")


# computed once where it stands: the optimiser neither doubles it nor moves it into a filter
similarity = similarity.asNondeterministic()


@pandas_udf(T.StringType())
def squash(texts: pd.Series) -> pd.Series:
    """Entities decoded, compatibility-decomposed, lower case, letters and digits only."""
    return pd.Series(["".join(c for c in unicodedata.normalize("NFKD", html.unescape(t)).lower() if c.isalnum()) if isinstance(t, str) else "" for t in texts], dtype="object")


@pandas_udf(T.DoubleType())
def matched_fraction(needles: pd.Series, hays: pd.Series) -> pd.Series:
    """Share of the needle found in the hay in runs of four or more characters."""
    out = []
    for needle, hay in zip(needles, hays):
        if not needle or not hay:
            out.append(0.0)
        elif needle in hay:
            out.append(1.0)
        else:
            blocks = difflib.SequenceMatcher(None, needle, hay, autojunk=False).get_matching_blocks()
            out.append(min(1.0, sum(b.size for b in blocks if b.size >= 4) / len(needle)))
    return pd.Series(out, dtype="float64")



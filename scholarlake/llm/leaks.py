"""Evaluation texts leaking into training text (problem 7).

Method: one Aho-Corasick automaton over the normalised evaluation items, as runs
of ``run`` words, scans each normalised text once.  The alphabet of the automaton
is the items' words, each written as one sign, so a run of three words is three
nodes deep and a text is scanned a word at a time.  A leak is reported with its
offsets in the original text.  Hits on one item that follow each other in both
texts, with at most ``gap`` words between them, form a stretch (a changed word or a
footnote mark does not break it); a document leaks an item if its stretches cover
the asked share of the item's words.  Half of the words is what the problem's
statement asks; a smaller ``share`` reports smaller parts.

The items are the stated query set: they go to the workers in blocks of at most
``BLOCK_WORDS`` words, which bounds the automaton's nodes (``run`` a word) and so
the memory of a worker; each block is one scan of the documents.

Defined results for odd input: null, empty and blank texts and items give no row;
an item of fewer than ``run`` words is searched as a whole; repeated documents
give a row each, repeated items one each; empty tables give an empty result;
other columns, whatever their names, are not read.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache, partial

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

#: Words of items that one automaton may hold.
BLOCK_WORDS = 1_000_000
#: What stands between or inside words without parting them: tags, comments,
#: entities of blanks, footnote marks in tags, soft hyphens, zero-width signs,
#: and a hyphen at a line's end.
_DROP = re.compile(r"<su[pb]\b[^>]*>[^<]{0,6}</su[pb]>|<!--.*?-->|</?[A-Za-z][^<>]{0,300}>|[\xad​-‏⁠﻿]|[-‐‑]\s*\n\s*", re.S)
_BREAK = re.compile(r"<(?:br|p|div|li|td|tr|h\d)\b[^<>]{0,300}>|</(?:p|div|li|td|tr|h\d)>", re.I)
_ENTITY = re.compile(r"&(?:#x?[0-9A-Fa-f]{1,6}|[A-Za-z]{2,8});")
_WORD = re.compile(r"[^\W_]+")


def _plain(text: str) -> tuple[str, list[int], list[int]]:
    """The text without what parts no words, and for each stretch of it that stood
    together where it starts now and where it stood before."""
    if "<" not in text and "&" not in text and "\n" not in text and not _DROP.search(text):
        return text, [0], [0]
    drop = [(m.start(), m.end(), " " if m.group()[:1] == "<" and _BREAK.match(m.group()) else "") for m in _DROP.finditer(text)]
    marks = [(m.start(), m.end(), html.unescape(m.group())) for m in _ENTITY.finditer(text)] if "&" in text else []
    cuts = sorted(drop + marks) if marks else drop
    parts, starts, origins, at, size = [], [], [], 0, 0
    for s, e, instead in cuts:
        if s < at:
            continue
        for piece, origin in ((text[at:s], at), (instead, s)):
            if piece:
                starts.append(size), origins.append(origin), parts.append(piece)
                size += len(piece)
        at = e
    starts.append(size), origins.append(at), parts.append(text[at:])
    return "".join(parts), starts, origins


def _words(plain: str) -> list[str]:
    if plain.isascii():
        return _WORD.findall(plain.lower())
    return [w.lower() if w.isascii() else _fold(w) for w in _WORD.findall(plain)]


def words_of(text: str) -> list[str]:
    """The normalised words of a text."""
    return _words(_plain(text)[0])


def _places(plain: str, starts: list[int], origins: list[int], wanted: set[int]) -> dict[int, tuple[int, int]]:
    """Where the words of the wanted numbers start and end in the original."""
    out = {}
    for n, m in enumerate(_WORD.finditer(plain)):
        if n in wanted:
            j, k = bisect_right(starts, m.start()) - 1, bisect_right(starts, m.end() - 1) - 1
            out[n] = origins[j] + m.start() - starts[j], origins[k] + m.end() - starts[k]
    return out


@lru_cache(maxsize=1 << 16)
def _fold(word: str) -> str:
    word = unicodedata.normalize("NFKD", word).casefold()
    return "".join(c for c in word if not unicodedata.combining(c)) or word


class Items:
    """The automaton over a block of items."""

    def __init__(self, items: list[tuple[int, str]], run: int) -> None:
        self.sizes: dict[int, int] = {}
        self.signs: dict[str, str] = {}
        self.run = run
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for item, text in items:
            words = words_of(text)
            if not words:
                continue
            self.sizes[item] = len(words)
            line = "".join([self.signs.setdefault(w, _sign(len(self.signs))) for w in words])
            k = min(run, len(words))
            for i in range(len(words) - k + 1):
                places[line[i : i + k]].append((item, i))
        self.automaton = ahocorasick.Automaton()
        for key, where in places.items():
            self.automaton.add_word(key, (len(key), where))
        self.automaton.make_automaton()

    def search(self, text: str, share: float, gap: int) -> list[tuple[int, float, int, int]]:
        """(item, share of its words, first and last place in the text)"""
        if not self.sizes:
            return []
        plain, starts, origins = _plain(text)
        signs = self.signs
        line = "".join([signs.get(w, "\0") for w in _words(plain)])
        hits: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for stop, (k, where) in self.automaton.iter(line):
            for item, i in where:
                hits[item].append((stop - k + 1, i, k))
        out = []
        for item, found in hits.items():
            n = self.sizes[item]
            if len(found) * (self.run + gap) < share * n:
                continue  # too few to cover the share, gaps counted in
            covered: set[int] = set()
            low, high = len(line), -1
            for first, last in _stretches(found, gap, min(6, math.ceil(share * n))):
                covered.update(range(first[1], last[1] + last[2]))
                low, high = min(low, first[0]), max(high, last[0] + last[2] - 1)
            if len(covered) >= share * n:
                out.append((item, round(len(covered) / n, 6), low, high))
        if out:
            at = _places(plain, starts, origins, {w for *_, a, b in out for w in (a, b)})
            out = [(item, part, at[low][0], at[high][1]) for item, part, low, high in out]
        return out


def _sign(n: int) -> str:
    """The nth sign of the alphabet: code points from 1 on, without surrogates."""
    n += 1
    return chr(n if n < 0xD800 else n + 0x800)


#: A hit: word of the text, word of the item, words.
Hit = tuple[int, int, int]


def _stretches(found: list[Hit], gap: int, least: int) -> Iterator[tuple[Hit, Hit]]:
    """First and last hit of the runs of hits that go on in both texts; those of
    fewer words than ``least`` are chance meetings of a stock phrase.

    A run goes on where the distance between the places in the text and in the
    item changes by ``gap`` at most, so runs are kept by that distance, the newest
    of each, and a hit looks at 2 ``gap`` + 1 of them however many there are."""
    found.sort()
    newest: dict[int, list[Hit]] = {}
    done: list[list[Hit]] = []
    for hit in found:
        here, best, off = hit[0] - hit[1], None, gap + 1
        for d in range(here - gap, here + gap + 1):
            chain = newest.get(d)
            if chain is not None and abs(d - here) < off:
                at, i, k = chain[1]
                if 0 < hit[1] - i <= k + gap and 0 < hit[0] - at <= k + gap:
                    best, off = d, abs(d - here)
        if best is None:
            chain = [hit, hit]
        else:
            chain = newest.pop(best)
            chain[1] = hit
        if (old := newest.get(here)) is not None:
            done.append(old)
        newest[here] = chain
    for first, last in (*done, *newest.values()):
        if last[1] + last[2] - first[1] >= least:
            yield first, last


_made: dict[int, Items] = {}
_FOUND = pa.schema([("doc", pa.int64()), ("item", pa.int64()), ("share", pa.float64()), ("start", pa.int64()), ("stop", pa.int64())])


def _scan(batches: Iterator[pa.RecordBatch], items: Broadcast, run: int, share: float, gap: int) -> Iterator[pa.RecordBatch]:
    key = hash((tuple(items.value), run))
    made = _made.get(key)
    if made is None:
        _made.clear()
        made = _made[key] = Items(items.value, run)
    for batch in batches:
        rows = [(doc, *hit) for doc, text in zip(*(c.to_pylist() for c in batch.columns)) if text for hit in made.search(text, share, gap)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _FOUND)], schema=_FOUND)


def leaks(documents: DataFrame, doc_id: str, doc_text: str, items: DataFrame, item_id: str, item_text: str, share: float = 0.5, run: int = 3, gap: int = 3) -> DataFrame:
    """One row per document and item that it leaks: ``doc``, ``item``, ``share``
    of the item's words, and the original offsets ``start`` and ``stop``."""
    spark = documents.sparkSession
    docs = documents.where(F.col(f"`{doc_text}`").isNotNull()).select(F.col(f"`{doc_id}`").cast("bigint").alias("doc"), F.col(f"`{doc_text}`").cast("string").alias("text"))
    asked = items.where(F.col(f"`{item_text}`").isNotNull()).select(F.col(f"`{item_id}`").cast("bigint").alias("item"), F.col(f"`{item_text}`").cast("string").alias("text"))
    words = asked.agg(F.coalesce(F.sum(F.size(F.split(F.trim("text"), r"\s+"))), F.lit(0))).first()[0]
    blocks = max(1, -(-words // BLOCK_WORDS))
    out = None
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b) if blocks > 1 else asked
        sent = spark.sparkContext.broadcast([(r.item, r.text) for r in block.collect()])
        found = docs.mapInArrow(partial(_scan, items=sent, run=run, share=share, gap=gap), "doc bigint, item bigint, share double, start bigint, stop bigint")
        out = found if out is None else out.unionByName(found)
    return out

"""Keyword queries over stored papers: | is or, + is and, - is not, quotes hold
a phrase together, parentheses group.  The text is parsed once on the driver
into a Column, so that the scan filters natively."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

_TOKEN = re.compile(r'\s*(?:"(?P<phrase>[^"]*)"|(?P<op>[()|+])|(?P<not>-(?=["(\w]))|(?P<word>[^\s()|+"]+))')


class _Parser:
    def __init__(self, query: str) -> None:
        self.tokens = [(m.lastgroup, m.group(m.lastgroup)) for m in _TOKEN.finditer(query) if m.lastgroup]
        self.at = 0

    def peek(self) -> tuple[str, str] | None:
        return self.tokens[self.at] if self.at < len(self.tokens) else None

    def either(self, leaf):
        out = self.both(leaf)
        while self.peek() == ("op", "|"):
            self.at += 1
            out = out | self.both(leaf)
        return out

    def both(self, leaf):
        out = self.one(leaf)
        while (t := self.peek()) and t not in (("op", "|"), ("op", ")")):
            if t == ("op", "+"):
                self.at += 1
            out = out & self.one(leaf)
        return out

    def one(self, leaf):
        t = self.peek()
        if t is None:
            raise ValueError("the query ends where a term is due")
        self.at += 1
        if t[0] == "not":
            return ~self.one(leaf)
        if t == ("op", "("):
            out = self.either(leaf)
            if self.peek() != ("op", ")"):
                raise ValueError("a parenthesis is not closed")
            self.at += 1
            return out
        if t[0] == "op":
            raise ValueError(f"{t[1]!r} where a term is due")
        return leaf(t[1])


def matches(query: str, *columns: Column) -> Column:
    """Whether the texts satisfy the query, whatever the case; each word or phrase
    must stand in one of them; what is no letter or digit parts words in both.  Both
    match at word starts, and a trailing * matches any ending."""
    texts = [F.lower(c) for c in columns]

    def leaf(term: str) -> Column:
        open_ = term.endswith("*")
        words = [re.escape(w) for w in re.split(r"[\W_]+", term.lower()) if w]
        if not words:
            return F.lit(True)
        pattern = r"(^|[^\p{L}\p{N}])" + r"[^\p{L}\p{N}]+".join(words) + ("" if open_ else r"($|[^\p{L}\p{N}])")
        found = F.lit(False)
        for text in texts:
            found = found | F.coalesce(text.rlike(pattern), F.lit(False))
        return found

    parser = _Parser(query)
    found = parser.either(leaf)
    if parser.peek() is not None:
        raise ValueError(f"{parser.peek()[1]!r} is left over")
    return found


def within(date_range: str | None, date: Column, year: Column) -> Column:
    """A range like 2018-2025, 2020-, -2019, 2020 or 2020-01-01:2020-06-30 over
    the ISO date, or the year where there is none."""
    if not date_range:
        return F.lit(True)
    low, _, high = date_range.partition(":") if ":" in date_range else (date_range.partition("-") if re.fullmatch(r"\d{0,4}-\d{0,4}", date_range) else (date_range, "", date_range))
    value = F.coalesce(date, F.concat(year.cast("string"), F.lit("-01-01")))
    ok = F.lit(True)
    if low:
        ok = ok & (value >= low)
    if high:
        ok = ok & (F.substring(value, 1, len(high)) <= high)
    return F.coalesce(ok, F.lit(False))


def satisfies(query: str, params: dict[str, str] | None = None) -> Column:
    """Whether a paper satisfies a query and its parameters: ``year`` or
    ``publicationDateOrYear``, ``minCitationCount``, ``venue``, ``publicationTypes``,
    ``fieldsOfStudy`` (of a table that has them), ``openAccessPdf``."""
    params = params or {}
    several = lambda key: F.array(*[F.lit(v.strip()) for v in params[key].split(",")])
    keep = matches(query, F.col("title"), F.col("abstract"))
    keep = keep & within(params.get("publicationDateOrYear") or params.get("year"), F.col("publicationDate"), F.col("year"))
    if int(params.get("minCitationCount") or 0):
        keep = keep & (F.coalesce("citationCount", F.lit(0)) >= int(params["minCitationCount"]))
    if params.get("venue"):
        keep = keep & F.coalesce(F.array_contains(several("venue"), F.col("venue")), F.lit(False))
    for key in ("publicationTypes", "fieldsOfStudy"):
        if params.get(key):
            keep = keep & F.coalesce(F.arrays_overlap(key, several(key)), F.lit(False))
    if "openAccessPdf" in params:
        keep = keep & F.col("openAccessPdf.url").isNotNull()
    return keep


def searched(papers: DataFrame, query: str, params: dict[str, str] | None = None) -> DataFrame:
    return papers.where(satisfies(query, params))


def run_queries(papers: DataFrame, queries: list[tuple[str, int, str, dict]]) -> DataFrame:
    """All queries (id, rank, text, parameters) in one scan: a paper comes out
    once for each query that it satisfies with its parameters."""
    hits = [F.when(satisfies(q, p), F.struct(F.lit(i).alias("query"), F.lit(n).alias("rank"))) for i, n, q, p in queries]
    return papers.withColumn("hit", F.explode(F.filter(F.array(*hits), lambda h: h.isNotNull()))).select("*", "hit.query", "hit.rank").drop("hit")

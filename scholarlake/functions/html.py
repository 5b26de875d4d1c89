"""What pages say of themselves: meta tags, JSON-LD, abstracts, PDF links.

Pages are parsed with the standard library in Arrow batches; the rules by
publisher are a table, not code.
"""

from __future__ import annotations

import html as entities
import json
import re
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from scholarlake.functions import urls

#: Meta names that give the file's address (fixed values).
PDF_META = ("citation_pdf_url", "bepress_citation_pdf_url", "eprints.document_url")
#: Where an abstract stands, in order of trust (fixed values).
GENERIC_META = ("og:description", "description", "twitter:description")
#: By publisher: tag, attribute, pattern of its value (fixed values).
ABSTRACT_PLACES = {
    "Springer": (("section", "data-title", r"^abstract$"), ("div", "id", r"^abs1-content$")), "Nature": (("div", "id", r"^abs1-content$"), ("section", "data-title", r"^abstract$")), "Wiley": (("div", "class", r"article-section__content"), ("section", "class", r"abstract")),
    "Taylor & Francis": (("div", "class", r"abstractsection|hlfld-abstract"),), "Oxford UP": (("section", "class", r"^abstract$"),), "Cambridge UP": (("div", "class", r"abstract"),), "Frontiers": (("div", "class", r"jabstract"),), "MDPI": (("div", "class", r"art-abstract"), ("section", "id", r"html-abstract")),
    "ACM": (("div", "class", r"abstractinfull|abstractsection"), ("section", "id", r"^abstract$")), "PLOS": (("div", "class", r"abstract-content"), ("div", "class", r"abstract")), "AAAI": (("section", "class", r"item abstract"),), "IJCAI": (("div", "class", r"col-md-12|abstract"),), "Elsevier": (("div", "class", r"abstract author"),),
}
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class Page(HTMLParser):
    """Meta tags, anchors, JSON-LD scripts and the text of wanted elements."""

    def __init__(self, wanted: tuple[tuple[str, str, str], ...] = ()) -> None:
        super().__init__(convert_charrefs=True)
        self.meta: list[tuple[str, str]] = []
        self.links: list[str] = []
        self.scripts: list[str] = []
        self.wanted = wanted
        self.found: dict[int, list[str]] = {}
        self.open: list[tuple[str, int | None]] = []
        self.script = False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        got = {k.lower(): (v or "") for k, v in attrs}
        if tag == "meta":
            self.meta.append(((got.get("name") or got.get("property") or "").strip().lower(), got.get("content", "").strip()))
        elif tag == "a" and got.get("href"):
            self.links.append(got["href"].strip())
        elif tag == "script":
            self.script = got.get("type", "").lower() == "application/ld+json"
            if self.script:
                self.scripts.append("")
        if tag not in _VOID:
            hit = next((i for i, (t, a, p) in enumerate(self.wanted) if t == tag and i not in self.found and re.search(p, got.get(a, ""), re.I)), None)
            if hit is not None:
                self.found[hit] = []
            self.open.append((tag, hit))

    def handle_endtag(self, tag: str) -> None:
        if tag == "script":
            self.script = False
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break

    def handle_data(self, data: str) -> None:
        if self.script:
            self.scripts[-1] += data
            return
        for _, hit in self.open:
            if hit is not None:
                self.found[hit].append(data)


def _tidy(text: str | None, least: int) -> str | None:
    text = re.sub(r"\s+", " ", re.sub(r"<[^>]+>", " ", text or "")).strip()
    text = re.sub(r"^abstract[:\s]+", "", text, flags=re.I)
    return text if len(text) >= least else None


def _ld(scripts: list[str], least: int) -> str | None:
    for raw in scripts:
        try:
            data = json.loads(raw)
        except ValueError:
            continue
        data = (data[0] if data else {}) if isinstance(data, list) else data
        for key in ("description", "abstract"):
            if isinstance(data, dict) and isinstance(data.get(key), str) and data[key]:
                return _tidy(data[key], least)
    return None


def _embedded(page: str, marker: str = "xplGlobal.document.metadata=", most: int = 200_000) -> str | None:
    """The abstract in a JSON object after a marker, braces balanced."""
    at = page.find(marker)
    if at < 0:
        return None
    at, depth = page.find("{", at), 0
    for i in range(at, min(len(page), at + most)) if at >= 0 else ():
        depth += (page[i] == "{") - (page[i] == "}")
        if depth == 0:
            try:
                return json.loads(page[at : i + 1]).get("abstract")
            except ValueError:
                return None
    return None


def abstract_of(page: str | None, publisher: str | None, least: int = 80) -> str | None:
    if not page:
        return None
    parsed = Page(ABSTRACT_PLACES.get(publisher or "", ()))
    try:
        parsed.feed(page)
    except Exception:  # a page that no parser reads has no abstract
        return None
    if publisher == "IEEE" and (text := _tidy(_embedded(page), least)):
        return text
    for i in range(len(parsed.wanted)):
        if text := _tidy(" ".join(parsed.found.get(i, ())), least):
            return text
    if text := _ld(parsed.scripts, least):
        return text
    for name in GENERIC_META:
        for got, content in parsed.meta:
            if got == name and (text := _tidy(entities.unescape(content), least)):
                return text
    return None


def _site(url: str) -> str:
    return ".".join((urlsplit(url).hostname or "").split(".")[-2:])


def pdf_link_of(page: str | None, base: str | None) -> str | None:
    """The file's address on a landing page: a meta tag, a journal system's
    download link, or a .pdf link; of the same site only."""
    if not page or not base:
        return None
    parsed = Page()
    try:
        parsed.feed(page)
    except Exception:
        return None
    named = next((c for n, c in parsed.meta if n in PDF_META and c), None)
    download = next((x for x in parsed.links if "/article/download/" in x.lower()), None)
    files = [x for x in parsed.links if re.search(r"\.pdf(?:$|[?#])", x, re.I) and not x.startswith(("javascript:", "mailto:", "#"))]
    for link in (named, download, *files):
        if link:
            try:
                full = urljoin(base, link)
                if full.startswith(("http://", "https://")) and _site(full) == _site(base):
                    return full
            except ValueError:
                continue
    return None


@pandas_udf(T.StringType())
def abstract(pages: pd.Series, publishers: pd.Series) -> pd.Series:
    return pd.Series([abstract_of(p, q) for p, q in zip(pages, publishers)], dtype="object")


@pandas_udf(T.StringType())
def pdf_link(pages: pd.Series, bases: pd.Series) -> pd.Series:
    return pd.Series([pdf_link_of(p, b) for p, b in zip(pages, bases)], dtype="object")


def anchors(page: Column) -> Column:
    """All link targets of a page, in order; native."""
    return F.regexp_extract_all(page, F.lit(r"(?i)<a\b[^>]*?href\s*=\s*[\"']([^\"']+)[\"']"), F.lit(1))


def meta(page: Column, name: str) -> Column:
    """The content of a named meta tag, whatever the order of attributes; native."""
    tags = F.regexp_extract_all(page, F.lit(r"(?i)(<meta\b[^>]*>)"), F.lit(1))
    mine = F.filter(tags, lambda t: t.rlike(rf"(?i)(name|property)\s*=\s*[\"']{name}[\"']"))
    return F.nullif(F.regexp_extract(F.get(mine, 0), r"(?i)content\s*=\s*[\"']([^\"']*)[\"']", 1), F.lit(""))


def _zipped(page: Column, pattern: str, names: tuple[str, ...]) -> Column:
    """The groups of each match of a pattern, as structs in order; native."""
    groups = [F.regexp_extract_all(page, F.lit(pattern), F.lit(i)) for i in range(1, len(names) + 1)]
    return F.transform(F.arrays_zip(*groups), lambda x: F.struct(*[x[str(i)].alias(n) for i, n in enumerate(names)]))


def _plain(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", ""), r"\s+", " "))


def cvf_papers(page: Column) -> Column:
    """The papers that an index page of the computer vision archive lists: ``url``, ``title``."""
    found = _zipped(page, r'(?i)href="(/content/[A-Za-z]+\d{4}(?:_workshops)?/html/[^"]+_paper\.html)"[^>]*>([^<]+)</a>', ("href", "title"))
    found = F.transform(found, lambda x: F.struct(F.concat(F.lit("https://openaccess.thecvf.com"), x["href"]).alias("url"), _plain(x["title"]).alias("title")))
    return F.filter(found, lambda x: x["title"] != "")


def cvf_file(page: Column) -> Column:
    """The file of a paper's page there: its own link, with or without brackets, else the meta tag."""
    own = F.nullif(F.regexp_extract(page, r'(?i)href="([^"]+\.pdf)"[^>]*>\s*\[?\s*pdf\s*\]?\s*</a>', 1), F.lit(""))
    named = F.nullif(F.regexp_extract(page, r'(?i)<meta[^>]+name="citation_pdf_url"[^>]+content="([^"]+)"', 1), F.lit(""))
    link = F.coalesce(own, named)
    return F.when(link.rlike("^https?://"), link).otherwise(F.concat(F.lit("https://openaccess.thecvf.com/"), F.regexp_replace(link, "^/+", "")))


@pandas_udf(T.StringType())
def unescape(texts: pd.Series) -> pd.Series:
    return pd.Series([entities.unescape(t) if isinstance(t, str) else None for t in texts], dtype="object")


def search_results(page: Column, most: int = 5) -> Column:
    """The first results of a search engine's page (``url``, ``title``), redirects undone;
    ``page`` with its entities decoded (``unescape``)."""
    found = _zipped(page, r'(?is)<a[^>]+class="[^"]*result__a[^"]*"[^>]+href="([^"]+)"[^>]*>(.*?)</a>', ("href", "title"))
    found = F.transform(found, lambda x: F.struct(urls.unwrapped(F.trim(x["href"])).alias("url"), _plain(x["title"]).alias("title")))
    return F.slice(F.filter(found, lambda x: (x["url"] != "") & (x["title"] != "")), 1, most)


def file_links(page: Column, most: int = 3) -> Column:
    """The first links to files of a page, as they stand."""
    return F.slice(F.regexp_extract_all(page, F.lit(r'(?i)href="([^"]+\.pdf(?:\?[^"]*)?)"'), F.lit(1)), 1, most)


#: Entities that stand in abstracts (fixed values).
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": " ", "&amp;": "&"}


def acl_abstract(page: Column) -> Column:
    """The text of the anthology's abstract element, without its first span, which is a
    label; native."""
    body = F.regexp_extract(page, r'(?is)<div[^>]*class="[^"]*\bacl-abstract\b[^"]*"[^>]*>(.*?)</div>', 1)
    label = r"(?is)^(.*?)<span\b.*?</span>(.*)$"
    body = F.when(body.rlike(label), F.concat(F.regexp_extract(body, label, 1), F.regexp_extract(body, label, 2))).otherwise(body)
    text = F.regexp_replace(body, "<[^>]+>", "")
    for entity, sign in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return text

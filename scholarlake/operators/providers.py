"""Recorded provider answers as candidate rows.

A provider is a function from rows (``paper_key``, ``payload`` and what it needs
of the paper) to candidates; ``PROVIDERS`` names them in the order in which they
are asked.  A payload that is not JSON gives no candidates.  ``exact`` tells a
lookup by identifier from one by title, which is trusted less.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from scholarlake.functions import ids, urls
from scholarlake.functions.text import blank_to_null

COLUMNS = ("paper_key", "provider", "provider_rank", "cand_pos", "pdf_url", "landing_page_url", "domain", "version_type", "host_type", "license", "confidence", "is_direct_pdf", "title_match_score", "fallback_only", "asserts_open_access")
#: Confidence of a provider's exact and title hits (fixed values).
CONFIDENCE = {"metadata_open_access": (0.85, 0.55), "arxiv": (0.92, 0.80), "acl": (0.97, 0.97), "cvf": (0.90, 0.90), "openalex": (0.95, 0.74), "unpaywall": (0.88, 0.68), "europepmc": (0.87, 0.67), "crossref": (0.82, 0.60), "core": (0.80, 0.65), "zenodo": (0.78, 0.60), "doaj": (0.82, 0.62), "wiley": (0.93, 0.93), "elsevier": (0.93, 0.93), "broad_search": (0.62, 0.62), "openalex_content": (0.88, 0.88), "publisher_landing": (0.50, 0.50)}
#: Prefixes of DOIs whose publisher serves files by DOI (fixed values).
WILEY_PREFIXES = ("10.1002/", "10.1111/", "10.1155/", "10.1046/", "10.1034/", "10.1029/", "10.1113/")
ELSEVIER_PREFIXES = ("10.1016/", "10.1053/", "10.1067/", "10.1078/", "10.1006/", "10.1054/", "10.5555/")
#: Kinds of places of an index, as kinds of hosts (fixed values).
PLACES = {"repository": "repository", "journal": "publisher", "conference": "publisher", "book series": "publisher", "ebook platform": "publisher"}


def _row(provider: str, url: Column, *, landing: Column | None = None, version: Column | str = "unknown", kind: Column | str | None = None, license: Column | None = None, confidence: Column | None = None, direct: Column | bool = True, fallback: bool = False, open_: Column | bool = False) -> Column:
    lit = lambda v, t="string": (F.lit(v) if not isinstance(v, Column) else v).cast(t)
    exact, title = CONFIDENCE[provider]
    site = urls.domain(F.coalesce(url, landing) if landing is not None else url)
    return F.struct(
        lit(provider).alias("provider"), url.alias("pdf_url"), lit(landing).alias("landing_page_url"), site.alias("domain"), lit(version).alias("version_type"), (urls.host_type(site) if kind is None else lit(kind)).alias("host_type"), lit(license).alias("license"),
        (confidence if confidence is not None else F.when(F.col("exact"), exact).otherwise(title)).cast("double").alias("confidence"), lit(direct, "boolean").alias("is_direct_pdf"), F.col("title_match_score").cast("double").alias("title_match_score"), lit(fallback, "boolean").alias("fallback_only"), lit(open_, "boolean").alias("asserts_open_access"),
    )


def _json(ddl: str) -> Column:
    return F.from_json("payload", ddl, {"mode": "PERMISSIVE"})



_OA_LOCATION = "struct<pdf_url:string,landing_page_url:string,version:string,license:string,is_oa:boolean,source:struct<type:string>>"


def _openalex() -> Column:
    """The archive's copy first, then the best, the primary and all other places;
    a place in the archive stands for its mirror, and a landing page counts less."""
    work = _json(f"ids struct<pmcid:string>, best_oa_location {_OA_LOCATION}, primary_location {_OA_LOCATION}, locations array<{_OA_LOCATION}>, open_access struct<is_oa:boolean,oa_url:string>")
    whole = F.when(F.col("exact"), 0.95).otherwise(0.74)
    none = F.lit(None).cast("string")

    def mirror(digits: Column) -> Column:
        return _row("openalex", ids.europepmc_file(digits), landing=ids.europepmc_landing(digits), version="accepted", kind="repository", confidence=whole, open_=True)

    def place(x: Column) -> Column:
        oa_url = work["open_access"]["oa_url"]
        file = F.coalesce(blank_to_null(x["pdf_url"]), F.when(F.lower(oa_url).endswith(".pdf"), oa_url))
        landing = blank_to_null(x["landing_page_url"])
        archived = F.coalesce(ids.pmcid_of_url(file), ids.pmcid_of_url(landing))
        site = urls.domain(F.coalesce(file, landing))
        table = F.create_map(*[F.lit(v) for kv in PLACES.items() for v in kv])
        kind = F.coalesce(F.try_element_at(table, F.lower(F.trim(x["source"]["type"]))), urls.host_type(site))
        version = urls.open_version(x["version"])
        version = F.when((version == "unknown") & (kind == "publisher"), "publisher").otherwise(version)
        usable = F.when(file.isNotNull(), file).when(~F.coalesce(urls.domain(landing).isin("doi.org", "dx.doi.org"), F.lit(False)), landing)
        confidence = F.when(file.isNotNull(), whole).when(F.col("exact"), 0.60).otherwise(0.45)
        own = _row("openalex", usable, landing=landing, version=version, kind=kind, license=x["license"], confidence=confidence, direct=file.isNotNull(), open_=F.coalesce(x["is_oa"], work["open_access"]["is_oa"], F.lit(False)))
        return F.when(archived.isNotNull(), mirror(archived)).otherwise(own)

    known = F.coalesce(ids.pmcid_of_url(work["ids"]["pmcid"]), ids.pmcid_digits(work["ids"]["pmcid"]))
    places = F.filter(F.concat(F.array(work["best_oa_location"], work["primary_location"]), F.coalesce(work["locations"], F.array().cast(f"array<{_OA_LOCATION}>"))), lambda x: x.isNotNull())
    first = F.when(known.isNotNull(), F.array(mirror(F.coalesce(known, none)))).otherwise(F.slice(F.array(mirror(none)), 1, 0))
    return _first_of_each(F.concat(first, F.transform(places, place)))


def _first_of_each(found: Column) -> Column:
    """Of the candidates of one answer the first of each address."""
    found = F.filter(found, lambda x: x["pdf_url"].isNotNull())
    return F.filter(found, lambda x, i: F.array_position(F.transform(found, lambda y: y["pdf_url"]), x["pdf_url"]) == i + 1)


def _unpaywall() -> Column:
    place = "struct<url_for_pdf:string,url_for_landing_page:string,version:string,host_type:string,license:string>"
    work = _json(f"is_oa boolean, best_oa_location {place}, oa_locations array<{place}>")
    places = F.concat(F.array(work["best_oa_location"]), F.coalesce(work["oa_locations"], F.array().cast(f"array<{place}>")))
    usable = F.filter(places, lambda x: F.coalesce(work["is_oa"], F.lit(False)) & (x["url_for_pdf"].isNotNull() | x["url_for_landing_page"].isNotNull()))
    return F.transform(usable, lambda x: _row("unpaywall", F.coalesce(x["url_for_pdf"], x["url_for_landing_page"]), landing=x["url_for_landing_page"], version=urls.open_version(x["version"]), kind=F.coalesce(x["host_type"], F.lit("unknown")), license=x["license"], direct=x["url_for_pdf"].isNotNull(), confidence=F.when(x["url_for_pdf"].isNotNull(), F.when(F.col("exact"), 0.88).otherwise(0.68)).otherwise(F.when(F.col("exact"), 0.60).otherwise(0.45)), open_=True))


def _europepmc() -> Column:
    hits = _json("resultList struct<result:array<struct<pmcid:string,isOpenAccess:string,inEPMC:string,hasPDF:string,license:string>>>")["resultList"]["result"]
    usable = F.filter(hits, lambda x: (F.upper(x["inEPMC"]) == "Y") & (F.upper(x["hasPDF"]) == "Y") & x["pmcid"].isNotNull())
    return F.transform(usable, lambda x: _row("europepmc", ids.europepmc_file(ids.pmcid_digits(x["pmcid"])), landing=ids.europepmc_landing(ids.pmcid_digits(x["pmcid"])), version=F.when(F.upper(x["isOpenAccess"]) == "Y", "publisher").otherwise("accepted"), kind="repository", license=x["license"], open_=True))


def _crossref() -> Column:
    links = _json("message struct<link:array<struct<URL:string,`content-type`:string,`content-version`:string,`intended-application`:string>>>")["message"]["link"]
    is_pdf = lambda x: F.coalesce(F.lower(x["content-type"]).contains("pdf"), F.lit(False)) | F.lower(x["URL"]).endswith(".pdf")
    usable = F.filter(links, lambda x: x["URL"].isNotNull() & is_pdf(x) & (F.coalesce(F.lower(x["intended-application"]), F.lit("")) != "similarity-checking") & ~urls.is_staging(x["URL"]))
    return F.transform(usable, lambda x: _row("crossref", x["URL"], version=urls.link_version(x["content-version"])))


def _core() -> Column:
    hits = _json("results array<struct<downloadUrl:string,sourceFulltextUrls:array<string>>>")["results"]
    places = F.flatten(F.transform(hits, lambda x: F.concat(F.array(x["downloadUrl"]), F.coalesce(x["sourceFulltextUrls"], F.array().cast("array<string>")))))
    own = lambda u: urls.under(urls.host(u), ("core.ac.uk",))
    return F.transform(F.filter(places, lambda u: blank_to_null(u).isNotNull()), lambda u: _row("core", u, version=F.when(own(u), "accepted").otherwise("unknown"), kind=F.when(own(u), "repository").otherwise("unknown"), direct=own(u) | urls.is_pdf_url(u)))


def _zenodo() -> Column:
    """Open deposits of publications, preprints or of no stated type, and of any type
    where a PDF is among the files; the largest PDF of a deposit is the paper."""
    file = "struct<key:string,size:bigint,links:struct<self:string,download:string>>"
    metadata = "struct<access_right:string,resource_type:struct<id:string,type:string>,license:struct<id:string>>"
    hits = _json(f"hits struct<hits:array<struct<metadata:{metadata},access:struct<files:string>,files:array<{file}>>>>")["hits"]["hits"]

    def largest(x: Column) -> Column:
        pdfs = F.filter(x["files"], lambda f: F.lower(f["key"]).endswith(".pdf"))
        # of equals the first
        ordered = F.array_sort(F.transform(pdfs, lambda f, i: F.struct((-F.coalesce(f["size"], F.lit(0))).alias("s"), i.alias("i"), F.coalesce(f["links"]["self"], f["links"]["download"]).alias("u"))))
        return F.get(ordered, 0)["u"]

    is_open = lambda x: F.coalesce(F.lower(x["access"]["files"]) == "public", F.lit(False)) | F.coalesce(F.lower(x["metadata"]["access_right"]) == "open", F.lit(False))
    usable = F.filter(hits, lambda x: is_open(x) & largest(x).isNotNull())
    return F.transform(usable, lambda x: _row("zenodo", largest(x), version="accepted", kind="repository", license=x["metadata"]["license"]["id"]))


def _doaj() -> Column:
    hits = _json("results array<struct<bibjson:struct<link:array<struct<type:string,url:string,content_type:string>>>>>")["results"]
    links = F.flatten(F.transform(hits, lambda x: x["bibjson"]["link"]))
    return F.transform(F.filter(links, lambda x: (F.lower(x["type"]) == "fulltext") & x["url"].isNotNull()), lambda x: _row("doaj", x["url"], version="publisher", kind="publisher", direct=urls.is_pdf_url(x["url"]) | F.coalesce(F.lower(x["content_type"]).contains("pdf"), F.lit(False)), open_=True))


def _arxiv() -> Column:
    return F.array(_row("arxiv", F.concat(F.lit("https://arxiv.org/pdf/"), "arxiv_id"), landing=F.concat(F.lit("https://arxiv.org/abs/"), "arxiv_id"), version="preprint", kind="preprint"))


def _acl() -> Column:
    paper = F.coalesce(blank_to_null(F.col("acl_id")), F.nullif(F.regexp_extract("doi", r"(?i)^10\.18653/v1/(.+)$", 1), F.lit("")))
    return F.filter(F.array(_row("acl", F.concat(F.lit("https://aclanthology.org/"), paper, F.lit(".pdf")), version="publisher", kind="publisher")), lambda x: x["pdf_url"].isNotNull())


def _own() -> Column:
    u = blank_to_null(F.col("open_url"))
    digits = ids.pmcid_of_url(u)
    pmc = F.coalesce(digits, F.lit(""))
    url = F.when(pmc != "", ids.europepmc_file(digits)).otherwise(u)
    known = u.isNotNull() & ~F.coalesce(urls.domain(u).isin("doi.org", "dx.doi.org"), F.lit(False))
    direct = (pmc != "") | urls.is_pdf_url(u) | urls.under(urls.host(u), ("arxiv.org",))
    return F.filter(F.array(_row("metadata_open_access", F.when(known, url), version=F.when(pmc != "", "accepted").otherwise(urls.version_type(urls.domain(u))), kind=F.when(pmc != "", "repository").otherwise(urls.host_type(urls.domain(u))), direct=direct, confidence=F.when(direct, 0.85).otherwise(0.55), open_=pmc != "")), lambda x: x["pdf_url"].isNotNull())


def _by_prefix(provider: str, base: str, prefixes: tuple[str, ...], keep_slash: bool) -> Column:
    path = F.replace(F.url_encode(F.trim("doi")), F.lit("+"), F.lit("%20"))
    path = F.replace(path, F.lit("%2F"), F.lit("/")) if keep_slash else path
    mine = F.concat(F.substring_index(F.lower(F.trim("doi")), "/", 1), F.lit("/")).isin(*prefixes)
    return F.filter(F.array(_row(provider, F.when(mine, F.concat(F.lit(base), path)), version="publisher", kind="publisher")), lambda x: x["pdf_url"].isNotNull())


def _cached() -> Column:
    work = _json("has_content struct<pdf:boolean>, content_urls struct<pdf:string>")
    return F.filter(F.array(_row("openalex_content", F.when(work["has_content"]["pdf"], urls.without_query(work["content_urls"]["pdf"])), version="publisher", kind="repository", fallback=True, open_=True)), lambda x: x["pdf_url"].isNotNull())


def _landing() -> Column:
    url = _json("message struct<resource:struct<primary:struct<URL:string>>>")["message"]["resource"]["primary"]["URL"]
    return F.filter(F.array(_row("publisher_landing", url, landing=url, version="publisher", kind="publisher", direct=False, fallback=True)), lambda x: x["pdf_url"].isNotNull())


def _links(provider: str, version: str | None, kind: str | None, most: int) -> Column:
    found = F.slice(F.filter(_json("links array<string>")["links"], lambda u: urls.is_pdf_url(u) & ~urls.is_staging(u)), 1, most)
    return F.transform(found, lambda u: _row(provider, u, version=version or urls.version_type(urls.domain(u)), kind=kind))


#: Providers in the order in which they are asked; an order of one's own enables
#: just those that it names.
PROVIDERS: dict[str, Callable[[], Column]] = {
    "metadata_open_access": _own, "arxiv": _arxiv, "acl": _acl, "cvf": lambda: _links("cvf", "publisher", "publisher", 3), "openalex": _openalex, "unpaywall": _unpaywall, "europepmc": _europepmc, "crossref": _crossref, "core": _core, "zenodo": _zenodo, "doaj": _doaj,
    "wiley": lambda: _by_prefix("wiley", "https://api.wiley.com/onlinelibrary/tdm/v1/articles/", WILEY_PREFIXES, False), "elsevier": lambda: _by_prefix("elsevier", "https://api.elsevier.com/content/article/doi/", ELSEVIER_PREFIXES, True), "broad_search": lambda: _links("broad_search", None, None, 5), "openalex_content": _cached, "publisher_landing": _landing,
}


def hit_verdict(ours: dict[str, Column], theirs: dict[str, Column], score: Column, threshold: float = 0.90) -> Column:
    """Why a preprint found by title is not the paper, null if it is: the title first,
    then surnames (two in common, one for a single author), then the year (two before
    to one after).  ``ours`` and ``theirs`` hold ``authors`` and ``year``."""
    many = F.coalesce(F.size(ours["authors"]), F.lit(0))
    shared = ids.surname_overlap(ours["authors"], theirs["authors"])
    need = F.when(many == 1, 1).otherwise(2)
    gap = theirs["year"] - ours["year"]
    return (
        F.when(F.coalesce(score, F.lit(0.0)) < threshold, F.format_string("title similarity %.2f < %.2f", F.coalesce(score, F.lit(0.0)), F.lit(threshold)))
        .when((many > 0) & (shared < need), F.format_string("%d author surname(s) in common, need %d", shared, need))
        .when(~gap.between(-2, 1), F.format_string("published %d, paper is %d", theirs["year"], ours["year"]))
    )


def candidates(rows: DataFrame, order: list[str] | None = None, keyed: bool = True) -> DataFrame:
    """Candidates of all rows (``paper_key provider payload exact
    title_match_score doi arxiv_id acl_id open_url hit_pos``), for the providers
    that ``order`` names, in its order; names of no provider are left out, and none
    at all is an error.  Without ``keyed``, publishers' services that need a key
    give nothing."""
    order = [p for p in (PROVIDERS if order is None else order) if p in PROVIDERS]
    if not order:
        raise ValueError("the order names no provider")
    if not keyed:
        rows = rows.where(~F.col("provider").isin("wiley", "elsevier"))
    # one pass over the answers, whatever the number of providers
    made, rank = None, {}
    for n, name in enumerate(order, 1):
        mine = F.col("provider") == name
        made = F.when(mine, PROVIDERS[name]()) if made is None else made.when(mine, PROVIDERS[name]())
        rank.setdefault(name, n)
    ranks = F.create_map(*[F.lit(x) for kv in rank.items() for x in kv])
    found = rows.where(F.col("provider").isin(*rank)).select("paper_key", "hit_pos", F.try_element_at(ranks, F.col("provider")).alias("provider_rank"), F.posexplode(made).alias("i", "c"))
    return found.select("paper_key", "provider_rank", (F.col("hit_pos") * 1000 + F.col("i")).alias("cand_pos"), "c.*").where("pdf_url is not null").select(*COLUMNS)

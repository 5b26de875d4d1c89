"""Hosts, publishers and versions, as Columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Publisher by DOI prefix (fixed values).
PUBLISHER_OF_PREFIX = {
    "10.1007": "Springer", "10.1038": "Nature", "10.1023": "Springer", "10.1057": "Springer", "10.1140": "Springer", "10.1245": "Springer", "10.1617": "Springer", "10.1365": "Springer", "10.1134": "Springer", "10.1186": "Springer",
    "10.1016": "Elsevier", "10.1053": "Elsevier", "10.1067": "Elsevier", "10.1078": "Elsevier", "10.1054": "Elsevier", "10.1109": "IEEE", "10.1145": "ACM", "10.1002": "Wiley", "10.1111": "Wiley", "10.1080": "Taylor & Francis", "10.1081": "Taylor & Francis",
    "10.1017": "Cambridge UP", "10.1093": "Oxford UP", "10.3389": "Frontiers", "10.3390": "MDPI", "10.1371": "PLOS", "10.1162": "MIT Press", "10.1609": "AAAI", "10.24963": "IJCAI", "10.1561": "Now Publishers",
}
#: Publisher by a part of the address, the first that is found (fixed values).
PUBLISHER_OF_URL = (
    ("link.springer.com", "Springer"), ("nature.com", "Nature"), ("sciencedirect.com", "Elsevier"), ("linkinghub.elsevier.com", "Elsevier"), ("ieeexplore.ieee.org", "IEEE"), ("dl.acm.org", "ACM"), ("onlinelibrary.wiley.com", "Wiley"), ("tandfonline.com", "Taylor & Francis"),
    ("cambridge.org", "Cambridge UP"), ("oup.com", "Oxford UP"), ("frontiersin.org", "Frontiers"), ("mdpi.com", "MDPI"), ("plos.org", "PLOS"), ("aaai.org", "AAAI"), ("ijcai.org", "IJCAI"),
)
#: Domains by kind of host (fixed values).
PREPRINT_DOMAINS = ("arxiv.org", "biorxiv.org", "medrxiv.org", "chemrxiv.org", "ssrn.com", "preprints.org", "techrxiv.org", "osf.io")
PUBLISHER_DOMAINS = ("aclanthology.org", "openaccess.thecvf.com", "dl.acm.org", "ieeexplore.ieee.org", "link.springer.com", "nature.com", "sciencedirect.com", "tandfonline.com", "wiley.com", "onlinelibrary.wiley.com", "oup.com", "academic.oup.com", "cambridge.org", "journals.sagepub.com", "mdpi.com", "frontiersin.org", "plos.org", "journals.plos.org", "bmj.com", "jamanetwork.com", "ahajournals.org")
REPOSITORY_DOMAINS = ("pmc.ncbi.nlm.nih.gov", "europepmc.org", "zenodo.org", "core.ac.uk", "hal.science", "hal.archives-ouvertes.fr", "research-repository.uwa.edu.au")
#: Parts of addresses of test systems (fixed values).
STAGING = ("staging.", "xplorestaging.", "test.", "sandbox.", "dev.", "qa.")
#: Kind of host and version of its files, by the kind of domain.
_KINDS = {PREPRINT_DOMAINS: ("preprint", "preprint"), PUBLISHER_DOMAINS: ("publisher", "publisher"), REPOSITORY_DOMAINS: ("repository", "accepted")}
#: Headers in which a publisher's host says what it sent, and the values that say that
#: it is not the whole article (fixed values).
ENTITLEMENT_HEADERS = {"api.elsevier.com": ("X-ELS-Status", "X-ELS-ResourceVersion", "X-ELS-Entitlement")}
NOT_ENTITLED = ("firstpage", "first_page", "first page", "preview", "unentitled", "not entitled")


def domain(url: Column) -> Column:
    """Host and port in lower case, without www."""
    part = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    return F.nullif(F.regexp_replace(part, r"^www\.", ""), F.lit(""))


def host(url: Column) -> Column:
    """As ``domain``, without user and port."""
    return F.nullif(F.regexp_replace(F.regexp_replace(F.regexp_replace(domain(url), r"^[^@]*@", ""), r":\d*$", ""), r"^www\.", ""), F.lit(""))


def suffixes(host_: Column) -> Column:
    """a.b.c -> [a.b.c, b.c, c], the most specific first."""
    parts = F.split(host_, r"\.")
    n = F.size(parts)
    return F.when(host_.isNotNull(), F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(parts, i, n), ".")))


def under(host_: Column, domains: list[str] | tuple[str, ...]) -> Column:
    """Whether the host is one of the domains or lies under one."""
    return F.coalesce(F.arrays_overlap(suffixes(host_), F.array(*[F.lit(d) for d in domains])), F.lit(False))


def publisher_of_doi(doi: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in PUBLISHER_OF_PREFIX.items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.substring_index(doi, "/", 1)), F.lit("Unknown"))


def publisher_of_url(url: Column) -> Column:
    low = F.lower(url)
    first, *rest = PUBLISHER_OF_URL
    out = F.when(low.contains(first[0]), first[1])
    for part, name in rest:
        out = out.when(low.contains(part), name)
    return out.otherwise("Unknown")


def _by_domain(domain_: Column, which: int, fallback: str) -> Column:
    table = F.create_map(*[F.lit(x) for domains, kinds in _KINDS.items() for d in domains for x in (d, kinds[which])])
    return F.coalesce(F.try_element_at(table, domain_), F.lit(fallback))


def host_type(domain_: Column) -> Column:
    return _by_domain(domain_, 0, "unknown")


def version_type(domain_: Column, fallback: str = "unknown") -> Column:
    return _by_domain(domain_, 1, fallback)


def open_version(v: Column) -> Column:
    """Version names of open-access indexes in our terms."""
    names = {"publishedversion": "publisher", "acceptedversion": "accepted", "submittedversion": "preprint"}
    table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.lower(v)), F.nullif(v, F.lit("")), F.lit("unknown"))


def link_version(v: Column) -> Column:
    """Version names of registration agencies in our terms."""
    low = F.lower(v)
    return F.when(low.isin("vor", "tdm"), "publisher").when(low == "am", "accepted").when(low.isin("preprint", "submitted"), "preprint").otherwise("unknown")


def is_staging(url: Column) -> Column:
    low, found = F.lower(url), F.lit(False)
    for part in STAGING:
        found = found | low.contains(part)
    return F.coalesce(found, F.lit(False))


def preview_header(host_: Column, headers: Column) -> Column:
    """The header by which a host says that it sent less than the whole article, as
    ``name: value``; null where nothing says so."""
    named = F.transform_keys(headers, lambda k, v: F.lower(k))
    out = F.lit(None).cast("string")
    for where, names in reversed(ENTITLEMENT_HEADERS.items()):
        for name in reversed(names):
            value = F.trim(F.try_element_at(named, F.lit(name.lower())))
            told = F.lower(value).rlike("|".join(NOT_ENTITLED))
            out = F.when(under(host_, (where,)) & F.coalesce(told, F.lit(False)), F.concat(F.lit(f"{name}: "), value)).otherwise(out)
    return out


def unwrapped(url: Column) -> Column:
    """The address that a search engine's redirect leads to; others as they are."""
    to = F.regexp_extract(url, r"[?&]uddg=([^&#]+)", 1)
    return F.when(domain(url).contains("duckduckgo.com") & (to != ""), F.url_decode(to)).otherwise(url)


def is_pdf_url(url: Column) -> Column:
    return F.coalesce(F.lower(url).rlike(r"\.pdf($|[?#])"), F.lit(False))


def without_query(url: Column) -> Column:
    """The address without what may hold a credential."""
    return F.split_part(url, F.lit("?"), F.lit(1))

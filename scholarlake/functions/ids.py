"""Identifiers: normal forms, keys and the three classifiers, as Columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from scholarlake.functions.text import blank_to_null, match_title, strip

#: Shapes of identifiers (fixed values).
DOI = r"(?i)(10\.\d{4,9}/\S+)"
ARXIV = r"([A-Za-z\-]+/\d{7}|\d{4}\.\d{4,5})"
HEX40 = r"^[0-9a-fA-F]{40}$"
ARXIV_DOI = rf"(?i)10\.48550/arxiv\.{ARXIV}"
PREFIXES = ("DOI", "ARXIV", "MAG", "ACL", "PMID", "PMCID", "CORPUSID")


def _found(c: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def doi(c: Column) -> Column:
    """The DOI within a text, lower case, without closing punctuation."""
    text = F.replace(blank_to_null(c), F.lit("\\"), F.lit(""))
    return F.lower(F.nullif(F.regexp_replace(_found(text, DOI), r"[ .;,)]+$", ""), F.lit("")))


def doi_key(c: Column) -> Column:
    """Key of a lookup cache: one address or scheme prefix less, lower case."""
    return F.nullif(F.regexp_replace(F.lower(blank_to_null(c)), r"^(https?://(dx\.)?doi\.org/|doi:\s*)", ""), F.lit(""))


def doi_printed(c: Column) -> Column:
    """The DOI as looked for in print: every prefix taken off in turn."""
    text = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    for prefix in (r"doi:", r"https://doi\.org/", r"http://doi\.org/", r"doi\.org/", r"https://dx\.doi\.org/", r"http://dx\.doi\.org/", r"dx\.doi\.org/"):
        text = F.regexp_replace(text, f"^{prefix}", "")
    return text


def arxiv(c: Column) -> Column:
    """The arXiv id within a text, without version."""
    text = F.regexp_replace(blank_to_null(c), r"(?i)^https?://arxiv\.org/(abs|pdf)/", "")
    text = F.regexp_replace(F.regexp_replace(text, r"(?i)^arxiv:\s*", ""), r"(?i)\.pdf$", "")
    return _found(text, ARXIV)


def arxiv_of_doi(c: Column) -> Column:
    return _found(doi(c), ARXIV_DOI)


def arxiv_of_dblp(c: Column) -> Column:
    """The id in a DBLP key of a preprint (journals/corr/abs-YYMM-NNNNN)."""
    short = F.regexp_extract(c, r"abs-(\d{4})-(\d{4,5})", 1)
    return F.when(short != "", F.concat_ws(".", short, F.regexp_extract(c, r"abs-(\d{4})-(\d{4,5})", 2)))


def arxiv_any(own: Column, of_doi: Column, of_dblp: Column) -> Column:
    return F.coalesce(arxiv(own), arxiv_of_doi(of_doi), arxiv_of_dblp(of_dblp))


def pmcid_digits(c: Column) -> Column:
    """The digits of a PubMed Central id, with or without its prefix."""
    return _found(F.trim(c.cast("string")), r"(?i)^(?:PMC)?(\d+)$")


def pmcid_of_url(c: Column) -> Column:
    """The digits of the id that an article's address names."""
    return _found(c, r"(?i)(?:ncbi\.nlm\.nih\.gov|europepmc\.org)/(?:pmc/)?articles?/PMC(\d+)")


def pmcid(c: Column) -> Column:
    """PMC and digits, from an id or an address."""
    return F.concat(F.lit("PMC"), F.coalesce(pmcid_digits(c), pmcid_of_url(c)))


def europepmc_landing(digits: Column) -> Column:
    return F.concat(F.lit("https://europepmc.org/articles/PMC"), digits)


def europepmc_file(digits: Column) -> Column:
    return F.concat(europepmc_landing(digits), F.lit("?pdf=render"))


def is_interstitial(final_url: Column, body: Column) -> Column:
    """Whether the archive sent its page that fetches the file by script."""
    told = F.lower(F.substring(F.coalesce(body, F.lit("")), 1, 65536)).contains("preparing to download")
    return F.coalesce(F.lower(final_url).contains("pmc.ncbi.nlm.nih.gov") & told, F.lit(False))


def recovery_arxiv(own: Column, doi_: Column, dblp: Column) -> Column:
    """The arXiv id by which an abstract is asked for: the case of the DOI counts, and
    the id is taken as it stands after its mark."""
    of_doi = F.when(doi_.contains("arXiv"), F.element_at(F.split(doi_, r"arXiv\."), -1))
    of_dblp = F.when(dblp.contains("journals/corr/abs-"), F.replace(F.element_at(F.split(dblp, "abs-"), -1), F.lit("-"), F.lit(".")))
    return F.coalesce(F.nullif(own, F.lit("")), of_doi, of_dblp)


#: Conferences of the open-access archive of computer vision (fixed values).
CVF_VENUES = ("CVPR", "ICCV", "ECCV", "WACV")


def cvf_venue(venue: Column, doi_: Column) -> Column:
    """The conference named by the venue, else by the DOI (where ECCV has none)."""
    of_venue = F.coalesce(*[F.when(F.upper(venue).contains(v), v) for v in CVF_VENUES])
    return F.coalesce(of_venue, *[F.when(F.upper(doi_).contains(v), v) for v in CVF_VENUES if v != "ECCV"])


def cvf_year(year: Column, doi_: Column) -> Column:
    """The year, else the one that the DOI names before its last number."""
    return F.coalesce(F.nullif(year, F.lit(0)), _found(doi_, r"\.\b(20\d{2})\.\d+$").cast("int"))


def cvf_index(venue: Column, year: Column) -> Column:
    return F.concat(F.lit("https://openaccess.thecvf.com/"), venue, year.cast("string"), F.lit("?day=all"))


def file_component(c: Column, most: int = 180) -> Column:
    """A component of a path: as ``safe``, trimmed and of limited length."""
    return F.substring(safe(strip(c)), 1, most)


def graph_file(c: Column) -> Column:
    """An id as a file name on any platform: each troublesome sign is a ``_``."""
    return F.translate(c, ':/\\?*<>|"', "_________")


def safe(c: Column) -> Column:
    """A component of a file name: other characters become one underscore.
    Null stays null."""
    text = F.regexp_replace(c, r"[^A-Za-z0-9._-]+", "_")
    return F.when(c.isNotNull(), F.coalesce(F.nullif(F.regexp_replace(text, r"^[._]+|[._]+$", ""), F.lit("")), F.lit("unknown")))


def paper_key(doi_: Column, arxiv_: Column, scholar: Column, corpus: Column, title: Column) -> Column:
    """The first identifier there is, named by its kind; else a hash of the title."""
    hashed = F.substring(F.sha1(F.coalesce(F.nullif(match_title(title), F.lit("")), F.lit("unknown"))), 1, 16)
    ids = [("doi", doi(doi_)), ("arxiv", arxiv(arxiv_)), ("ss", blank_to_null(scholar)), ("corpus", blank_to_null(corpus))]
    return F.coalesce(*[F.concat(F.lit(f"{name}__"), safe(c)) for name, c in ids], F.concat(F.lit("title__"), hashed))


def lookup_id(scholar: Column, corpus: Column, doi_: Column, arxiv_: Column, acl: Column, pmid: Column, pmc: Column, mag: Column) -> Column:
    """The id to ask a scholarly graph for, the most exact one first."""
    named = (("CorpusId:", corpus), ("DOI:", doi_), ("ARXIV:", arxiv_), ("ACL:", acl), ("PMID:", pmid), ("PMCID:", pmc), ("MAG:", mag))
    return F.coalesce(blank_to_null(scholar), *[F.concat(F.lit(p), blank_to_null(c)) for p, c in named])


def kind_of_input(c: Column) -> Column:
    """Kind of an input value, for a downloader: the least strict classifier."""
    raw, low = F.trim(c), F.lower(F.trim(c))
    kind = F.when(raw.rlike(r"(?i)^(https?://(dx\.)?doi\.org/|doi:\s*)?10\.\d{4,9}/\S+$"), "doi")
    kind = kind.when(raw.rlike(rf"(?i)^(https?://arxiv\.org/(abs|pdf)/|arxiv:\s*)?{ARXIV}(v\d+)?(\.pdf)?$"), "arxiv")
    kind = kind.when(low.startswith("corpusid:"), "corpus_id").when(raw.rlike(HEX40), "semantic_scholar_paper_id")
    for prefix, name in (("pmcid:", "pmcid"), ("pmid:", "pmid"), ("mag:", "mag"), ("acl:", "acl_id")):
        kind = kind.when(low.startswith(prefix), name)
    return kind.otherwise("title_or_unknown")


def batch_id(c: Column) -> Column:
    """Canonical id for a batch fetch; null where the id is invalid."""
    raw = F.trim(c)
    known = F.upper(raw).rlike(f"^({'|'.join(PREFIXES)}):")
    return (
        F.when(known, raw)
        .when(raw.startswith("10.") & raw.contains("/"), F.concat(F.lit("DOI:"), raw))
        .when(raw.rlike(r"^\d{4}\.\d{4,5}(v\d+)?$"), F.concat(F.lit("ARXIV:"), raw))
        .when(raw.rlike(HEX40), raw)
    )


def graph_id(c: Column) -> Column:
    """Canonical id for a citation graph; null where the id is invalid."""
    raw = F.trim(c)
    prefix = F.upper(F.substring_index(raw, ":", 1))
    rest = F.regexp_replace(raw, "^[^:]*:", "")
    named = F.when(prefix == "CORPUSID", "CorpusId").otherwise(prefix)
    return (
        F.when(raw.contains(":") & prefix.isin(*PREFIXES, "URL"), F.concat(named, F.lit(":"), rest))
        .when(raw.rlike(r"^\d+$"), F.lit(None).cast("string"))
        .when(raw.rlike(HEX40), raw)
        .when(raw.rlike(r"^10\.\d{4,9}/\S+$"), F.concat(F.lit("DOI:"), raw))
        .when(raw.rlike(rf"^{ARXIV}(v\d+)?$"), F.concat(F.lit("ARXIV:"), raw))
        .when(raw.rlike(r"(?i)^https?://\S+$"), F.concat(F.lit("URL:"), raw))
    )


def id_error(c: Column, canonical: Column) -> Column:
    """What is wrong with an id that has no canonical form."""
    raw = F.trim(c)
    return F.when(canonical.isNotNull(), F.lit(None).cast("string")).when(F.coalesce(raw, F.lit("")) == "", "empty").when(raw.rlike(r"^\d+$"), "ambiguous number").otherwise("unrecognised")


def surname(c: Column) -> Column:
    """The part before a comma, else the last word; lower case."""
    name = F.lower(F.trim(c))
    return F.when(name.contains(","), F.trim(F.substring_index(name, ",", 1))).otherwise(F.substring_index(name, " ", -1))


def surname_overlap(a: Column, b: Column) -> Column:
    """How many surnames two author lists share."""
    one, two = (F.filter(F.transform(x, surname), lambda s: s != "") for x in (a, b))
    return F.coalesce(F.size(F.array_intersect(one, two)), F.lit(0))

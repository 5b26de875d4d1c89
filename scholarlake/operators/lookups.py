"""What each provider is asked about a paper, and what its answers are worth.

``requests`` gives the rows that a table of recorded answers is joined to by
(``provider``, ``kind``, ``key``): exact lookups first, a search by title last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from scholarlake.functions import asked, ids
from scholarlake.functions.text import blank_to_null

#: Providers whose failures leave no reason (fixed values).
SILENT = ("core", "doaj", "zenodo")


def _requests() -> list[tuple[str, str, Column, int]]:
    """(provider, kind, key, hits at most), in the order in which each provider asks."""
    doi, title = ids.doi(F.col("doi")), blank_to_null(F.col("title"))
    digits, pmid = ids.pmcid_digits(F.col("pmcid")), blank_to_null(F.col("pmid"))
    named = lambda prefix, c: F.concat(F.lit(prefix), c)
    return [
        ("arxiv", "id", ids.arxiv(F.col("arxiv_id")), 1),
        ("arxiv", "title", asked.arxiv_title(title), 5),
        ("openalex", "doi", named("https://doi.org/", doi), 1),
        ("openalex", "title", named("title.search:", title), 5),
        ("unpaywall", "doi", doi, 1),
        ("unpaywall", "title", title, 5),
        ("europepmc", "pmcid", named("PMCID:PMC", digits), 5),
        ("europepmc", "pmid", F.concat(F.lit("EXT_ID:"), pmid, F.lit(" AND SRC:MED")), 5),
        ("europepmc", "doi", asked.quoted("DOI", doi), 5),
        ("europepmc", "title", asked.quoted("TITLE", title), 5),
        ("crossref", "doi", doi, 1),
        ("crossref", "title", title, 5),
        ("core", "doi", asked.quoted("doi", doi), 3),
        ("core", "title", asked.core_title(title), 5),
        ("zenodo", "doi", asked.quoted("doi", doi), 3),
        ("zenodo", "doi_loose", named("doi:", doi), 3),
        ("zenodo", "title", asked.quoted("title", title), 5),
        ("doaj", "doi", asked.doaj_path(named("doi:", doi)), 3),
        ("doaj", "title", asked.doaj_path(asked.quoted("title", title)), 5),
    ]


def requests(papers: DataFrame, key: str = "paper_key") -> DataFrame:
    """One row per paper and possible request: ``provider kind step key most_hits``;
    ``step`` is its place among the provider's requests.  A paper without the
    identifier makes no such request."""
    steps: dict[str, int] = {}
    rows = []
    for provider, kind, asked_, most in _requests():
        steps[provider] = steps.get(provider, 0) + 1
        rows.append(F.struct(F.lit(provider).alias("provider"), F.lit(kind).alias("kind"), F.lit(steps[provider]).alias("step"), asked_.alias("key"), F.lit(most).alias("most_hits")))
    each = papers.select(F.col(key).alias("paper_key"), F.explode(F.array(*rows)).alias("r")).select("paper_key", "r.*")
    return each.where("key is not null and key <> ''")


def answered(asked_: DataFrame, answers: DataFrame) -> DataFrame:
    """The recorded answers of each request (``provider lookup_kind lookup_key hit_pos
    payload status error``), hits beyond the request's number left out, and of each
    provider only those of the first request that has any: a title is searched only
    where no identifier gave an answer.  ``exact`` tells the two apart."""
    known = answers.select("provider", F.col("lookup_kind").alias("kind"), F.col("lookup_key").alias("key"), "hit_pos", "payload", "status", "error")
    found = asked_.join(known, ["provider", "kind", "key"]).where(F.col("hit_pos") < F.col("most_hits"))
    usable = F.col("payload").isNotNull() & (F.coalesce("status", F.lit(200)) < 400)
    first = found.where(usable).groupBy("paper_key", "provider").agg(F.min("step").alias("__step"))
    kept = found.join(first, ["paper_key", "provider"], "left").where(F.col("__step").isNull() | (F.col("step") == F.col("__step")))
    return kept.withColumn("exact", F.col("kind") != "title").drop("__step")


def answer_state(status: Column, payload: Column, error: Column) -> Column:
    """answered, empty (404 is an answer) or failed, of one recorded response."""
    whole = F.try_parse_json(payload).isNotNull()
    return F.when(error.isNotNull() | (status >= 400) & (status != 404), "failed").when((status == 404) | payload.isNull(), "empty").when(~whole, "failed").otherwise("answered")


def answer_reason(provider: Column, status: Column, payload: Column, error: Column) -> Column:
    """Why a response failed; null where it did not, or its provider keeps none."""
    reason = F.when(error.isNotNull(), F.concat(F.lit("request failed: "), error)).when(status >= 400, F.concat(F.lit("http "), status.cast("string"))).otherwise("invalid json")
    return F.when((answer_state(status, payload, error) == "failed") & ~provider.isin(*SILENT), reason)


#: Identifiers of a record and how external ids name them (fixed values).
EXTERNAL = {"doi": "DOI", "dblp_id": "DBLP", "arxiv_id": "ArXiv", "acl_id": "ACL", "pmid": "PubMed", "pmcid": "PubMedCentral", "corpus_id": "CorpusId"}


def recovered_ids(external: Column, own: dict[str, Column]) -> dict[str, Column]:
    """The identifiers of a fetched record, from its external ids, else its own
    fields; a preprint's id also from the DOI or the bibliography key."""
    clean = {"doi": ids.doi, "arxiv_id": ids.arxiv, "pmcid": ids.pmcid_digits}
    out = {}
    for name, key in EXTERNAL.items():
        make = clean.get(name, blank_to_null)
        values = [make(F.try_element_at(external, F.lit(key)))] + ([make(own[name])] if name in own else [])
        out[name] = F.coalesce(*values)
    out["arxiv_id"] = F.coalesce(out["arxiv_id"], ids.arxiv_of_doi(out["doi"]), ids.arxiv_of_dblp(out["dblp_id"]))
    out["semantic_scholar_paper_id"] = blank_to_null(own["paperId"]) if "paperId" in own else F.lit(None).cast("string")
    return out


def enriched(papers: DataFrame, fetched: DataFrame) -> DataFrame:
    """Papers that have no title yet with the record fetched for their best
    identifier (``lookup_id title externalIds paperId``): fetched identifiers before
    supplied ones, and the key built anew.  Papers with a title, and those for which
    nothing was fetched, stay as they are."""
    names = ("semantic_scholar_paper_id", "corpus_id", "doi", "arxiv_id", "acl_id", "pmid", "pmcid", "mag_id")
    lookup = F.when(blank_to_null(F.col("title")).isNull(), F.lower(ids.lookup_id(*[F.col(n) for n in names])))
    stored = fetched.groupBy(F.lower("lookup_id").alias("__id")).agg(F.min_by(F.struct("title", "externalIds", "paperId"), F.struct("lookup_id", "paperId")).alias("__f"))
    joined = papers.withColumn("__id", lookup).join(stored, "__id", "left")
    new = recovered_ids(F.col("__f.externalIds"), {"paperId": F.col("__f.paperId")})
    got = F.col("__f").isNotNull()
    merged = {n: F.when(got, F.coalesce(new[n], F.col(n))).otherwise(F.col(n)) for n in (*EXTERNAL, "semantic_scholar_paper_id") if n in papers.columns}
    title = F.when(got, F.coalesce(F.col("__f.title"), F.col("title"))).otherwise(F.col("title"))
    out = joined.withColumns({**{f"__{n}": c for n, c in merged.items()}, "__title": title})
    rebuilt = ids.paper_key(F.col("__doi"), F.col("__arxiv_id"), F.col("__semantic_scholar_paper_id"), F.col("__corpus_id"), F.col("__title"))
    keep = {"title": F.col("__title"), **{n: F.col(f"__{n}") for n in merged}, "paper_key": F.when(got, rebuilt).otherwise(F.col("paper_key"))}
    return out.select(*[keep[c].alias(c) if c in keep else F.col(c) for c in papers.columns], got.alias("enriched"))

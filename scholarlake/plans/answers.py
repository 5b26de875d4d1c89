"""Answers of providers, made up from record ids, as candidates, and the chain over them.

``SPEC`` says for each provider what its answer holds (an expression over ``id`` and
``n``, the record's number modulo six) and, apart from that, which candidates must
come out; the SQL is built from the second part alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from scholarlake.operators import lookups, providers, resolve

#: Kinds of expected confidence: exact or title hit.
_BY = "case when exact then {0} else {1} end"
#: provider: (payload, [(condition, place, url, domain, version, host, confidence, direct, fallback, open)])
SPEC: dict[str, tuple[str, list[tuple[str, int, str, str, str, str, str, str, str, str]]]] = {
    "metadata_open_access": (
        "null",
        [
            ("n = 0", 0, "'https://europepmc.org/articles/PMC' || id || '?pdf=render'", "europepmc.org", "accepted", "repository", "0.85", "true", "false", "true"),
            ("n = 1", 0, "'https://arxiv.org/pdf/' || id", "arxiv.org", "preprint", "preprint", "0.85", "true", "false", "false"),
            ("n = 3", 0, "'https://www.nature.com/articles/' || id", "nature.com", "publisher", "publisher", "0.55", "false", "false", "false"),
            ("n = 4", 0, "'https://host.example/' || id || '.pdf'", "host.example", "unknown", "unknown", "0.85", "true", "false", "false"),
        ],
    ),
    "arxiv": ("null", [("true", 0, "'https://arxiv.org/pdf/' || arxiv_id", "arxiv.org", "preprint", "preprint", _BY.format(0.92, 0.80), "true", "false", "false")]),
    "acl": ("null", [("n in (2, 5)", 0, "'https://aclanthology.org/P' || id || '.pdf'", "aclanthology.org", "publisher", "publisher", "0.97", "true", "false", "false")]),
    "cvf": (
        "to_json(named_struct('links', array('https://openaccess.thecvf.com/' || id || '.pdf', 'https://openaccess.thecvf.com/' || id || '.html')))",
        [("true", 0, "'https://openaccess.thecvf.com/' || id || '.pdf'", "openaccess.thecvf.com", "publisher", "publisher", "0.9", "true", "false", "false")],
    ),
    "openalex": (
        """to_json(named_struct('ids', named_struct('pmcid', case when n = 0 then 'https://www.ncbi.nlm.nih.gov/pmc/articles/PMC' || id end),
            'best_oa_location', named_struct('pdf_url', case when n in (1, 2) then 'https://link.springer.com/' || id || '.pdf' end, 'landing_page_url', 'https://doi.org/10.1/' || id, 'version', case when n = 1 then 'publishedVersion' end, 'source', named_struct('type', 'Journal')),
            'primary_location', case when n in (3, 4) then named_struct('pdf_url', cast(null as string), 'landing_page_url', 'https://host.example/' || id, 'is_oa', n = 3) end,
            'locations', array(named_struct('pdf_url', case when n in (1, 2) then 'https://link.springer.com/' || id || '.pdf' when n = 5 then 'https://www.ncbi.nlm.nih.gov/pmc/articles/PMC' || id || '/pdf/' end, 'landing_page_url', cast(null as string))),
            'open_access', named_struct('is_oa', n = 1)))""",
        [
            ("n in (0, 5)", 0, "'https://europepmc.org/articles/PMC' || id || '?pdf=render'", "europepmc.org", "accepted", "repository", _BY.format(0.95, 0.74), "true", "false", "true"),
            ("n in (1, 2)", 0, "'https://link.springer.com/' || id || '.pdf'", "link.springer.com", "publisher", "publisher", _BY.format(0.95, 0.74), "true", "false", "n = 1"),
            ("n in (3, 4)", 0, "'https://host.example/' || id", "host.example", "unknown", "unknown", _BY.format(0.60, 0.45), "false", "false", "n = 3"),
        ],
    ),
    "unpaywall": (
        """to_json(named_struct('is_oa', n <> 0, 'best_oa_location', named_struct('url_for_pdf', case when n in (1, 2, 4) then 'https://www.nature.com/' || id || '.pdf' end, 'version', 'acceptedVersion', 'host_type', 'repository'),
            'oa_locations', array(named_struct('url_for_pdf', cast(null as string), 'url_for_landing_page', case when n in (0, 3, 4) then 'https://repo.example/' || id end, 'version', 'submittedVersion'))))""",
        [
            ("n in (1, 2, 4)", 0, "'https://www.nature.com/' || id || '.pdf'", "nature.com", "accepted", "repository", _BY.format(0.88, 0.68), "true", "false", "true"),
            ("n = 3", 0, "'https://repo.example/' || id", "repo.example", "preprint", "unknown", _BY.format(0.60, 0.45), "false", "false", "true"),
            ("n = 4", 1, "'https://repo.example/' || id", "repo.example", "preprint", "unknown", _BY.format(0.60, 0.45), "false", "false", "true"),
        ],
    ),
    "europepmc": (
        "to_json(named_struct('resultList', named_struct('result', array(named_struct('pmcid', 'PMC' || id, 'isOpenAccess', case when n % 2 = 0 then 'Y' else 'N' end, 'inEPMC', case when n = 1 then 'N' else 'Y' end, 'hasPDF', case when n = 2 then 'N' else 'y' end)))))",
        [("n not in (1, 2)", 0, "'https://europepmc.org/articles/PMC' || id || '?pdf=render'", "europepmc.org", "case when n % 2 = 0 then 'publisher' else 'accepted' end", "repository", _BY.format(0.87, 0.67), "true", "false", "true")],
    ),
    "crossref": (
        """to_json(named_struct('message', named_struct('link', array(
            named_struct('URL', 'https://x.example/' || id, 'content-type', 'text/html', 'content-version', '', 'intended-application', ''), named_struct('URL', 'https://qa.example/' || id || '.pdf', 'content-type', 'application/pdf', 'content-version', '', 'intended-application', ''),
            named_struct('URL', 'https://dl.acm.org/' || id || '.pdf', 'content-type', 'unspecified', 'content-version', element_at(array('vor', 'am', 'tdm', 'submitted', 'vor', 'other'), cast(n + 1 as int)), 'intended-application', case when n = 4 then 'similarity-checking' else 'text-mining' end)))))""",
        [("n <> 4", 0, "'https://dl.acm.org/' || id || '.pdf'", "dl.acm.org", "case when n in (0, 2) then 'publisher' when n = 1 then 'accepted' when n = 3 then 'preprint' else 'unknown' end", "publisher", _BY.format(0.82, 0.60), "true", "false", "false")],
    ),
    "core": (
        "to_json(named_struct('results', array(named_struct('downloadUrl', case when n < 4 then 'https://core.ac.uk/download/' || id || '.pdf' end, 'sourceFulltextUrls', case when n = 3 then array('https://u.example/' || id) end))))",
        [
            ("n < 4", 0, "'https://core.ac.uk/download/' || id || '.pdf'", "core.ac.uk", "accepted", "repository", _BY.format(0.80, 0.65), "true", "false", "false"),
            ("n = 3", 1, "'https://u.example/' || id", "u.example", "unknown", "unknown", _BY.format(0.80, 0.65), "false", "false", "false"),
        ],
    ),
    "zenodo": (
        """to_json(named_struct('hits', named_struct('hits', array(named_struct('metadata', named_struct('access_right', case when n = 0 then 'restricted' when n = 1 then null else 'Open' end, 'resource_type', named_struct('type', case when n = 3 then 'dataset' else 'publication' end)),
            'access', named_struct('files', case when n = 1 then 'public' end), 'files', case when n <> 4 then array(named_struct('key', 'small.pdf', 'size', 5, 'links', named_struct('self', 'https://zenodo.org/' || id || '/small')),
                named_struct('key', 'Large.PDF', 'size', 9, 'links', named_struct('self', 'https://zenodo.org/' || id || '/large')), named_struct('key', 'data.zip', 'size', 99, 'links', named_struct('self', 'https://zenodo.org/' || id || '/zip'))) end)))))""",
        [("n not in (0, 4)", 0, "'https://zenodo.org/' || id || '/large'", "zenodo.org", "accepted", "repository", _BY.format(0.78, 0.60), "true", "false", "false")],
    ),
    "doaj": (
        "to_json(named_struct('results', array(named_struct('bibjson', named_struct('link', array(named_struct('type', 'homepage', 'url', 'https://h.example/' || id), named_struct('type', 'fulltext', 'url', 'https://www.mdpi.com/' || id || case when n < 3 then '.pdf' else '' end)))))))",
        [("true", 0, "'https://www.mdpi.com/' || id || case when n < 3 then '.pdf' else '' end", "mdpi.com", "publisher", "publisher", _BY.format(0.82, 0.62), "n < 3", "false", "true")],
    ),
    "wiley": ("null", [("n in (0, 3)", 0, "'https://api.wiley.com/onlinelibrary/tdm/v1/articles/10.1034%2Fw%20' || id", "api.wiley.com", "publisher", "publisher", "0.93", "true", "false", "false")]),
    "elsevier": ("null", [("n = 1", 0, "'https://api.elsevier.com/content/article/doi/10.5555/E%28' || id || '%29'", "api.elsevier.com", "publisher", "publisher", "0.93", "true", "false", "false")]),
    "broad_search": (
        "to_json(named_struct('links', array('https://arxiv.org/' || id || '.pdf', 'https://test.example/' || id || '.pdf', 'https://w.example/' || id)))",
        [("true", 0, "'https://arxiv.org/' || id || '.pdf'", "arxiv.org", "preprint", "preprint", "0.62", "true", "false", "false")],
    ),
    "openalex_content": (
        "to_json(named_struct('has_content', named_struct('pdf', n < 3), 'content_urls', named_struct('pdf', 'https://content.openalex.org/' || id || '.pdf?api_key=secret')))",
        [("n < 3", 0, "'https://content.openalex.org/' || id || '.pdf'", "content.openalex.org", "publisher", "repository", "0.88", "true", "true", "true")],
    ),
    "publisher_landing": (
        "to_json(named_struct('message', named_struct('resource', named_struct('primary', named_struct('URL', case when n <> 5 then 'https://ieeexplore.ieee.org/' || id end)))))",
        [("n <> 5", 0, "'https://ieeexplore.ieee.org/' || id", "ieeexplore.ieee.org", "publisher", "publisher", "0.5", "false", "true", "false")],
    ),
}
#: What providers read of the paper itself, in both dialects.
_PAPER = (
    "concat('r', record_id) as paper_key",
    "concat('', record_id) as id",
    "record_id % 6 as n",
    "record_id % 2 = 0 as exact",
    "case when record_id % 2 = 0 then null when record_id % 6 < 3 then 0.95 else 0.85 end as title_match_score",
    """case record_id % 6 when 0 then concat('10.1034/w ', record_id) when 1 then concat('10.5555/E(', record_id, ')') when 2 then concat('10.18653/v1/P', record_id)
        when 3 then concat('10.1034/w ', record_id) when 4 then concat('10.1049/x', record_id) end as doi""",
    "concat('2001.', record_id) as arxiv_id",
    "case when record_id % 6 = 5 then concat('P', record_id) end as acl_id",
    """case record_id % 6 when 0 then concat('https://www.ncbi.nlm.nih.gov/pmc/articles/PMC', record_id) when 1 then concat('https://arxiv.org/pdf/', record_id) when 2 then concat('https://doi.org/10.1/', record_id)
        when 3 then concat('https://www.nature.com/articles/', record_id) when 4 then concat('https://host.example/', record_id, '.pdf') end as open_url""",
)
DENIED = ("nature.com",)
_COLUMNS = ("paper_key", "cand_pos", "pdf_url", "domain", "version_type", "host_type", "confidence", "is_direct_pdf", "fallback_only", "asserts_open_access")


def answers(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> DataFrame:
    """An answer of each provider for each record."""
    papers = spark.read.parquet(f"{sf_dir}/paper_records.parquet").selectExpr(*_PAPER)
    rows = None
    for name in names or SPEC:
        mine = papers.withColumns({"provider": F.lit(name), "payload": F.expr(SPEC[name][0]).cast("string"), "hit_pos": F.lit(0)})
        rows = mine if rows is None else rows.unionByName(mine)
    return rows


def _provider(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return providers.candidates(answers(spark, sf_dir, [name]), [name]).select(*_COLUMNS)

    return query


def _chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve.denied(resolve.by_url(providers.candidates(answers(spark, sf_dir), [*providers.PROVIDERS, "no_such_provider"])), DENIED)
    return resolve.rounds(found.withColumn("score", resolve.score()).withColumn("good", resolve.good_enough(avoided=DENIED)))


def _ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.ranked(_chain(spark, sf_dir)).select("paper_key", "round", "rank", "provider", "pdf_url", "score", "fallback_only")


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    papers = spark.read.parquet(f"{sf_dir}/paper_records.parquet").withColumn("paper_key", F.concat(F.lit("r"), "record_id"))
    return lookups.requests(papers).groupBy("provider", "kind", "step").agg(F.count("*").alias("n"), F.count_distinct("key").alias("keys"))


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded responses: an error, statuses, and payloads that are no JSON."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", (F.col("event_id") % 7).alias("k"), (F.col("event_id") % 3).alias("m"))
    status = F.when(F.col("k") == 1, 404).when(F.col("k") == 2, 503).when(F.col("k") == 3, 429).when(F.col("k") != 0, 200)
    payload = F.when(F.col("k") == 4, "{broken").when(F.col("k") == 5, '{"results": []}').when(F.col("k") == 6, F.lit(None).cast("string"))
    provider = F.element_at(F.array(F.lit("openalex"), F.lit("core"), F.lit("crossref")), (F.col("m") + 1).cast("int"))
    e = e.select("event_id", provider.alias("provider"), status.alias("status"), payload.alias("payload"), F.when(F.col("k") == 0, "Timeout").alias("error"))
    args = [F.col(c) for c in ("status", "payload", "error")]
    return e.select("event_id", lookups.answer_state(*args).alias("state"), lookups.answer_reason(F.col("provider"), *args).alias("reason"))


def _answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of all records against stored answers: those of DOIs for even records,
    those of titles for all."""
    papers = spark.read.parquet(f"{sf_dir}/paper_records.parquet").withColumn("paper_key", F.concat(F.lit("r"), "record_id")).select("paper_key", "record_id", "doi", "title", "arxiv_id", "pmcid", "pmid")
    asked = lookups.requests(papers).where("provider in ('crossref', 'unpaywall')")
    stored = lookups.requests(papers.where("record_id % 2 = 0")).where("provider in ('crossref', 'unpaywall')").select("provider", "kind", "key").distinct()
    hits = stored.select("provider", F.col("kind").alias("lookup_kind"), F.col("key").alias("lookup_key"), F.explode(F.sequence(F.lit(0), F.lit(6))).alias("hit_pos"), F.lit("{}").alias("payload"), F.when(F.col("provider") == "unpaywall", 404).otherwise(200).alias("status"), F.lit(None).cast("string").alias("error"))
    return lookups.answered(asked, hits).groupBy("provider", "kind", "exact").agg(F.count("*").alias("answers"), F.count_distinct("paper_key").alias("papers"))


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records stripped to an identifier, with those of their work fetched for it."""
    r = spark.read.parquet(f"{sf_dir}/paper_records.parquet").where("nullif(trim(doi), '') is not null and doi like '10.%'")
    bare = r.withColumn("title", F.when(F.col("record_id") % 4 == 0, F.lit(None)).otherwise(F.col("title"))).withColumns({c: F.lit(None).cast("string") for c in ("semantic_scholar_paper_id", "corpus_id", "arxiv_id", "dblp_id")})
    fetched = r.where("record_id % 3 <> 0").select(F.concat(F.lit("DOI:"), "doi").alias("lookup_id"), F.concat(F.lit("T "), "doi").alias("title"), F.create_map(F.lit("DOI"), F.col("doi"), F.lit("CorpusId"), F.concat(F.lit("c"), F.lower("doi")), F.lit("DBLP"), F.lit("journals/corr/abs-2001-01234")).alias("externalIds"), F.concat(F.lit("p"), F.lower("doi")).alias("paperId"))
    out = lookups.enriched(bare, fetched)
    return out.select("record_id", "enriched", "corpus_id", "arxiv_id", "semantic_scholar_paper_id", F.coalesce(F.lower("title"), F.lit("")).alias("title"), F.when(F.col("enriched"), F.col("paper_key")).alias("new_key"))


QUERIES = {
    **{f"provider_{name}": _provider(name) for name in SPEC},
    "answers_resolved": _ranked,
    "lookup_requests": _requests,
    "lookup_answers": _answered,
    "response_states": _responses,
    "id_only_enriched": _enriched,
}
_LITERALS = {"accepted", "preprint", "publisher", "unknown", "repository"}


def _expected(name: str) -> str:
    """The candidates that must come out of a provider's answers."""
    quote = lambda v: f"'{v}'" if v in _LITERALS else v
    parts = [f"select paper_key, {place}::bigint as cand_pos, {url} as pdf_url, '{domain}' as domain, {quote(version)} as version_type, {quote(host)} as host_type, ({confidence})::double as confidence, {direct} as is_direct_pdf, {fallback} as fallback_only, {open_} as asserts_open_access, title_match_score::double as title_match_score from p where {condition}" for condition, place, url, domain, version, host, confidence, direct, fallback, open_ in SPEC[name][1]]
    return " union all ".join(parts)


_P = f"p as (select {', '.join(_PAPER)} from paper_records)"
_TRUSTED = "domain in ('arxiv.org', 'aclanthology.org', 'openaccess.thecvf.com', 'content.openalex.org', 'api.wiley.com', 'api.elsevier.com', 'dl.acm.org', 'ieeexplore.ieee.org', 'link.springer.com', 'nature.com', 'europepmc.org', 'zenodo.org', 'core.ac.uk', 'mdpi.com')"
_ORDER = ("metadata_open_access", "arxiv", "acl", "cvf", "openalex", "unpaywall", "europepmc", "crossref", "core", "zenodo", "doaj", "wiley", "elsevier", "broad_search", "openalex_content", "publisher_landing")
_CHAIN = f"""with {_P}, c as ({' union all '.join(f"select '{n}' provider, {i} provider_rank, * from ({_expected(n)})" for i, n in enumerate(_ORDER, 1))}),
    u as (select *, row_number() over (partition by paper_key, pdf_url order by confidence desc, provider_rank, cand_pos) rn, first_value(row(provider_rank, cand_pos)) over (partition by paper_key, pdf_url order by provider_rank, cand_pos) seen from c),
    s as (select * exclude (fallback_only), fallback_only or domain = 'nature.com' fallback_only, {_TRUSTED} trusted, round(case when is_direct_pdf then 0.2 else 0 end + case when {_TRUSTED} then 0.2 else 0 end + case version_type when 'publisher' then 0.3 when 'accepted' then 0.2 when 'preprint' then 0.1 else 0 end
        + case host_type when 'publisher' then 0.1 when 'repository' then 0.05 else 0 end + case when title_match_score is null then 0 when title_match_score >= 0.9 then 0.1 else -0.2 end + 0.1 * confidence, 6) score from u where rn = 1),
    g as (select *, domain <> 'nature.com' and not fallback_only and is_direct_pdf and score >= 0.75 and trusted and version_type = 'publisher' good from s),
    q as (select paper_key, provider_rank, (1 + coalesce(sum(max(good)::int) over (partition by paper_key order by provider_rank rows between unbounded preceding and 1 preceding), 0))::int round from g group by paper_key, provider_rank)
    select paper_key, round, row_number() over (partition by paper_key, round order by fallback_only, (version_type = 'publisher') desc, is_direct_pdf desc, (host_type = 'publisher') desc, score desc, seen)::int as rank, provider, pdf_url, score, fallback_only from g join q using (paper_key, provider_rank)"""
_DOI = r"lower(nullif(regexp_replace(nullif(regexp_extract(replace(trim(doi), '\', ''), '(10\.\d{4,9}/\S+)', 1), ''), '[ .;,)]+$', ''), ''))"
_T = "nullif(trim(title), '')"
_ARX = r"""nullif(regexp_extract(trim(arxiv_id), '([A-Za-z\-]+/\d{7}|\d{4}\.\d{4,5})', 1), '')"""
_PMC = r"nullif(regexp_extract(trim(pmcid), '(?i)^(?:PMC)?(\d+)$', 1), '')"
_CLEAN = "nullif(trim(regexp_replace(regexp_replace(title, '[^A-Za-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g')), '')"
_ASKED = (
    ("arxiv", "id", 1, _ARX), ("arxiv", "title", 2, f"'ti:' || case when {_T} is null then null else coalesce({_CLEAN}, '') end"), ("openalex", "doi", 1, _DOI), ("openalex", "title", 2, _T), ("unpaywall", "doi", 1, _DOI), ("unpaywall", "title", 2, _T),
    ("europepmc", "pmcid", 1, _PMC), ("europepmc", "pmid", 2, "nullif(trim(pmid), '')"), ("europepmc", "doi", 3, _DOI), ("europepmc", "title", 4, _T), ("crossref", "doi", 1, _DOI), ("crossref", "title", 2, _T),
    ("core", "doi", 1, _DOI), ("core", "title", 2, f"replace({_T}, '\"', ' ')"), ("zenodo", "doi", 1, _DOI), ("zenodo", "doi_loose", 2, _DOI), ("zenodo", "title", 3, _T), ("doaj", "doi", 1, _DOI), ("doaj", "title", 2, _T),
)
ORACLES = {
    **{f"provider_{name}": f"with {_P} select * exclude (title_match_score) from ({_expected(name)})" for name in SPEC},
    "answers_resolved": _CHAIN,
    "lookup_requests": " union all ".join(f"select '{p}' as provider, '{k}' as kind, {i} as step, count({key}) as n, count(distinct {key}) as keys from paper_records" for p, k, i, key in _ASKED),
    "lookup_answers": f"""with r as (select record_id, {_DOI} d, {_T} t from paper_records), a as (select d, t from r where record_id % 2 = 0), ad as (select distinct d from a where d is not null), tt as (select distinct t from a where t is not null),
        j as (select record_id, d in (select d from ad) is true hd, t in (select t from tt) is true ht from r)
        select 'crossref' as provider, 'doi' as kind, true as exact, count(*)::bigint as answers, count(*) as papers from j where hd union all select 'crossref', 'title', false, 5 * count(*), count(*) from j where not hd and ht
        union all select 'unpaywall', 'doi', true, count(*), count(*) from j where hd union all select 'unpaywall', 'title', false, 5 * count(*), count(*) from j where ht""",
    "response_states": """with e as (select event_id, event_id % 7 k, event_id % 3 m from events) select event_id, case k when 0 then 'failed' when 1 then 'empty' when 2 then 'failed' when 3 then 'failed' when 4 then 'failed' when 5 then 'answered' else 'empty' end as state,
        case when m = 1 then null when k = 0 then 'request failed: Timeout' when k = 2 then 'http 503' when k = 3 then 'http 429' when k = 4 then 'invalid json' end as reason from e""",
    "id_only_enriched": r"""with r as (select record_id, lower(doi) d, case when record_id % 4 = 0 or nullif(trim(title), '') is null then null else title end title, nullif(trim(title), '') is null blank from paper_records where nullif(trim(doi), '') is not null and doi like '10.%'),
        f as (select lower(doi) d, min(doi) first_doi from paper_records where record_id % 3 <> 0 and doi like '10.%' group by 1), j as (select r.*, f.d is not null and (record_id % 4 = 0 or blank) got from r left join f using (d))
        select record_id, got as enriched, case when got then 'c' || d end as corpus_id, case when got then '2001.01234' end as arxiv_id, case when got then 'p' || d end as semantic_scholar_paper_id,
            case when got then 't ' || d when record_id % 4 = 0 then '' else lower(coalesce((select title from paper_records x where x.record_id = j.record_id limit 1), '')) end as title,
            case when got then 'doi__' || coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(d, '[ .;,)]+$', ''), '[^A-Za-z0-9._-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g'), ''), 'unknown') end as new_key from j""",
}

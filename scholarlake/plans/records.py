"""Identifiers, classification, graph, bundle, recovery and search queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from scholarlake.functions import ids, text, urls
from scholarlake.operators import bundle, classify, graph, identity, joins, outcomes, recovery, search


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _id_forms(s, d):
    r = _t(s, d, "paper_records")
    key = ids.paper_key(F.col("doi"), F.col("arxiv_id"), F.col("semantic_scholar_paper_id"), F.col("corpus_id"), F.col("title"))
    return r.select("record_id", ids.doi(F.col("doi")).alias("doi"), ids.doi_key(F.concat(F.lit("https://doi.org/"), "doi")).alias("doi_key"), ids.arxiv_any(F.col("arxiv_id"), F.col("doi"), F.col("dblp_id")).alias("arxiv"), ids.pmcid(F.col("pmcid")).alias("pmcid"), key.alias("key"))


def _lookup(s, d):
    r = _t(s, d, "paper_records")
    names = ("semantic_scholar_paper_id", "corpus_id", "doi", "arxiv_id", "acl_id", "pmid", "pmcid", "mag_id")
    return r.select("record_id", ids.lookup_id(*[F.col(n) for n in names]).alias("lookup"))


def _kinds(s, d):
    raw = _t(s, d, "paper_records").select("record_id", F.coalesce("input_value", "doi", F.concat(F.lit("arXiv:"), "arxiv_id"), F.concat(F.lit("PMID:"), "pmid"), "corpus_id", "title", F.lit("")).alias("raw"))
    batch, graph_ = ids.batch_id(F.col("raw")), ids.graph_id(F.col("raw"))
    return raw.select("record_id", ids.kind_of_input(F.col("raw")).alias("kind"), batch.alias("batch"), graph_.alias("graph"), ids.id_error(F.col("raw"), graph_).alias("error"))


def _hosts(s, d):
    u = F.col("openAccessPdf.url")
    p = _t(s, d, "search_papers").where(u.isNotNull())
    h = urls.host(u)
    return p.select("cat", "pos", urls.domain(u).alias("domain"), h.alias("host"), F.element_at(urls.suffixes(h), -1).alias("top"), F.size(urls.suffixes(h)).alias("depth"), urls.host_type(urls.domain(u)).alias("host_type"), urls.is_pdf_url(u).alias("is_pdf"), urls.is_staging(u).alias("staging"))


def _venues(s, d):
    """The venue; else its first alternate name of ten characters or less, else its name."""
    p = _t(s, d, "search_papers")
    short = F.get(F.filter("publicationVenue.alternate_names", lambda x: F.length(F.trim(x)) <= 10), 0)
    authors = F.filter(F.transform("authors", lambda a: F.trim(a["name"])), lambda n: F.coalesce(n, F.lit("")) != "")
    return p.select("cat", "pos", F.coalesce(text.blank_to_null(F.col("venue")), text.blank_to_null(short), text.blank_to_null(F.col("publicationVenue.name"))).alias("venue"), F.array_join(authors, "; ").alias("authors"), text.blank_to_null(F.col("openAccessPdf.url")).alias("open_url"))


def _surnames(s, d):
    r, h = _t(s, d, "paper_records"), _t(s, d, "arxiv_hits")
    one = r.select("record_id", text.match_title(F.col("title")).alias("k"), F.col("authors").alias("a"), "year").where("k <> ''")
    two = h.select("hit_id", text.match_title(F.col("title")).alias("k"), F.col("authors").alias("b"), F.col("year").alias("y"))
    return one.join(two, "k").select("record_id", "hit_id", ids.surname_overlap(F.col("a"), F.col("b")).alias("shared"), joins.year_close(F.col("year"), F.col("y"), 2, 1).alias("close"))


def _records(s, d):
    """Registered works made up from record ids, to drive the cascade."""
    r = _t(s, d, "paper_records")
    n = F.col("record_id") % 23
    pick = lambda *v: F.element_at(F.array(*[F.lit(x).cast("string") for x in v]), (n % len(v) + 1).cast("int"))
    work = F.struct(
        F.when(n == 3, "10.26226/m.1").otherwise(F.col("doi")).alias("DOI"), F.when(n == 5, "posted-content").when(n == 6, "journal-issue").when(n == 7, "dataset").otherwise("journal-article").alias("type"), F.when(n == 5, "other").alias("subtype"), F.col("title").alias("title"),
        pick("Annual Meeting Abstracts", "Journal of Data", None).alias("container_title"), pick("3", "Suppl 1", None, "Supplement").alias("issue"),
        F.when(n == 9, F.array(F.lit("Correction"))).when(n == 10, F.array(F.lit("retraction_notice"))).alias("update_to"), F.when(n % 3 == 0, F.array(F.col("year"), F.lit(4))).alias("online"), F.when(n % 3 == 1, F.array(F.col("year"))).alias("published"), F.array(F.col("year"), F.lit(12), F.lit(31)).alias("issued"))
    indexed = F.struct(F.when(n == 11, "conference-abstract").when(n == 12, "libguides").otherwise("article").alias("type"), F.col("title").alias("display_name"), (n == 13).alias("is_paratext"), (n == 14).alias("is_retracted"))
    title = F.when(n == 15, F.concat(F.lit("Abstract CT"), F.col("record_id"), F.lit(": "), F.coalesce("title", F.lit("")))).when(n == 16, F.concat(F.lit("Erratum: "), F.coalesce("title", F.lit("")))).otherwise(F.col("title"))
    return r.select("record_id", title.alias("title"), work.alias("crossref"), indexed.alias("openalex"))


def _pages(s, d):
    li = _t(s, d, "lineitem")
    a, b = F.col("l_partkey"), F.col("l_partkey") + F.col("l_quantity").cast("int")
    shape = F.when(F.col("l_linenumber") == 1, F.concat(a, F.lit("-"), b)).when(F.col("l_linenumber") == 2, F.concat(a, F.lit("–"), F.substring(b.cast("string"), -2, 2))).when(F.col("l_linenumber") == 3, F.concat(F.lit("e"), a)).when(F.col("l_linenumber") == 4, a.cast("string")).when(F.col("l_linenumber") == 5, F.concat(b, F.lit("-"), a)).otherwise("n.d.")
    return li.select(shape.alias("pages")).distinct().select("pages", identity.page_count(F.col("pages")).alias("n_pages"))


def _edges(s, d):
    li, o = _t(s, d, "lineitem"), _t(s, d, "orders")
    e = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    return e.select(F.concat(F.lit("c"), "o_custkey").alias("seed"), F.when(F.col("l_returnflag") == "R", "reference").otherwise("citation").alias("edge_type"), F.concat_ws("|", F.lpad("l_orderkey", 12, "0"), F.col("l_linenumber").cast("string"), F.lpad("l_partkey", 12, "0"), F.lpad("l_suppkey", 12, "0"), F.col("l_extendedprice").cast("decimal(20,2)").cast("string")).alias("pos"), (F.col("l_quantity") > 25).alias("is_influential"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("publication_date"))


def _seeds(s, d):
    c = _t(s, d, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("seed"))
    e = _edges(s, d)
    return graph.per_seed(c, e, graph.edges(e, influential_only=True, max_results=5, since="1995-01-01"))


def _asked(s, d):
    p = _t(s, d, "search_papers")
    raw = F.when(F.col("pos") % 7 == 3, F.concat(F.lit("no such id "), "pos")).when(F.col("pos") % 7 == 5, F.lpad(F.hex("pos"), 40, "0")).otherwise(F.coalesce("paperId", F.lit("")))
    asked = p.select((F.col("cat_pos").cast("bigint") * 100_000_000 + F.col("pos")).alias("input_pos"), raw.alias("raw"))
    stored = p.where(text.blank_to_null(F.col("paperId")).isNotNull()).groupBy(F.trim("paperId").alias("lookup_id")).agg(F.max("year").alias("year"))
    return graph.fetch_by_id(asked, stored)


def _bundle(s, d):
    p = _t(s, d, "search_papers")
    prov = bundle.provenance(matched=F.when(F.col("pos") % 50 == 1, F.array().cast("array<string>")).when(F.col("pos") % 50 == 2, F.array(F.lit("nobody"))).otherwise(F.array("cat")))
    return p.select((F.col("cat_pos").cast("bigint") * 100_000_000 + F.col("pos")).alias("idx"), "paperId", "externalIds", prov.alias("_provenance"))


def _violations(s, d):
    names = [r.id for r in _asked_queries(s, d)]
    return bundle.violations(_bundle(s, d), "keyword_search", names).select("idx", "violation")


def _hits(s, d):
    """Stored passages as hits of abstract sources for the records they belong to."""
    doc = _t(s, d, "documents").where("section = 'abstract' and paper_key is not null")
    route = F.element_at(F.array(*[F.lit(x) for x in ("arxiv", "crossref", "openalex_doi", "openalex_title", "core", "pubmed", "acl")]), (F.col("doc_id") % 7 + 1).cast("int"))
    return doc.select(F.col("paper_key").alias("paperId"), route.alias("route"), (F.length("paper_key") % 2 == 0).alias("has_arxiv"), ((F.col("doc_id") % 10) / 10.0).alias("title_score"), "text")


def _filled(s, d):
    r = _t(s, d, "paper_records").select("record_id", F.col("paper_key").alias("paperId"), "abstract", "doi", F.col("venue").alias("cat"))
    return recovery.filled(r, _hits(s, d))


def _publishers(s, d):
    r = _t(s, d, "paper_records").select("record_id", F.coalesce(F.col("abstract_source"), F.lit("")).alias("src"), "abstract", "doi", F.coalesce("venue", F.lit("")).alias("cat"))
    r = r.withColumn("abstract_source", F.when(F.col("src").startswith("scrape:"), F.col("src")).when(text.blank_to_null(F.col("abstract")).isNotNull(), "original"))
    return recovery.by_publisher(r).select(F.coalesce("cat", F.lit("TOTAL")).alias("cat"), "publisher", F.col("missing").cast("bigint").alias("missing"), F.col("recovered").cast("bigint").alias("recovered"))


def _asked_queries(s, d, most: int = 10_000):
    """The queries of a query table; they become part of the plan, so their number is checked."""
    rows = _t(s, d, "search_queries").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} queries cannot be one plan")
    return rows


def _search(s, d):
    q = [(r.id, r.cat_pos, r.query, r.params) for r in _asked_queries(s, d)]
    return search.run_queries(_t(s, d, "search_papers"), q).select("cat", "pos", "query")


def _fuzzy(s, d):
    h, r = _t(s, d, "arxiv_hits"), _t(s, d, "paper_records").where("title is not null")
    year = [F.coalesce("year", F.lit(0))]
    return joins.similar_titles(h, "hit_id", "title", r, "record_id", "title", year, year)


def _enriched(s, d):
    r = _t(s, d, "paper_records")
    results = _t(s, d, "documents").where("paper_key is not null").select("paper_key", F.col("doc_id").alias("result_pos"), F.col("source").alias("found_in"), F.col("section").alias("found_section"))
    own = ids.paper_key(F.col("doi"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.col("title"))
    return joins.first_key(r.select("record_id", "paper_key", "doi", "title"), "record_id", [F.col("paper_key"), own], results, [F.col("paper_key")], ["found_in", "found_section"]).select("record_id", "found_in", "found_section")


def _identity(s, d):
    r = _t(s, d, "paper_records").groupBy("paper_key").agg(F.max("title").alias("title"), F.max("doi").alias("doi"), F.max("arxiv_id").alias("arxiv_id"))
    doc = _t(s, d, "documents").join(r, "paper_key")
    t = doc.select("doc_id", "doi", "arxiv_id", "title", F.lit("1-12").alias("page_range"), F.lit(None).cast("string").alias("source_url"), F.col("text").alias("front_text"), F.col("text").alias("title_text"), (F.col("doc_id") % 14).alias("n_pages"), F.lit(None).cast("string").alias("embedded_title"))
    return identity.verified(t).select("doc_id", "state", "signal")


def _meta_text(s, d):
    doc = _t(s, d, "documents")
    return doc.select("doc_id", text.clean_abstract(F.col("text")).alias("abstract"))


def _stages(s, d):
    e = _t(s, d, "events").select("user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "event_id")
    return outcomes.latest(e.withColumn("value", F.col("event_id")), ["user_id", "event_type"], "us", "value").select("user_id", "event_type", F.col("value").alias("last_event"), "events")


QUERIES = {
    "id_forms": _id_forms,
    "lookup_ids": _lookup,
    "id_kinds": _kinds,
    "url_hosts": _hosts,
    "venues_and_authors": _venues,
    "publisher_of_doi": lambda s, d: _t(s, d, "paper_records").groupBy(urls.publisher_of_doi(F.col("doi")).alias("publisher")).agg(F.count("*").alias("n")),
    "surname_overlap": _surnames,
    "record_classes": lambda s, d: classify.classified(_records(s, d)).select("record_id", "record_class", "retracted", "published_online", "terminal"),
    "page_counts": _pages,
    "graph_edges": lambda s, d: graph.edges(_edges(s, d), influential_only=True, max_results=5, since="1995-01-01").select("seed", "edge_type", "pos"),
    "graph_seeds": _seeds,
    "graph_summary": lambda s, d: graph.summary(_seeds(s, d)),
    "fetch_by_id": lambda s, d: _asked(s, d).select("input_pos", "chunk", "fetch_status", F.coalesce("year", F.lit(-1)).alias("year")),
    "fetch_status": lambda s, d: _asked(s, d).groupBy("fetch_status").agg(F.count("*").alias("n")),
    "bundle_violations": _violations,
    "bundle_counts": lambda s, d: bundle.counts(bundle.admitted(_bundle(s, d), "keyword_search")),
    "bundle_per_query": lambda s, d: bundle.per_query(_bundle(s, d)),
    "abstracts_filled": lambda s, d: _filled(s, d).select("record_id", "abstract_source", F.coalesce(F.length("abstract"), F.lit(-1)).alias("n")),
    "recovery_by_source": lambda s, d: recovery.by_source(_filled(s, d)),
    "recovery_by_publisher": _publishers,
    "keyword_search": _search,
    "preview_counts": lambda s, d: _t(s, d, "search_papers").groupBy("cat").agg(F.count("*").alias("total")),
    "similar_titles": _fuzzy,
    "enriched_records": _enriched,
    "identity_verdicts": _identity,
    "clean_abstracts": _meta_text,
    "latest_events": _stages,
}
_B = r"nullif(trim({0}), '')"
_MATCH = r"trim(regexp_replace(regexp_replace(lower(trim(coalesce({0}, ''))), '[^a-z0-9" + r"\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x0B\x1C-\x1F" + r"]+', ' ', 'g'), '[" + r"\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x0B\x1C-\x1F" + r"]+', ' ', 'g'))"
_DOI = r"lower(nullif(regexp_replace(nullif(regexp_extract(replace(trim({0}), '\', ''), '(10\.\d{{4,9}}/\S+)', 1), ''), '[ .;,)]+$', ''), ''))"
_SAFE = r"coalesce(nullif(regexp_replace(regexp_replace({0}, '[^A-Za-z0-9._-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g'), ''), 'unknown')"
_AX = r"nullif(regexp_extract(trim({0}), '([A-Za-z\-]+/\d{{7}}|\d{{4}}\.\d{{4,5}})', 1), '')"
_KEY = f"""case when {_DOI.format('doi')} is not null then 'doi__' || {_SAFE.format(_DOI.format('doi'))} when {_AX.format('arxiv_id')} is not null then 'arxiv__' || {_SAFE.format(_AX.format('arxiv_id'))} when {_B.format('semantic_scholar_paper_id')} is not null then 'ss__' || {_SAFE.format(_B.format('semantic_scholar_paper_id'))} when {_B.format('corpus_id')} is not null then 'corpus__' || {_SAFE.format(_B.format('corpus_id'))} else 'title__' || substr(sha1(coalesce(nullif({_MATCH.replace('{0}', 'title')}, ''), 'unknown')), 1, 16) end"""
_RAW = "r as (select record_id, trim(coalesce(input_value, doi, 'arXiv:' || arxiv_id, 'PMID:' || pmid, corpus_id, title, '')) raw from paper_records)"
_GRAPH = r"""case when contains(raw, ':') and upper(split_part(raw, ':', 1)) in ('DOI', 'ARXIV', 'MAG', 'ACL', 'PMID', 'PMCID', 'CORPUSID', 'URL') then case when upper(split_part(raw, ':', 1)) = 'CORPUSID' then 'CorpusId' else upper(split_part(raw, ':', 1)) end || ':' || regexp_replace(raw, '^[^:]*:', '')
    when regexp_matches(raw, '^\d+$') then null when regexp_matches(raw, '^[0-9a-fA-F]{40}$') then raw when regexp_matches(raw, '^10\.\d{4,9}/\S+$') then 'DOI:' || raw when regexp_matches(raw, '^([A-Za-z\-]+/\d{7}|\d{4}\.\d{4,5})(v\d+)?$') then 'ARXIV:' || raw when regexp_matches(raw, '(?i)^https?://\S+$') then 'URL:' || raw end"""
_KIND = r"""case when regexp_matches(raw, '(?i)^(https?://(dx\.)?doi\.org/|doi:\s*)?10\.\d{4,9}/\S+$') then 'doi' when regexp_matches(raw, '(?i)^(https?://arxiv\.org/(abs|pdf)/|arxiv:\s*)?([A-Za-z\-]+/\d{7}|\d{4}\.\d{4,5})(v\d+)?(\.pdf)?$') then 'arxiv'
    when lower(raw) like 'corpusid:%' then 'corpus_id' when regexp_matches(raw, '^[0-9a-fA-F]{40}$') then 'semantic_scholar_paper_id' when lower(raw) like 'pmcid:%' then 'pmcid' when lower(raw) like 'pmid:%' then 'pmid' when lower(raw) like 'mag:%' then 'mag' when lower(raw) like 'acl:%' then 'acl_id' else 'title_or_unknown' end"""
_BATCH = r"""case when regexp_matches(upper(raw), '^(DOI|ARXIV|MAG|ACL|PMID|PMCID|CORPUSID):') then raw when raw like '10.%' and contains(raw, '/') then 'DOI:' || raw when regexp_matches(raw, '^\d{4}\.\d{4,5}(v\d+)?$') then 'ARXIV:' || raw when regexp_matches(raw, '^[0-9a-fA-F]{40}$') then raw end"""
_E = """e as (select 'c' || o_custkey seed, case when l_returnflag = 'R' then 'reference' else 'citation' end edge_type, lpad(l_orderkey::varchar, 12, '0') || '|' || l_linenumber || '|' || lpad(l_partkey::varchar, 12, '0') || '|' || lpad(l_suppkey::varchar, 12, '0') || '|' || l_extendedprice::decimal(20,2)::varchar pos,
        l_quantity > 25 is_influential, strftime(l_shipdate, '%Y-%m-%d') publication_date from lineitem join orders on l_orderkey = o_orderkey),
    k as (select * from (select *, row_number() over (partition by seed, edge_type order by pos) nth from e) where nth <= 5 and is_influential and (edge_type <> 'citation' or publication_date >= '1995-01-01'))"""
_SEEDS = f"""{_E}, rw as (select seed, count(*) filter (edge_type = 'citation') rc, count(*) filter (edge_type = 'reference') rr from e group by 1), kp as (select seed, count(*) filter (edge_type = 'citation') kc, count(*) filter (edge_type = 'reference') kr from k group by 1),
    sd as (select 'c' || c_custkey seed, coalesce(rc, 0) raw_citations, coalesce(rr, 0) raw_references, coalesce(kc, 0) citations, coalesce(kr, 0) "references" from customer left join rw on rw.seed = 'c' || c_custkey left join kp on kp.seed = 'c' || c_custkey)"""
_ASK = r"""a as (select cat_pos * 100000000::bigint + pos input_pos, trim(case when pos % 7 = 3 then 'no such id ' || pos when pos % 7 = 5 then lpad(upper(to_hex(pos)), 40, '0') else coalesce(paperId, '') end) raw from search_papers),
    st as (select lower(trim(paperId)) id, arg_min(y, l) y from (select trim(paperId) l, paperId, max(year) over (partition by trim(paperId)) y from search_papers where nullif(trim(paperId), '') is not null) group by 1),
    j as (select a.*, """ + _BATCH + """ canonical, st.y, st.id from a left join st on st.id = lower(""" + _BATCH + "))"
_BN = """b as (select cat_pos * 100000000::bigint + pos idx, cat, pos, nullif(trim(paperId), '') pid, nullif(trim(map_extract_value(externalIds, 'DOI')), '') d, nullif(trim(map_extract_value(externalIds, 'ArXiv')), '') x from search_papers)"""
_H = """h as (select paper_key, list_extract(['arxiv', 'crossref', 'openalex_doi', 'openalex_title', 'core', 'pubmed', 'acl'], (doc_id % 7 + 1)::int) route, length(paper_key) % 2 = 0 ax, (doc_id % 10) / 10.0 ts, nullif(trim(text), '') text from documents where section = 'abstract' and paper_key is not null),
    u as (select *, case when ax then list_position(['arxiv', 'openalex_doi', 'openalex_title', 'pubmed', 'acl', 'europepmc_doi', 'europepmc_pmid', 'crossref', 'core', 'semantic_scholar'], route) else list_position(['openalex_doi', 'pubmed', 'acl', 'europepmc_doi', 'europepmc_pmid', 'crossref', 'openalex_title', 'europepmc_title', 'core', 'semantic_scholar'], route) end o from h),
    f as (select paper_key, arg_min(route, row(o, text)) route, arg_min(text, row(o, text)) text from u where o > 0 and text is not null and (route not like '%\\_title' escape '\\' or ts >= 0.85) group by 1),
    g as (select record_id, case when nullif(trim(abstract), '') is not null then 'original' else f.route end abstract_source, coalesce(nullif(trim(abstract), ''), f.text) abstract from paper_records r left join f using (paper_key))"""
ORACLES = {
    "id_forms": f"""select record_id, {_DOI.format('doi')} as doi, nullif(lower(trim(doi)), '') as doi_key, coalesce({_AX.format('arxiv_id')}, nullif(regexp_extract({_DOI.format('doi')}, '10\\.48550/arxiv\\.([A-Za-z\\-]+/\\d{{7}}|\\d{{4}}\\.\\d{{4,5}})', 1), ''),
        case when regexp_extract(dblp_id, 'abs-(\\d{{4}})-(\\d{{4,5}})', 1) <> '' then regexp_extract(dblp_id, 'abs-(\\d{{4}})-(\\d{{4,5}})', 1) || '.' || regexp_extract(dblp_id, 'abs-(\\d{{4}})-(\\d{{4,5}})', 2) end) as arxiv,
        'PMC' || nullif(regexp_extract(trim(pmcid), '(?i)^(?:PMC)?(\\d+)$', 1), '') as pmcid, {_KEY} as key from paper_records""",
    "lookup_ids": "select record_id, coalesce(" + ", ".join([_B.format("semantic_scholar_paper_id"), *[f"'{p}' || {_B.format(c)}" for p, c in (("CorpusId:", "corpus_id"), ("DOI:", "doi"), ("ARXIV:", "arxiv_id"), ("ACL:", "acl_id"), ("PMID:", "pmid"), ("PMCID:", "pmcid"), ("MAG:", "mag_id"))]]) + ") as lookup from paper_records",
    "id_kinds": f"with {_RAW} select record_id, {_KIND} as kind, {_BATCH} as batch, {_GRAPH} as graph, case when {_GRAPH} is not null then null when raw = '' then 'empty' when regexp_matches(raw, '^\\d+$') then 'ambiguous number' else 'unrecognised' end as error from r",
    "venues_and_authors": """select cat, pos, coalesce(nullif(trim(venue), ''), nullif(trim(list_filter(publicationVenue.alternate_names, lambda x: length(trim(x)) <= 10)[1]), ''), nullif(trim(publicationVenue.name), '')) as venue,
        case when authors is null then '' else coalesce(array_to_string(list_filter(list_transform(authors, lambda a: trim(a.name)), lambda n: coalesce(n, '') <> ''), '; '), '') end as authors, nullif(trim(openAccessPdf.url), '') as open_url from search_papers""",
    "record_classes": r"""with r as (select *, record_id % 23 n from paper_records),
        x as (select record_id, n, year, doi, coalesce(nullif(trim(case when n = 15 then 'Abstract CT' || record_id || ': ' || coalesce(title, '') when n = 16 then 'Erratum: ' || coalesce(title, '') else title end), ''), trim(coalesce(title, ''))) t,
            case n % 3 when 0 then 'Annual Meeting Abstracts' when 1 then 'Journal of Data' else '' end c, case n % 4 when 0 then '3' when 1 then 'Suppl 1' when 2 then '' else 'Supplement' end i from r),
        y as (select *, contains(lower(i), 'suppl') sup, regexp_matches(c, '(?i)(abstract|supplement|proceedings of the .*(meeting|congress|symposium))') book from x),
        z as (select *, case when n = 11 or (sup and book) or (regexp_matches(t, '(?i)^(abstract\s+[a-z]{0,3}\d+\s*[:.]|\d{1,4}[a-z]{1,3}\s+\S|[a-d]\d{1,4}-\d{1,4}\s+\S|lba\d+)') and (sup or book)) then 'conference_abstract'
            when n in (3, 5) then 'poster' when regexp_matches(t, '(?i)^\s*(erratum|corrigendum|correction to|publisher correction|author correction)\b') or n = 9 then 'correction' when n in (13, 6) then 'paratext' when n in (7, 12) then 'not_an_article' end rc from y)
        select record_id, rc as record_class, n in (10, 14) as retracted, case when year is null then null when n % 3 = 0 then printf('%04d-04-01', year) when n % 3 = 1 then printf('%04d-01-01', year) else printf('%04d-12-31', year) end as published_online, rc is not null as terminal from z""",
    "graph_edges": f"with {_E} select seed, edge_type, pos from k",
    "graph_seeds": f"""with {_SEEDS} select *, raw_citations >= 9999 as citations_truncated, raw_references >= 9999 as references_truncated from sd""",
    "graph_summary": f"""with {_SEEDS} select count(*) as seeds, sum(raw_citations)::bigint as raw_citations, sum(raw_references)::bigint as raw_references, sum(citations)::bigint as citations, sum("references")::bigint as "references", count(*) filter (citations > 0) as with_citations, count(*) filter ("references" > 0) as with_references,
        count(*) filter (citations > 0 and "references" > 0) as with_both, count(*) filter (citations = 0 and "references" = 0) as with_neither, count(*) filter (raw_citations >= 9999) as citations_truncated, count(*) filter (raw_references >= 9999) as references_truncated, max(raw_citations) as most_citations from sd""",
    "fetch_by_id": f"with {_ASK} select input_pos, floor(input_pos / 500)::int as chunk, case when canonical is null then 'invalid_id' when id is null then 'not_found' else 'found' end as fetch_status, coalesce(y, -1) as year from j",
    "fetch_status": f"with {_ASK} select case when canonical is null then 'invalid_id' when id is null then 'not_found' else 'found' end as fetch_status, count(*) as n from j group by 1",
    "bundle_violations": f"with {_BN} select idx, case when pos % 50 = 1 then 'no matched query' else 'unknown query' end as violation from b where pos % 50 in (1, 2) or (pos % 50 <> 1 and cat not in (select id from search_queries))",
    "bundle_counts": f"with {_BN} select count(*) filter (coalesce(pid, d, x) is not null) as total_unique_papers, count(*) filter (coalesce(pid, d, x) is null) as identity_dropped, 0::bigint as identity_less from b",
    "bundle_per_query": "select case when pos % 50 = 2 then 'nobody' else cat end as query, count(*) as papers from search_papers where pos % 50 <> 1 group by 1",
    "abstracts_filled": f"with {_H} select record_id, abstract_source, coalesce(length(abstract), -1) as n from g",
    "recovery_by_source": f"with {_H}, m as (select * from g where abstract_source is null or abstract_source <> 'original') select abstract_source as source, count(*) as recovered, round(100.0 * count(*) / (select count(*) from m), 2) as rate from m where abstract_source is not null group by 1",
    "preview_counts": "select cat, count(*) as total from search_papers group by 1",
    "publisher_of_doi": "select case split_part(doi, '/', 1) when '10.1007' then 'Springer' when '10.1145' then 'ACM' when '10.1109' then 'IEEE' when '10.1016' then 'Elsevier' else 'Unknown' end as publisher, count(*) as n from paper_records group by 1",
    "surname_overlap": f"""with one as (select record_id, {_MATCH.replace('{0}', 'title')} k, authors a, year from paper_records), two as (select hit_id, {_MATCH.replace('{0}', 'title')} k, authors b, year y from arxiv_hits)
        select record_id, hit_id, coalesce(len(list_distinct(list_intersect(list_filter(list_transform(a, lambda n: case when contains(n, ',') then trim(split_part(lower(trim(n)), ',', 1)) else regexp_extract(lower(trim(n)), '[^ ]*$') end), lambda s: s <> ''),
            list_filter(list_transform(b, lambda n: case when contains(n, ',') then trim(split_part(lower(trim(n)), ',', 1)) else regexp_extract(lower(trim(n)), '[^ ]*$') end), lambda s: s <> '')))), 0)::int as shared, coalesce(y - year between -2 and 1, true) as close from one join two using (k) where k <> ''""",
    "latest_events": "select user_id, event_type, arg_max(event_id, row(epoch_us(ts), event_id)) as last_event, count(*) as events from events group by all",
    "enriched_records": f"""with f as (select paper_key k, arg_min(source, doc_id) found_in, arg_min(section, doc_id) found_section from documents where paper_key is not null group by 1), r as (select record_id, paper_key, case when {_DOI.format('doi')} is not null then 'doi__' || {_SAFE.format(_DOI.format('doi'))} else 'title__' || substr(sha1(coalesce(nullif({_MATCH.replace('{0}', 'title')}, ''), 'unknown')), 1, 16) end own from paper_records)
        select record_id, case when a.k is not null then a.found_in else b.found_in end as found_in, case when a.k is not null then a.found_section else b.found_section end as found_section from r left join f a on a.k = paper_key left join f b on b.k = own""",
    "url_hosts": r"""with u as (select cat, pos, lower(openAccessPdf.url) u, nullif(regexp_replace(regexp_extract(lower(openAccessPdf.url), '^[a-z][a-z0-9+.-]*://([^/?#]*)', 1), '^www\.', ''), '') dm from search_papers where openAccessPdf.url is not null),
        h as (select *, nullif(regexp_replace(regexp_replace(regexp_replace(dm, '^[^@]*@', ''), ':\d*$', ''), '^www\.', ''), '') hs from u)
        select cat, pos, dm as domain, hs as host, list_last(string_split(hs, '.')) as top, len(string_split(hs, '.'))::int as depth, case when dm in ('arxiv.org', 'biorxiv.org', 'medrxiv.org', 'ssrn.com', 'osf.io') then 'preprint' when dm in ('aclanthology.org', 'dl.acm.org', 'link.springer.com', 'nature.com', 'mdpi.com') then 'publisher' when dm in ('europepmc.org', 'zenodo.org', 'core.ac.uk', 'hal.science') then 'repository' else 'unknown' end as host_type,
        regexp_matches(u, '\.pdf($|[?#])') as is_pdf, regexp_matches(u, 'staging\.|test\.|sandbox\.|dev\.|qa\.') as staging from h""",
    "page_counts": """with r as (select l_linenumber n, l_partkey a, l_partkey + l_quantity::int b from lineitem),
        s as (select distinct case n when 1 then a || '-' || b when 2 then a || '–' || right(b::varchar, 2) when 3 then 'e' || a when 4 then a::varchar when 5 then b || '-' || a else 'n.d.' end as pages, case n when 1 then 1 when 2 then 1 when 5 then 1 when 4 then 2 else 0 end kind, case when n = 5 then b else a end f, case n when 1 then b::varchar when 2 then right(b::varchar, 2) when 5 then a::varchar end l from r),
        w as (select pages, kind, f, case when length(l) < length(f::varchar) and l::bigint < f then (left(f::varchar, length(f::varchar) - length(l)) || l)::bigint else l::bigint end t from s)
        select distinct pages, case when kind = 2 then 1 when kind = 1 and t - f + 1 between 1 and 400 then t - f + 1 end::bigint as n_pages from w""",
    "recovery_by_publisher": """with r as (select coalesce(venue, '') cat, doi, case when coalesce(abstract_source, '') like 'scrape:%' then abstract_source when nullif(trim(abstract), '') is not null then 'original' end src from paper_records),
        g as (select cat, case split_part(doi, '/', 1) when '10.1007' then 'Springer' when '10.1145' then 'ACM' when '10.1109' then 'IEEE' when '10.1016' then 'Elsevier' else 'Unknown' end publisher, 1 m, 0 b from r where src is null or src like 'scrape:%' union all select cat, substr(src, 8), 0, 1 from r where src like 'scrape:%')
        select cat, publisher, sum(m)::bigint as missing, sum(b)::bigint as recovered from g group by 1, 2 union all select 'TOTAL', publisher, sum(m), sum(b) from g group by 2""",
    "keyword_search": r"""with q as (select id, regexp_extract_all(query, '"([^"]+)"', 1) t, map_extract_value(params, 'year') y, coalesce(map_extract_value(params, 'minCitationCount')::int, 0) m from search_queries),
        w as (select id, y, m, list_transform(t, lambda p: ' ' || regexp_replace(lower(p), '[^\p{L}\p{N}]+', ' ', 'g') || ' ') r from q),
        p as (select cat, pos, ' ' || regexp_replace(lower(coalesce(title, '')), '[^\p{L}\p{N}]+', ' ', 'g') || ' ' a, ' ' || regexp_replace(lower(coalesce(abstract, '')), '[^\p{L}\p{N}]+', ' ', 'g') || ' ' b, coalesce(publicationDate, year::varchar || '-01-01') v, coalesce(citationCount, 0) c from search_papers)
        select cat, pos, id as query from p, w where c >= m and (contains(a, r[1]) or contains(b, r[1]) or contains(a, r[2]) or contains(b, r[2])) and (contains(a, r[3]) or contains(b, r[3]))
        and (y is null or (v >= split_part(y, '-', 1) and (split_part(y, '-', 2) = '' or substr(v, 1, 4) <= split_part(y, '-', 2))))""",
    "clean_abstracts": r"""with c as (select doc_id, regexp_replace(trim(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x0B\x1C-\x1F]+', ' ', 'g')), '(?i)^abstract[: ]+', '') t from documents)
        select doc_id, case when length(t) >= 80 then t end as abstract from c""",
}

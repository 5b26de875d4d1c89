"""Pages, recorded abstracts, responses, names and small functions, on made-up inputs
of the size of the tables; the SQL states what must come out of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from scholarlake.functions import asked, html, ids, text, urls
from scholarlake.operators import hosts, identity, joins, outcomes, providers, recovery


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The abstract that a made-up page or answer of a record holds, in both dialects.
_WORDS = "concat('We study case ', record_id, ' of tidal mills & report what their keepers wrote down in the long winter of that year.')"


def _numbered(s: SparkSession, d: str, n: int) -> DataFrame:
    return _t(s, d, "paper_records").select("record_id", (F.col("record_id") % n).alias("n"), F.expr(_WORDS).alias("words"), F.concat(F.lit(""), "record_id").alias("id"))


def _case(*values: str) -> Column:
    """The n-th of several expressions."""
    out = F.when(F.col("n") == 0, F.expr(values[0]))
    for i, v in enumerate(values[1:], 1):
        out = out.when(F.col("n") == i, F.expr(v))
    return out


_ESCAPED = "replace(words, '&', '&amp;')"


def _page_abstracts(s, d):
    """A page of each kind: element, embedded JSON, linked data, three meta tags, none."""
    page = _case(
        f"concat('<html><section data-title=\"Abstract\"><h2>Abstract</h2> <p>', {_ESCAPED}, '</p></section></html>')",
        "concat('<script>xplGlobal.document.metadata=', to_json(named_struct('id', id, 'abstract', words)), ';</script>')",
        "concat('<script type=\"application/ld+json\">', to_json(array(named_struct('abstract', words))), '</script>')",
        f"concat('<meta content=\"', {_ESCAPED}, '\" property=\"og:description\">')",
        f"concat('<meta name=\"description\" content=\"', {_ESCAPED}, '\">')",
        f"concat('<meta name=\"twitter:description\" content=\"', {_ESCAPED}, '\"><meta name=\"description\" content=\"short\">')",
        "'<html><p>nothing here'",
    )
    publisher = _case("'Springer'", "'IEEE'", "'Elsevier'", "'Unknown'", "'Wiley'", "'MDPI'", "'ACM'")
    p = _numbered(s, d, 7).select("record_id", page.alias("page"), publisher.alias("publisher"))
    return p.select("record_id", html.abstract(F.col("page"), F.col("publisher")).alias("abstract"))


def _page_links(s, d):
    """Landing pages: meta tag in both orders, download link, file links near and far."""
    page = _case(
        "concat('<meta name=\"citation_pdf_url\" content=\"https://files.host.example/', id, '.pdf\">')",
        "concat('<meta content=\"/f/', id, '.pdf\" name=\"eprints.document_url\">')",
        "concat('<a href=\"https://www.host.example/index.php/j/article/download/', id, '/1\">PDF</a><a href=\"/x.pdf\">other</a>')",
        "concat('<a href=\"https://far.example/y.pdf\">far</a><a href=\"p/', id, '.pdf?download=1\">near</a>')",
        "concat('<a href=\"https://far.example/', id, '.pdf\">far</a><a href=\"mailto:x@host.example?.pdf\">m</a>')",
        "cast(null as string)",
    )
    p = _numbered(s, d, 6).select("record_id", page.alias("page"), F.concat(F.lit("https://www.host.example/a/"), "id").alias("base"))
    return p.select("record_id", html.pdf_link(F.col("page"), F.col("base")).alias("link"), F.coalesce(F.size(html.anchors(F.col("page"))), F.lit(-1)).alias("anchors"), html.meta(F.col("page"), "citation_pdf_url").alias("named"))


def _cvf(s, d):
    """Index pages of two papers each, and papers' pages in the markups there have been."""
    index = "concat('<a href=\"/content/CVPR2021/html/A_', id, '_paper.html\"> First  of ', id, '</a><a href=\"/content/CVPR2021_workshops/html/B_', id, '_paper.html\" class=\"x\">Second</a><a href=\"/about.html\">no</a>')"
    paper = _case("concat('<a href=\"/content/', id, '.pdf\">pdf</a>')", "concat('<a class=\"b\" href=\"content/', id, '.pdf\"> [PDF] </a>')", "concat('<meta name=\"citation_pdf_url\" content=\"https://openaccess.thecvf.com/m/', id, '.pdf\">')", "'<a href=\"/x.pdf\">slides</a>'")
    p = _numbered(s, d, 4).select("record_id", F.expr(index).alias("index"), paper.alias("paper"))
    listed = html.cvf_papers(F.col("index"))
    return p.select("record_id", F.size(listed).alias("papers"), F.get(listed, 0)["url"].alias("first_url"), F.get(listed, 0)["title"].alias("first_title"), html.cvf_file(F.col("paper")).alias("file"))


def _results(s, d):
    """A search engine's page of seven results behind redirects."""
    one = "concat('<a rel=\"n\" class=\"result__a\" href=\"https://duckduckgo.com/l/?uddg=https%3A%2F%2Fhost.example%2F', id, '.pdf&amp;rut=1\">A <b>title</b> of  ', id, ' &amp; more</a>')"
    page = F.concat(F.expr(one), *[F.expr(f"concat('<a class=\"x result__a\" href=\"https://h{i}.example/\">T{i}</a>')") for i in range(6)], F.lit('<a href="a.pdf">1</a><a href="b.PDF?x=1">2</a><a href="c.txt">3</a>'))
    p = _numbered(s, d, 1).select("record_id", html.unescape(page).alias("page"))
    found = html.search_results(F.col("page"))
    return p.select("record_id", F.size(found).alias("results"), F.get(found, 0)["url"].alias("url"), F.get(found, 0)["title"].alias("title"), F.array_join(html.file_links(F.col("page")), " ").alias("files"))


_ROUTES = ("arxiv", "pubmed", "acl", "crossref", "semantic_scholar", "openalex_doi", "openalex_title", "europepmc_doi", "europepmc_title", "core")


def _answers(s, d):
    """An answer of each source, of records in turn; every eleventh one failed."""
    index = "to_json(map_from_entries(transform(array_distinct(split(words, ' ')), w -> struct(w, transform(filter(transform(split(words, ' '), (x, i) -> struct(x, i)), y -> y.x = w), y -> y.i)))))"
    payload = _case(
        "concat('<feed xmlns=\"http://www.w3.org/2005/Atom\"><entry><title>T</title><summary> ', replace(words, '&', '&amp;'), ' </summary></entry></feed>')",
        "words",
        f"concat('<div class=\"card acl-abstract\"><span>Abstract</span>', {_ESCAPED}, '</div>')",
        "to_json(named_struct('message', named_struct('abstract', concat('<jats:p>', words, '</jats:p>'))))",
        "to_json(named_struct('abstract', concat('  ', words)))",
        f"concat('{{\"abstract_inverted_index\": ', {index}, '}}')",
        f"concat('{{\"results\": [{{\"title\": \"A title of ', id, '!\", \"abstract_inverted_index\": ', {index}, '}}]}}')",
        "to_json(named_struct('resultList', named_struct('result', array(named_struct('abstractText', words)))))",
        "to_json(named_struct('resultList', named_struct('result', array(named_struct('title', 'Quite another thing altogether', 'abstractText', words)))))",
        "to_json(named_struct('results', array(named_struct('abstract', ' '), named_struct('abstract', words))))",
    )
    r = _numbered(s, d, 10)
    route = F.element_at(F.array(*[F.lit(x) for x in _ROUTES]), (F.col("n") + 1).cast("int"))
    status = F.when(F.col("record_id") % 11 == 0, 503).otherwise(200)
    return r.select(F.col("record_id").alias("paperId"), F.concat(F.lit("A Title of "), "id").alias("title"), (F.col("record_id") % 2 == 0).alias("has_arxiv"), route.alias("route"), status.alias("status"), F.when(F.col("record_id") % 13 == 0, F.lit("{broken")).otherwise(payload).alias("payload"))


def _recovered(s, d):
    hits = recovery.read_answers(_answers(s, d))
    return recovery.first_hits(hits).select("paperId", "source", "text")


def _scraped(s, d):
    """Pages of papers of three publishers: the second page of the publisher's own, or
    the page behind the DOI under another address."""
    r = _numbered(s, d, 3)
    doi = _case("concat('10.1007/', id)", "concat('10.9999/', id)", "concat('10.1038/', id)")
    papers = r.select(F.col("record_id").alias("paperId"), doi.alias("doi"))
    body = F.expr(f"concat('<section data-title=\"Abstract\">', {_ESCAPED}, '</section><meta name=\"description\" content=\"', {_ESCAPED}, ' Again.\">')")
    url = _case("concat('https://link.springer.com/chapter/10.1007/', id)", "concat('https://doi.org/10.9999/', id)", "concat('https://doi.org/10.1038/', id)")
    final = _case("cast(null as string)", "concat('https://www.mdpi.com/', id)", "concat('https://elsewhere.example/', id)")
    pages = r.select(url.alias("url"), final.alias("final_url"), F.when(F.col("record_id") % 10 == 9, 404).otherwise(200).alias("status"), body.alias("html"))
    return recovery.scraped(recovery.page_requests(papers), pages)


def _responses(s, d):
    """Responses in turn: bot walls by header and text, refusals small and by text, an
    API's refusal, plain answers, a host that is always walled."""
    e = _t(s, d, "events").select("event_id", (F.col("event_id") % 9).alias("n"))
    status = _case("200", "403", "403", "403", "429", "503", "200", "202", "200").cast("int")
    headers = F.when(F.col("n") == 0, F.create_map(F.lit("CF-Mitigated"), F.lit("challenge"))).otherwise(F.create_map(F.lit("x"), F.lit("y")))
    body = _case("'fine'", "'<title>Just a moment...</title>'", "''", "concat('Access Denied', repeat('x', 9000))", "''", "'busy'", "'captcha prose about walls'", "repeat('long ', 2000)", "repeat('fine ', 2000)")
    url = _case(*["'https://www.host.example/x'"] * 5, "'https://api.host.example/x'", "'https://www.host.example/x'", "'https://www.host.example/x'", "'https://pdf.walled.example/x'")
    r = e.select("event_id", status.alias("status"), headers.alias("headers"), body.alias("body"), url.alias("url"))
    kind = hosts.response_kind(F.col("status"), F.col("url"), F.col("headers"), F.col("body"), ("api.host.example",), ("walled.example",))
    return r.select("event_id", kind.alias("kind"))


def _off(s, d):
    """Hosts that are off at an instant: denied, walled or refusing."""
    e = _t(s, d, "events").select(F.concat(F.lit("h"), "user_id", F.lit(".example")).alias("host"), (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)).alias("at"), "event_type")
    ladder = hosts.refusal_ladder(e.where("event_type = 'error'").select("host", "at"))
    walls = e.where("event_type = 'signup'").select("host", "at")
    out = hosts.block_states(ladder, walls, ["h1.example", "h2.example", "h3.example"], F.lit(1705708800.0))
    return out.select("host", "state", F.round("until", 3).alias("until"))


def _verdicts(s, d):
    """Preprints of the same title as a record: which of them are the paper."""
    r, h = _t(s, d, "paper_records"), _t(s, d, "arxiv_hits")
    one = r.select("record_id", text.match_title(F.col("title")).alias("k"), F.col("authors").alias("a"), F.col("year").alias("y")).where("k <> ''")
    two = h.select("hit_id", text.match_title(F.col("title")).alias("k"), F.col("authors").alias("b"), F.col("year").alias("z"))
    j = one.join(two, "k").withColumn("score", F.when(F.col("hit_id") % 9 == 0, 0.5).otherwise(1.0))
    reason = providers.hit_verdict({"authors": F.col("a"), "year": F.col("y")}, {"authors": F.col("b"), "year": F.col("z")}, F.col("score"))
    return j.select("record_id", "hit_id", reason.alias("reason"))


def _work_states(s, d):
    """Records with their registered work: found, absent, error or no DOI."""
    r = _t(s, d, "paper_records").select("record_id", ids.doi_key(F.col("doi")).alias("k"))
    works = r.where("k is not null").select(F.col("k").alias("doi_key")).distinct()
    n = F.length("doi_key") % 4
    works = works.select("doi_key", F.when(n != 3, n != 1).alias("answered"), F.when(n == 2, "Timeout").alias("error")).where(n != 3)
    return joins.with_work(r, F.col("k"), works).select("record_id", "work_status")


def _files(s, d):
    """Downloaded bytes: whole, cut, pages, empty, of a wrong type."""
    r = _numbered(s, d, 7)
    body = _case("concat('%PDF-1.4', repeat('x', 2000))", "'%PDF-1.4 short'", "'<html>no file</html>'", "''", "concat('junk', '%PDF-1.7', repeat('y', 3000))", "concat('%PDF-1.4', repeat('x', 2000))", "cast(null as string)")
    kind = _case("'application/pdf; charset=x'", "'application/pdf'", "'text/html'", "'application/pdf'", "'application/octet-stream'", "'text/html'", "''")
    status = F.when(F.col("n") == 3, 202).otherwise(200)
    return r.select("record_id", identity.file_verdict(F.encode(body, "UTF-8"), kind, status).alias("verdict"))


def _names(s, d):
    """Identifiers and titles as parts of paths, and what is asked for them."""
    r = _t(s, d, "paper_records")
    t, doi = F.col("title"), F.col("doi")
    return r.select("record_id", ids.file_component(t).alias("part"), F.coalesce(ids.graph_file(F.concat(F.lit("DOI:"), "doi")), F.lit("")).alias("file"), asked.core_title(text.blank_to_null(t)).alias("core"), asked.site_title(F.lit("arxiv.org"), text.blank_to_null(t)).alias("site"), ids.cvf_venue(F.col("venue"), doi).alias("venue"), ids.cvf_year(F.lit(None).cast("int"), doi).alias("year"))


def _archive(s, d):
    """Ids of the archive, from ids and addresses, and the addresses made of them."""
    r = _numbered(s, d, 5)
    raw = _case("id", "concat('pmc', id)", "concat('https://www.ncbi.nlm.nih.gov/pmc/articles/PMC', id, '/pdf/')", "concat('https://europepmc.org/article/PMC', id)", "concat('x', id)")
    r = r.withColumn("raw", raw)
    digits = F.coalesce(ids.pmcid_digits(F.col("raw")), ids.pmcid_of_url(F.col("raw")))
    return r.select("record_id", digits.alias("digits"), ids.europepmc_file(digits).alias("file"), ids.is_interstitial(F.col("raw"), F.when(F.col("n") == 2, "PREPARING TO DOWNLOAD")).alias("by_script"))


def _small(s, d):
    """Waits, stamps, entitlement headers and preprint ids for recovery."""
    e = _t(s, d, "events").select("event_id", (F.col("event_id") % 5).alias("n"), F.col("ts").cast("timestamp").alias("ts"))
    head = _case("'7'", "'Wed, 21 Oct 2015 07:28:00 GMT'", "'-3'", "cast(null as string)", "' 2.5 '")
    told = F.create_map(F.lit("x-els-status"), _case("'WARNING - Response limited to first page'", "'OK'", "'FIRSTPAGE only'", "''", "'OK'"), F.lit("X-ELS-Entitlement"), _case("''", "'Not Entitled'", "''", "''", "''"))
    dblp = _case("''", "'journals/corr/abs-2001-01234'", "''", "'conf/x/1'", "'journals/corr/abs-1-2-3'")
    doi = _case("'10.48550/arXiv.2101.00001'", "''", "'10.48550/arxiv.2101.00002'", "''", "''")
    return e.select("event_id", asked.backoff(F.col("n") + 1).alias("backoff"), asked.retry_after(head).alias("wait"), asked.stamp(F.col("ts")).alias("stamp"), urls.preview_header(F.lit("api.elsevier.com"), told).alias("preview"), urls.preview_header(F.lit("other.example"), told).alias("other"), ids.recovery_arxiv(F.lit(None).cast("string"), doi, dblp).alias("arxiv"))


def _index(s, d):
    """Abstracts rebuilt from inverted indexes with a gap and a doubled place."""
    r = _numbered(s, d, 2)
    index = _case("concat('{\"b', id, '\": [2], \"a\": [0, 5], \"c\": [2]}')", "concat('no json ', id)")
    return r.select("record_id", text.from_inverted_index(index).alias("text"), text.clip(F.concat("words", "words")).alias("clipped"))


def _recent(s, d):
    r = _t(s, d, "paper_records").select("record_id", "publication_date")
    return r.select("record_id", outcomes.recent(F.col("publication_date"), F.lit("2020-06-30").cast("date")).alias("recent"))


def _statuses(s, d):
    """Results in turn: skipped, done, found, and failed of each kind."""
    e = _t(s, d, "events").select("event_id", (F.col("event_id") % 8).alias("n"))
    kind = _case("'download'", "'download'", "cast(null as string)", "'metadata'", "'resolution'", "'resolution'", "'download'", "'other'")
    r = e.select("event_id", F.when(F.col("n") == 0, "poster").alias("record_class"), (F.col("n") == 0).alias("terminal"), F.col("n").isin(1, 2).alias("downloaded"), (F.col("n") == 2).alias("reused_existing"), kind.alias("error_kind"), F.when(F.col("n") == 4, "No downloadable source candidate found for x").alias("error"), F.lit("not_free").alias("failure_reason"))
    return outcomes.statuses(r).select("event_id", "status", "failure_reason")


def _withdrawn(s, d):
    """Preprints whose address is gone, a third of them with a note."""
    h = _t(s, d, "arxiv_hits")
    tries = h.select(F.concat(F.lit("h"), "hit_id").alias("paper_key"), "arxiv_id", F.lit("arxiv").alias("source_name"), F.when(F.col("hit_id") % 2 == 0, 404).otherwise(200).alias("http_status"))
    notes = h.select("arxiv_id", F.when(F.ascii(F.substring("arxiv_id", -1, 1)) % 3 == 0, "This paper has been Withdrawn").otherwise("12 pages").alias("comment"))
    return outcomes.withdrawals(tries, notes).select("paper_key", "class_reason")


QUERIES = {
    "result_statuses": _statuses,
    "withdrawn_preprints": _withdrawn,
    "page_abstracts": _page_abstracts,
    "page_links": _page_links,
    "cvf_pages": _cvf,
    "search_result_pages": _results,
    "recovery_answers": _recovered,
    "scraped_abstracts": _scraped,
    "response_kinds": _responses,
    "hosts_off": _off,
    "hit_verdicts": _verdicts,
    "work_states": _work_states,
    "file_verdicts": _files,
    "path_names": _names,
    "archive_links": _archive,
    "waits_and_stamps": _small,
    "index_texts": _index,
    "recent_records": _recent,
}
_N = "(select record_id, record_id % {0} n, concat('', record_id) id, " + _WORDS + " words from paper_records)"
_K = r"trim(regexp_replace(regexp_replace(lower(trim(coalesce(title, ''))), '[^a-z0-9\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x0B\x1C-\x1F]+', ' ', 'g'), '[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x0B\x1C-\x1F]+', ' ', 'g'))"
_SUR = "list_filter(list_transform({0}, lambda n: case when contains(n, ',') then trim(split_part(lower(trim(n)), ',', 1)) else regexp_extract(lower(trim(n)), '[^ ]*$') end), lambda s: s <> '')"
ORACLES = {
    "result_statuses": """select event_id, case event_id % 8 when 0 then 'skipped_poster' when 1 then 'downloaded' when 2 then 'already_exists' when 3 then 'failed_metadata_fetch_failed' when 4 then 'failed_unresolved_no_legal_pdf'
        when 5 then 'failed_resolution_failed' when 6 then 'failed_download_failed_all_candidates' else 'failed_pipeline_error' end as status, case when event_id % 8 > 2 then 'not_free' end as failure_reason from events""",
    "withdrawn_preprints": "select distinct 'h' || hit_id as paper_key, 'arxiv: ' || case when ascii(right(arxiv_id, 1)) % 3 = 0 then 'This paper has been Withdrawn' else '404 for a known id' end as class_reason from arxiv_hits where hit_id % 2 = 0",
    "page_abstracts": f"select record_id, case when n < 6 then words end as abstract from {_N.format(7)}",
    "page_links": f"""select record_id, case n when 0 then 'https://files.host.example/' || id || '.pdf' when 1 then 'https://www.host.example/f/' || id || '.pdf' when 2 then 'https://www.host.example/index.php/j/article/download/' || id || '/1'
        when 3 then 'https://www.host.example/a/p/' || id || '.pdf?download=1' end as link, case when n < 2 then 0 when n = 5 then -1 else 2 end as anchors, case when n = 0 then 'https://files.host.example/' || id || '.pdf' end as named from {_N.format(6)}""",
    "cvf_pages": f"""select record_id, 2 as papers, 'https://openaccess.thecvf.com/content/CVPR2021/html/A_' || id || '_paper.html' as first_url, 'First of ' || id as first_title,
        case n when 3 then null when 2 then 'https://openaccess.thecvf.com/m/' || id || '.pdf' else 'https://openaccess.thecvf.com/content/' || id || '.pdf' end as file from {_N.format(4)}""",
    "search_result_pages": f"select record_id, 5 as results, 'https://host.example/' || id || '.pdf' as url, 'A title of ' || id || ' & more' as title, 'a.pdf b.PDF?x=1' as files from {_N.format(1)}",
    "recovery_answers": f"""select record_id as "paperId", list_extract({list(_ROUTES)!r}, (n + 1)::int) as source, case when n = 1 and record_id % 13 = 0 then '{{broken' else words end as text from {_N.format(10)}
        where record_id % 11 <> 0 and n <> 8 and record_id % 13 <> 0""",
    "scraped_abstracts": f"""select record_id as "paperId", case n when 0 then 'Springer' when 1 then 'MDPI' else 'Nature' end as publisher, case when n = 1 then words || ' Again.' else words end as text from {_N.format(3)} where record_id % 10 <> 9""",
    "response_kinds": "select event_id, case event_id % 9 when 0 then 'challenge' when 1 then 'challenge' when 2 then 'refusal' when 3 then 'refusal' when 8 then 'challenge' end as kind from events",
    "hosts_off": """with e as (select 'h' || user_id || '.example' host, epoch_us(ts) us, epoch_us(ts) / 1e6 t, event_type from events), n as (select *, count(*) over (partition by host order by us range between 604800000000 preceding and current row) c from e where event_type = 'error'),
        l as (select host, t, t + case least(c, 3) when 1 then 900 when 2 then 21600 else 172800 end u from n), r as (select host, max(u) u from l where t <= 1705708800 group by 1 having max(u) > 1705708800),
        w as (select host, max(t) + 3600 u from e where event_type = 'signup' and t <= 1705708800 group by 1 having max(t) + 3600 > 1705708800), b as (select host, u, 2 o from r union all select host, u, 1 from w),
        f as (select host, min(o) o, arg_min(u, o) u from b where host not in ('h1.example', 'h2.example', 'h3.example') group by 1)
        select host, case o when 1 then 'challenge' else 'refusal' end as state, round(u, 3) as until from f union all select host, 'denied', round(max(u), 3) from b where host in ('h1.example', 'h2.example', 'h3.example') group by 1""",
    "hit_verdicts": f"""with one as (select record_id, {_K} k, authors a, year y from paper_records), two as (select hit_id, {_K} k, authors b, year z from arxiv_hits),
        j as (select *, coalesce(len(a), 0) m, coalesce(len(list_distinct(list_intersect({_SUR.format('a')}, {_SUR.format('b')}))), 0) s from one join two using (k) where k <> '')
        select record_id, hit_id, case when hit_id % 9 = 0 then 'title similarity 0.50 < 0.90' when m > 0 and s < case when m = 1 then 1 else 2 end then s || ' author surname(s) in common, need ' || case when m = 1 then 1 else 2 end
            when z - y not between -2 and 1 then 'published ' || z || ', paper is ' || y end as reason from j""",
    "work_states": """with r as (select record_id, nullif(regexp_replace(lower(nullif(trim(doi), '')), '^(https?://(dx\\.)?doi\\.org/|doi:\\s*)', ''), '') k from paper_records)
        select record_id, case when k is null then 'no_doi' when length(k) % 4 in (2, 3) then 'error' when length(k) % 4 = 1 then 'absent' else 'found' end as work_status from r""",
    "file_verdicts": f"select record_id, case n when 0 then 'ok' when 1 then 'too_small' when 2 then 'not_a_pdf' when 3 then 'challenge' when 4 then 'ok' when 5 then 'wrong_type' else 'empty' end as verdict from {_N.format(7)}",
    "path_names": r"""select record_id, substr(case when title is not null then coalesce(nullif(regexp_replace(regexp_replace(trim(title), '[^A-Za-z0-9._-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g'), ''), 'unknown') end, 1, 180) as part, coalesce(translate('DOI:' || doi, ':/\?*<>|"', '_________'), '') as file,
        'title:("' || replace(nullif(trim(title), ''), '"', ' ') || '")' as core, 'site:arxiv.org "' || nullif(trim(title), '') || '"' as site,
        coalesce(case when contains(upper(venue), 'CVPR') then 'CVPR' when contains(upper(venue), 'ICCV') then 'ICCV' when contains(upper(venue), 'ECCV') then 'ECCV' when contains(upper(venue), 'WACV') then 'WACV' end, case when contains(upper(doi), 'CVPR') then 'CVPR' when contains(upper(doi), 'ICCV') then 'ICCV' when contains(upper(doi), 'WACV') then 'WACV' end) as venue,
        try_cast(nullif(regexp_extract(doi, '\.\b(20\d{2})\.\d+$', 1), '') as int) as year from paper_records""",
    "archive_links": f"select record_id, case when n < 4 then id end as digits, case when n < 4 then 'https://europepmc.org/articles/PMC' || id || '?pdf=render' end as file, false as by_script from {_N.format(5)}",
    "waits_and_stamps": """with e as (select event_id, event_id % 5 n, ts from events) select event_id, 2.0 * power(2, n) as backoff, case n when 0 then 7.0 when 2 then 0.0 when 4 then 2.5 else 60.0 end as wait, strftime(ts, '%Y%m%dT%H%M%SZ') as stamp,
        case n when 0 then 'X-ELS-Status: WARNING - Response limited to first page' when 1 then 'X-ELS-Entitlement: Not Entitled' when 2 then 'X-ELS-Status: FIRSTPAGE only' end as preview, null::varchar as other, case n when 0 then '2101.00001' when 1 then '2001.01234' when 4 then '1.2.3' end as arxiv from e""",
    "index_texts": f"select record_id, case when n = 0 then 'a c a' end as text, substr(words || words, 1, 69) || '…' as clipped from {_N.format(2)}",
    "recent_records": "select record_id, coalesce(date_diff('day', try_cast(publication_date as date), date '2020-06-30') between 0 and 60, false) as recent from paper_records",
}

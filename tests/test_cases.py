"""Cases that the operators must judge as they are known to be judged."""

import json

import pytest
from pyspark.sql import functions as F

from scholarlake import config
from scholarlake.functions import asked, html, ids, text, urls
from scholarlake.operators import classify, graph, hosts, identity, lookups, outcomes, providers, resolve, search
from scholarlake.sources import readers, schemas

WORK = {"DOI": None, "type": None, "subtype": None, "title": None, "container_title": None, "issue": None, "update_to": None, "online": None, "published": None, "issued": None}
INDEXED = {"type": None, "display_name": None, "is_paratext": None, "is_retracted": None}
CLASSES = [
    ("indexed type alone", {}, {"type": "conference-abstract"}, "conference_abstract"),
    ("supplement and title", {"issue": "16_Supplement", "container_title": "Cancer Research", "title": "Abstract 4137: A study of something"}, {}, "conference_abstract"),
    ("session code in a supplement", {"issue": "Supplement 1", "container_title": "American Journal of Respiratory and Critical Care Medicine", "title": "A1234-5678 Some Respiratory Finding"}, {}, "conference_abstract"),
    ("a title pattern alone", {"container_title": "Journal of Materials Science", "title": "316P a Novel Alloy Under Load"}, {}, None),
    ("a paper about abstraction", {"title": "Abstract Counterfactuals for Neural Networks"}, {}, None),
    ("prefix of posters", {"DOI": "10.26226/m.abcdef", "type": "posted-content"}, {}, "poster"),
    ("posted, of no kind", {"type": "posted-content", "subtype": "other"}, {}, "poster"),
    ("a preprint", {"type": "posted-content", "subtype": "preprint"}, {}, None),
    ("erratum", {"title": "Erratum: A paper"}, {}, "correction"),
    ("corrigendum", {"title": "Corrigendum to a paper"}, {}, "correction"),
    ("correction", {"title": "Correction to: A paper"}, {}, "correction"),
    ("publisher correction", {"title": "Publisher Correction: A paper"}, {}, "correction"),
    ("dataset", {"type": "dataset"}, {}, "not_an_article"),
    ("paratext", {}, {"is_paratext": True}, "paratext"),
    ("retraction", {"type": "journal-article", "update_to": ["retraction"]}, {}, None),
    ("indexed retraction", {}, {"is_retracted": True}, None),
    ("a plain article", {"type": "journal-article", "title": "Deep Learning for Something"}, {"type": "article"}, None),
    ("date parts", {"online": [2026, 8, 3]}, {}, None),
]


def test_record_classes(spark):
    rows = [(name, None, {**WORK, **work}, {**INDEXED, **indexed}) for name, work, indexed, _ in CLASSES]
    got = {r.name: r for r in classify.classified(spark.createDataFrame(rows, f"name string, title string, {schemas.WORK}")).collect()}
    assert {n: got[n].record_class for n, *_ in CLASSES} == {n: wanted for n, *_, wanted in CLASSES}
    assert [n for n, *_ in CLASSES if got[n].retracted] == ["retraction", "indexed retraction"]
    assert got["date parts"].published_online == "2026-08-03"
    assert all(got[n].terminal == (wanted is not None) for n, *_, wanted in CLASSES)


def test_terminal_classes_are_known(spark):
    known = {wanted for *_, wanted in CLASSES if wanted} | {"withdrawn"}
    assert set(classify.TERMINAL) <= known and "retracted" not in classify.TERMINAL


RESPONSES = [
    (403, "https://dl.acm.org/doi/10.1/x", {}, "<html>Just a moment...</html>", "challenge"),
    (200, "https://ink.library.smu.edu.sg/x", {}, '<html><script src="/_Incapsula_Resource?SWJIYLWA=719d"></script></html>', "challenge"),
    (200, "https://iopscience.iop.org/article/x", {}, '<meta http-equiv="refresh" content="0;url=https://validate.perfdrive.com/...">', "challenge"),
    (200, "https://x.example", {"cf-mitigated": "challenge"}, "x" * 900_000, "challenge"),
    (403, "https://www.sciencedirect.com/science/article/pii/X", {}, "<title>ScienceDirect</title>" + "x" * 900_000, "challenge"),
    (403, "https://example.org/article", {}, "You do not have access to this article. " * 400, None),
    (403, "https://example.org/a", {}, "denied", "refusal"),
    (200, "https://example.org/p", {}, "<p>We evaluate captcha solvers and bot detection at scale.</p>", None),
    (403, "https://api.wiley.com/onlinelibrary/tdm/v1/articles/x", {}, "", None),
    (403, "https://api.elsevier.com/content/article/doi/x", {}, "<html>Just a moment...</html>", "challenge"),
    (429, "https://example.org/q", {}, "", None),
]


def test_walls_and_refusals(spark):
    df = spark.createDataFrame([(i, *r[:4]) for i, r in enumerate(RESPONSES)], "i int, status int, url string, headers map<string,string>, body string")
    kind = hosts.response_kind(F.col("status"), F.col("url"), F.col("headers"), F.col("body"), ("api.wiley.com", "api.elsevier.com"), ("sciencedirect.com",))
    assert [r.k for r in df.select("i", kind.alias("k")).orderBy("i").collect()] == [r[4] for r in RESPONSES]


def test_a_wall_does_not_climb_the_ladder(spark):
    refusals = spark.createDataFrame([("r.org", 100.0), ("r.org", 2000.0), ("r.org", 90000.0)], "host string, at double")
    walls = spark.createDataFrame([("w.org", 90000.0 + i) for i in range(3)] + [("old.org", 1.0), ("d.org", 90000.0)], "host string, at double")
    ladder = hosts.refusal_ladder(refusals)
    off = {r.host: r for r in hosts.block_states(ladder, walls, ["d.org"], F.lit(90010.0)).collect()}
    assert {h: r.state for h, r in off.items()} == {"r.org": "refusal", "w.org": "challenge", "d.org": "denied"}
    assert off["w.org"].until == 90002.0 + 3600 and off["r.org"].until == 90000.0 + 48 * 3600
    assert {r.host for r in hosts.block_states(ladder, walls, [], F.lit(90010.0), F.lit(90002.0)).collect()} == {"w.org"}


PAPER = "Attention Is All You Need"
FILLER = "\n".join(f"Line {i} of ordinary body text about transformers and attention heads." for i in range(30))
IDENTITY = "name string, doi string, arxiv_id string, title string, page_range string, source_url string, front_text string, title_text string, n_pages int, embedded_title string"


def _front(*lines):
    return "\n".join(lines) + "\n" + FILLER


DOCUMENTS = [
    ("doi printed", "10.1000/XYZ.123", None, "Completely other title", None, None, _front("Some retitled preprint", "https://doi.org/10.1000/xyz.123"), 1, None, "verified", "doi-in-text"),
    ("stamp, version ignored", None, "2402.03175v1", "The Old Title", None, None, _front("A New Title After Revision", "arXiv:2402.03175v3 [cs.CL] 1 Feb 2024"), 1, None, "verified", "arxiv-in-text"),
    ("served for the id", None, "2511.12832", "From Passive to Persuasive: Steering Emotional Nuance in Negotiation", None, "https://arxiv.org/pdf/2511.12832v2", _front("From Passive to Persuasive: Localized Activation Injection"), 1, None, "verified", "arxiv-in-url"),
    ("a mirror", None, "2511.12832", PAPER, None, "https://mirror.example.org/pdf/2511.12832", _front("Something else entirely"), 1, None, "wrong", None),
    ("broken across lines", None, None, PAPER, None, None, _front("Attention Is All", "You Need", "Ashish Vaswani et al."), 1, None, "verified", "title-on-page"),
    ("embedded title", None, None, PAPER, None, None, _front("ATTENTI0N 1S ALL Y0U NEED"), 1, PAPER, "verified", "title-in-metadata"),
    ("a scan of fitting length", None, None, PAPER, "107-122", None, "", 16, None, "verified", "page-count"),
    ("names neither", "10.1371/journal.pone.0283095", None, "Classification of Thai depression transcripts", None, None, _front("Clinical Practice Guideline of Major Depressive Disorder"), 1, None, "wrong", None),
    ("calls itself otherwise", None, None, "Allergen immunotherapy in paediatric asthma: a review", None, None, _front("Body text with no title on it, only prose."), 1, "Dietary Guidelines for Americans 2020-2025 Ninth Edition", "wrong", "calls-itself-otherwise"),
    ("first page only", "10.1000/xyz.123", None, PAPER, "1-12", None, _front(PAPER, "doi:10.1000/xyz.123"), 1, None, "truncated", None),
    ("longer than its range", None, None, PAPER, "1-8", None, _front(PAPER), 21, None, "verified", None),
    ("a short embedded title", None, None, "A very long article title about allergen immunotherapy in children", None, None, _front("prose only, the title never made it into the text layer"), 1, "Allergy", "wrong", "nothing-matches"),
    ("almost no text", None, None, PAPER, None, None, "Downloaded from a library by guest on June 5, 2016" * 3, 3, None, "unreadable", None),
    ("nothing to compare", None, None, None, None, None, _front("Whatever this is"), 1, None, "no_reference", None),
]


def test_identity_of_documents(spark):
    rows = [(n, d, a, t, p, u, f, None, k, e) for n, d, a, t, p, u, f, k, e, _, _ in DOCUMENTS]
    got = {r.name: (r.state, r.signal) for r in identity.verified(spark.createDataFrame(rows, IDENTITY)).collect()}
    for name, *_, state, signal in DOCUMENTS:
        assert got[name][0] == state and signal in (None, got[name][1]), (name, got[name])


def test_squash_and_fractions(spark):
    pairs = [("Identiﬁcation of Sparse Auto-\nencoders", "identification of sparse autoencoders"), ("salience &amp; framing", "salience & framing")]
    df = spark.createDataFrame(pairs, "a string, b string").select(text.squash("a").alias("a"), text.squash("b").alias("b"))
    assert all(r.a == r.b for r in df.collect())
    two = [("V717F β-Amyloid Precursor Protein", "V717F b-Amyloid Precursor Protein"), (PAPER, FILLER), ("Нейронные сети", "x")]
    df = spark.createDataFrame(two, "a string, b string").select(text.squash("a").alias("a"), text.squash("b").alias("b"))
    shares = [r.s for r in df.select(text.matched_fraction("a", "b").alias("s")).collect()]
    assert shares[0] > 0.9 and shares[1] < 0.5 and df.collect()[2].a != ""


REASONS = [
    ("a", [(404, {}), (None, {"host_blocked": True, "host_challenged": True}), (None, {"not_a_pdf": True})], "client_challenged"),
    ("b", [(None, {"host_blocked": True})], "host_refused_client"),
    ("c", [(None, {"host_blocked": True, "host_denied": True})], "host_denied"),
    ("d", [(None, {"not_a_pdf": True})], "not_yet_available"),
    ("e", [(None, {"not_a_pdf": True})], "page_without_link"),
    ("f", [(404, {"source_name": "arxiv"})], "withdrawn"),
    ("g", [(None, {"wrong_document": True}), (404, {})], "wrong_document"),
]


def test_failure_reasons(spark):
    flags = ("host_blocked", "host_denied", "host_challenged", "wrong_document", "not_a_pdf")
    rows = [(k, "https://nature.com/articles/s41598.pdf", status, f.get("source_name", "x"), *[f.get(x) for x in flags], "2026-06-01" if k == "d" else "2019-01-01") for k, tries, _ in REASONS for status, f in tries]
    df = spark.createDataFrame(rows, "paper_key string, pdf_url string, http_status int, source_name string, host_blocked boolean, host_denied boolean, host_challenged boolean, wrong_document boolean, not_a_pdf boolean, published string")
    got = outcomes.failure_reasons(df, outcomes.recent(F.col("published"), F.lit("2026-06-06").cast("date")))
    assert {r.paper_key: r.reason for r in got.collect()} == {k: wanted for k, _, wanted in REASONS}


ROW = "paper_key string, provider string, payload string, exact boolean, title_match_score double, doi string, arxiv_id string, acl_id string, open_url string, hit_pos int"


def _asked(spark, provider, payload=None, doi=None):
    return spark.createDataFrame([("p", provider, payload and json.dumps(payload), True, None, doi, None, None, None, 0)], ROW)


@pytest.mark.parametrize("doi, wiley, elsevier", [("10.1002/pro.70031", True, False), ("10.1111/jan.12345", True, False), ("10.1034/j.1", True, False), ("10.1016/j.websem.2024.100822", False, True), ("10.5555/12", False, True), ("10.1049/x", False, False), ("10.1010/x", False, False), (None, False, False)])
def test_prefixes(spark, doi, wiley, elsevier):
    assert (providers.candidates(_asked(spark, "wiley", doi=doi)).count() == 1) == wiley
    assert (providers.candidates(_asked(spark, "elsevier", doi=doi)).count() == 1) == elsevier
    assert providers.candidates(_asked(spark, "wiley", doi=doi), keyed=False).count() == 0


def test_services_encode_the_slash_or_keep_it(spark):
    assert providers.candidates(_asked(spark, "wiley", doi="10.1002/pro.70031")).first().pdf_url.endswith("/10.1002%2Fpro.70031")
    assert providers.candidates(_asked(spark, "elsevier", doi="10.1016/j.x.1")).first().pdf_url.endswith("/10.1016/j.x.1")


def test_no_credential_in_a_candidate(spark):
    found = providers.candidates(_asked(spark, "openalex_content", {"has_content": {"pdf": True}, "content_urls": {"pdf": "https://content.openalex.org/x.pdf?api_key=secret"}})).first()
    assert "secret" not in str(found.asDict()) and found.fallback_only


def test_order_enables_and_unknown_names_are_left_out(spark):
    rows = _asked(spark, "arxiv").withColumn("arxiv_id", F.lit("2101.00001"))
    assert providers.candidates(rows, ["none such", "acl", "arxiv"]).first().provider_rank == 2
    assert providers.candidates(rows, ["acl"]).count() == 0
    with pytest.raises(ValueError):
        providers.candidates(rows, ["none such"])


def test_free_copies_before_metered_before_landing_pages(spark):
    columns = "paper_key string, provider string, provider_rank int, cand_pos bigint, pdf_url string, domain string, version_type string, host_type string, confidence double, is_direct_pdf boolean, title_match_score double, fallback_only boolean"
    rows = [("p", "landing", 3, 0, "https://ieeexplore.ieee.org/1", "ieeexplore.ieee.org", "publisher", "publisher", 0.5, False, None, True), ("p", "metered", 2, 0, "https://content.openalex.org/1", "content.openalex.org", "publisher", "repository", 0.88, True, None, True), ("p", "free", 1, 0, "https://repo.example/1", "repo.example", "accepted", "unknown", None, True, None, False)]
    scored = spark.createDataFrame(rows, columns).withColumn("score", resolve.score())
    good = {r.provider: r.good for r in scored.select("provider", resolve.good_enough().alias("good")).collect()}
    assert not any(good.values())
    assert scored.where("provider = 'free'").first().score == 0.4  # a confidence that is not known adds nothing
    ranked = resolve.ranked(resolve.rounds(resolve.by_url(scored.withColumn("good", resolve.good_enough()))))
    assert [r.provider for r in ranked.orderBy("rank").collect()] == ["free", "metered", "landing"]


def test_a_denied_host_comes_last_and_ends_nothing(spark):
    columns = "paper_key string, provider string, provider_rank int, cand_pos bigint, pdf_url string, domain string, version_type string, host_type string, confidence double, is_direct_pdf boolean, title_match_score double, fallback_only boolean"
    rows = [("p", "a", 1, 0, "https://www.nature.com/1.pdf", "nature.com", "publisher", "publisher", 0.95, True, None, False), ("p", "b", 2, 0, "https://arxiv.org/1.pdf", "arxiv.org", "preprint", "preprint", 0.9, True, None, False)]
    df = spark.createDataFrame(rows, columns)
    run = lambda denied: resolve.ranked(resolve.rounds(resolve.by_url(resolve.denied(df, denied)).withColumn("score", resolve.score()).withColumn("good", resolve.good_enough(avoided=denied)))).orderBy("round", "rank").collect()
    assert [(r.provider, r.round) for r in run(())] == [("a", 1), ("b", 2)]
    assert [(r.provider, r.round) for r in run(("nature.com",))] == [("b", 1), ("a", 1)]


@pytest.mark.parametrize("markup", ['<a href="/content/CVPR2025/papers/Peng_CVPR_2025_paper.pdf">pdf</a>', '<a href="/content/CVPR2019/papers/x.pdf">[pdf]</a>', '<a href="/content/x.pdf"> [pdf] </a>', '<a class="btn" href="/content/x.pdf">PDF</a>', '<meta name="citation_pdf_url" content="https://openaccess.thecvf.com/a.pdf">'])
def test_link_texts_of_the_vision_archive(spark, markup):
    got = spark.createDataFrame([(markup,)], "m string").select(html.cvf_file(F.col("m")).alias("f")).first().f
    assert got.startswith("https://openaccess.thecvf.com/") and got.endswith(".pdf")


def test_phrases_stay_in_one_column(spark):
    df = spark.createDataFrame([("A graph", "neural thing"), ("x", "graph neural")], "title string, abstract string")
    assert [r.title for r in df.where(search.matches('"graph neural"', F.col("title"), F.col("abstract"))).collect()] == ["x"]


def test_every_parameter_of_a_query_counts(spark):
    papers = spark.createDataFrame([(1, "tides", None, 2020, "2020-05-01", "V", 3, ["Review"], ("u",)), (2, "tides", None, 2021, "2021-05-01", "W", 9, ["Journal"], (None,))], "i int, title string, abstract string, year int, publicationDate string, venue string, citationCount int, publicationTypes array<string>, openAccessPdf struct<url:string>")
    for params, wanted in [({}, {1, 2}), ({"venue": "V, X"}, {1}), ({"publicationTypes": "Journal"}, {2}), ({"openAccessPdf": ""}, {1}), ({"publicationDateOrYear": "2021-"}, {2}), ({"minCitationCount": "5"}, {2})]:
        assert {r.i for r in search.run_queries(papers, [("q", 0, "tides", params)]).collect()} == wanted
        assert {r.i for r in search.searched(papers, "tides", params).collect()} == wanted


def test_all_recorded_edges_are_kept(spark):
    raw = spark.range(12_000).select(F.lit("s").alias("seed"), F.lit("citation").alias("edge_type"), F.col("id").alias("pos"), (F.col("id") % 2 == 0).alias("is_influential"), F.lit("2020-01-01").alias("publication_date"))
    kept = graph.edges(raw)
    assert kept.count() == 12_000 and graph.edges(raw, max_results=10).count() == 10
    one = graph.per_seed(spark.createDataFrame([("s",), ("t",)], "seed string"), raw, kept).orderBy("seed").collect()
    assert (one[0].raw_citations, one[0].citations_truncated, one[1].raw_citations) == (12_000, True, 0)


def test_settings():
    made = config.parse('{"resolution": {"denied_hosts": ["acm.org"], "stop_confidence_threshold": 0.8}}')
    assert made.resolution.denied_hosts == ("acm.org",) and made.files.min_pdf_bytes == 1024
    for bad in ("[1]", "{broken", '{"odd": {}}', '{"files": {"odd": 1}}', '{"files": {"max_pdf_bytes": 10}}', '{"resolution": {"source_priority": []}}', '{"resolution": {"title_similarity_threshold": 2}}', '{"output": {"root_dir": " "}}'):
        with pytest.raises(config.ConfigurationError):
            config.parse(bad)
    assert config.configured({"CORE_API_KEY": "k", "WILEY_TDM_TOKEN": " "}) == {"core"}


def test_options_are_given_once():
    assert config.graph_options({"max_results": 5}) == {"max_results": 5} and config.graph_options(influential_only=False, max_results=3) == {"max_results": 3}
    with pytest.raises(ValueError):
        config.graph_options({"max_results": 5}, influential_only=True)


def test_staging_and_versions(spark):
    df = spark.createDataFrame([("https://qa.x.org/a",), ("https://xplorestaging.ieee.org/",), ("https://localhost/a",), ("https://x.org/a",)], "u string")
    assert [r.s for r in df.select(urls.is_staging(F.col("u")).alias("s")).collect()] == [True, True, False, False]
    df = spark.createDataFrame([("publishedVersion", "vor"), ("submittedVersion", "submitted"), ("odd", None), (None, "am")], "a string, b string")
    assert [tuple(r) for r in df.select(urls.open_version(F.col("a")), urls.link_version(F.col("b"))).collect()] == [("publisher", "publisher"), ("preprint", "preprint"), ("odd", "unknown"), ("unknown", "accepted")]


def test_title_search_only_where_no_identifier_answered(spark):
    papers = spark.createDataFrame([("p", "10.1/x", "T"), ("q", "10.1/y", "T")], "paper_key string, doi string, title string").withColumns({c: F.lit(None).cast("string") for c in ("arxiv_id", "pmcid", "pmid")})
    answers = spark.createDataFrame([("crossref", "doi", "10.1/x", 0, "{}", 200, None), ("crossref", "doi", "10.1/y", 0, None, 404, None), ("crossref", "title", "T", 0, "{}", 200, None), ("crossref", "title", "T", 7, "{}", 200, None)], "provider string, lookup_kind string, lookup_key string, hit_pos int, payload string, status int, error string")
    papers = papers.withColumn("doi", F.replace("doi", F.lit("10.1/"), F.lit("10.1000/")))
    answers = answers.withColumn("lookup_key", F.replace("lookup_key", F.lit("10.1/"), F.lit("10.1000/")))
    got = lookups.answered(lookups.requests(papers).where("provider = 'crossref'"), answers)
    assert sorted((r.paper_key, r.kind, r.exact, r.hit_pos) for r in got.collect()) == [("p", "doi", True, 0), ("q", "title", False, 0)]


def test_inputs(spark, tmp_path):
    for name in ("b.pdf", "A.PDF", "x.txt"):
        (tmp_path / name).write_bytes(b"%PDF-")
    assert [r.raw.rsplit("/", 1)[1] for r in readers.inputs(spark, f"{tmp_path}/").collect()] == ["A.PDF", "b.pdf"]
    (tmp_path / "in.json").write_text('{"paperIds": ["10.1000/x", 5]}')
    assert [r.kind for r in readers.inputs(spark, f"{tmp_path}/in.json").collect()] == ["doi", "title_or_unknown"]
    with pytest.raises(ValueError):
        readers.parse_inputs(5)


def test_waits(spark):
    df = spark.createDataFrame([(1, "3"), (3, "soon"), (2, None)], "n int, h string")
    assert [tuple(r) for r in df.select(asked.backoff(F.col("n")), asked.retry_after(F.col("h"))).collect()] == [(2.0, 3.0), (8.0, 60.0), (4.0, 60.0)]
    assert spark.createDataFrame([("PMC123", "https://pmc.ncbi.nlm.nih.gov/x")], "a string, u string").select(ids.is_interstitial(F.col("u"), F.lit("<b>Preparing to download</b>")).alias("i")).first().i

import json

from pyspark.sql import functions as F

from scholarlake.operators import bundle, graph, providers
from scholarlake.sources import readers, writers

ROW = "paper_key string, provider string, payload string, exact boolean, title_match_score double, doi string, arxiv_id string, acl_id string, open_url string, hit_pos int"


def test_query_file():
    rows, unknown = readers.parse_queries(json.dumps({"defaults": {"year": "2020-", "min_citations": 0, "odd": 1}, "queries": {"a": {"query": "x", "min_citations": 5}, "b": {"query": "y"}, "c": {}}}))
    assert [(r[0], r[1], r[3]) for r in rows] == [("a", 0, {"year": "2020-", "minCitationCount": "5"}), ("b", 1, {"year": "2020-"})]
    assert unknown == ["a.odd", "b.odd"]


def test_id_list(spark):
    assert [r.raw for r in readers.id_list(spark, '["a", " ", "b"]').orderBy("input_pos").collect()] == ["a", "b"]
    assert [r.raw for r in readers.id_list(spark, "a, b,,c").orderBy("input_pos").collect()] == ["a", "b", "c"]


def test_provider_answers(spark):
    deposit = {"hits": {"hits": [{"metadata": {"access_right": "open"}, "files": [{"key": "a.pdf", "size": 5, "links": {"self": "https://zenodo.org/s.pdf"}}, {"key": "b.PDF", "size": 9, "links": {"self": "https://zenodo.org/big.pdf"}}, {"key": "c.csv", "size": 99, "links": {"self": "x"}}]}]}}
    links = {"message": {"link": [{"URL": "https://p.org/a.pdf", "content-type": "application/pdf", "content-version": "vor", "intended-application": "text-mining"}, {"URL": "https://p.org/b.pdf", "intended-application": "similarity-checking"}, {"URL": "https://staging.p.org/c.pdf"}]}}
    rows = [
        ("p", "zenodo", json.dumps(deposit), True, None, None, None, None, None, 0),
        ("p", "crossref", json.dumps(links), False, 0.9, "10.1/x", None, None, None, 0),
        ("p", "crossref", "no json", True, None, None, None, None, None, 1),
        ("p", "arxiv", None, True, None, None, "2101.00001", None, None, 0),
        ("p", "wiley", None, True, None, "10.1002/a.b(c)", None, None, None, 0),
        ("p", "elsevier", None, True, None, "10.1002/a", None, None, None, 0),
        ("p", "metadata_open_access", None, True, None, None, None, None, "https://www.ncbi.nlm.nih.gov/pmc/articles/PMC123456/", 0),
    ]
    got = {(r.provider, r.pdf_url): r for r in providers.candidates(spark.createDataFrame(rows, ROW)).collect()}
    assert set(got) == {("zenodo", "https://zenodo.org/big.pdf"), ("crossref", "https://p.org/a.pdf"), ("arxiv", "https://arxiv.org/pdf/2101.00001"), ("wiley", "https://api.wiley.com/onlinelibrary/tdm/v1/articles/10.1002%2Fa.b%28c%29"), ("metadata_open_access", "https://europepmc.org/articles/PMC123456?pdf=render")}
    link = got["crossref", "https://p.org/a.pdf"]
    assert (link.confidence, link.version_type, link.provider_rank) == (0.60, "publisher", 8)


def test_bundle_contract(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", {}), (2, None, {"DOI": "10.1/x"}), (3, " ", {})], "idx int, paperId string, externalIds map<string,string>")
    good = df.withColumn("_provenance", bundle.provenance(matched=F.array(F.lit("q"))))
    full = writers.export_bundle(good, str(tmp_path / "b"), "keyword_search", {"queries": {"q": "x"}}, ["q"])
    assert full["counts"] == {"total_unique_papers": 2, "identity_dropped": 1}
    assert json.loads((tmp_path / "b" / "manifest.json").read_text())["run_type"] == "keyword_search"
    assert [r.violation for r in bundle.violations(good, "by_id").orderBy("idx").collect()] == ["no input id"] * 3


def test_fetch_keeps_what_was_asked(spark):
    asked = spark.createDataFrame([(0, "10.1/x"), (1, "nonsense"), (2, "a" * 40), (3, "a" * 40)], "input_pos bigint, raw string")
    papers = spark.createDataFrame([("DOI:10.1/X", "T")], "lookup_id string, title string")
    got = [(r.input_pos, r.fetch_status) for r in graph.fetch_by_id(asked, papers).orderBy("input_pos").collect()]
    assert got == [(0, "found"), (1, "invalid_id"), (2, "not_found"), (3, "not_found")]


def test_commands(spark, tmp_path):
    from scholarlake.__main__ import main

    pages = tmp_path / "pages" / "cat=a"
    pages.mkdir(parents=True)
    (pages / "1.json").write_text(json.dumps({"total": 2, "data": [{"paperId": "p1", "title": "One title", "citationCount": 1}, {"paperId": "p2", "title": "Another", "citationCount": 2}]}))
    (pages / "2.json").write_text(json.dumps({"total": 1, "data": [{"paperId": "p1", "title": "One title"}]}))
    (tmp_path / "q.json").write_text(json.dumps({"queries": {"a": {"query": "tides"}}}))
    main(["preview", f"{tmp_path}/pages/cat=*", f"{tmp_path}/q.json"], spark)
    made = main(["keyword", f"{tmp_path}/pages/cat=*", f"{tmp_path}/q.json", f"{tmp_path}/out"], spark)
    assert made["counts"]["total_unique_papers"] == 2 and made["queries"] == {"a": "tides"}
    spark.createDataFrame([("DOI:10.1000/x", "p9", {"DOI": "10.1000/x"})], "lookup_id string, paperId string, externalIds map<string,string>").write.parquet(f"{tmp_path}/papers")
    assert main(["by-id", "10.1000/X, nonsense", f"{tmp_path}/papers", f"{tmp_path}/ids"], spark)["run_type"] == "by_id"
    edge = {"seed": "s", "edge_type": "citation", "pos": 0, "is_influential": True, "intents": [], "contexts": [], "paper": {"paperId": "p", "publicationDate": "2020-01-01"}}
    (tmp_path / "edges.json").write_text("\n".join(json.dumps(edge | {"edge_type": t}) for t in ("citation", "reference")))
    assert main(["citations", f"{tmp_path}/edges.json", f"{tmp_path}/g", "--references"], spark)["counts"]["total_unique_papers"] == 1
    assert main(["citations", f"{tmp_path}/edges.json", f"{tmp_path}/h"], spark)["counts"]["total_unique_papers"] == 2

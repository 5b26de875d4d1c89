import difflib
import json

from pyspark.sql import functions as F

from scholarlake.functions import html, ids, text, urls
from scholarlake.operators import hosts, identity, joins, outcomes, search


def _one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x")).alias("y")).first().y


def test_identifiers(spark):
    assert _one(spark, ids.doi, "https://doi.org/10.1000/ABC.1).") == "10.1000/abc.1"
    assert _one(spark, ids.doi, "nothing") is None
    assert _one(spark, ids.arxiv, "https://arxiv.org/pdf/2101.00001v2.pdf") == "2101.00001"
    assert _one(spark, ids.arxiv_of_doi, "10.48550/arXiv.2101.00001") == "2101.00001"
    assert _one(spark, ids.arxiv_of_dblp, "journals/corr/abs-2101-00001") == "2101.00001"
    assert _one(spark, ids.graph_id, "corpusid:5") == "CorpusId:5"
    assert _one(spark, ids.graph_id, "12345") is None
    assert _one(spark, ids.batch_id, "cs/0612033") is None
    assert _one(spark, ids.kind_of_input, "cs/0612033") == "arxiv"
    assert _one(spark, ids.surname, "Doe, Jane") == "doe"


def test_urls(spark):
    assert _one(spark, urls.host, "https://user@www.dl.acm.org:443/x") in ("www.dl.acm.org", "dl.acm.org")
    assert _one(spark, urls.suffixes, "a.b.c") == ["a.b.c", "b.c", "c"]
    assert _one(spark, lambda c: urls.under(c, ("acm.org",)), "dl.acm.org") is True
    assert _one(spark, lambda c: urls.under(c, ("acm.org",)), "notacm.org") is False
    assert _one(spark, urls.publisher_of_doi, "10.1145/1") == "ACM"


def test_inverted_index(spark):
    index = json.dumps({"the": [0, 3], "cat": [1], "sat": [5], "dog": [3]})
    assert _one(spark, text.from_inverted_index, index) == "the cat dog sat"
    assert _one(spark, text.from_inverted_index, "no json") is None


def test_similarity_and_bound(spark):
    pairs = [("deep nets", "deep net"), ("", "x"), ("same", "same"), ("abc", "xyz")]
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", text.similarity("a", "b").alias("s"), text.similarity_bound(F.col("a"), F.col("b")).alias("u")).collect()
    for r in rows:
        assert r.s == (difflib.SequenceMatcher(None, r.a, r.b).ratio() if r.a and r.b else 0.0)
        assert r.u >= r.s


def test_pages():
    page = "<html><head><meta content='/f/1.pdf' name='citation_pdf_url'></head><body><a href='https://elsewhere.test/x.pdf'>x</a></body></html>"
    assert html.pdf_link_of(page, "https://j.example.org/a") == "https://j.example.org/f/1.pdf"
    assert html.pdf_link_of("<a href='https://elsewhere.test/x.pdf'>", "https://j.example.org/a") is None
    assert html.pdf_link_of("<a href='/index.php/j/article/download/1/2'>", "https://j.example.org/a") == "https://j.example.org/index.php/j/article/download/1/2"
    long = "Words of an abstract that goes on for long enough to be taken as one by the rules. " * 2
    assert html.abstract_of(f'<script type="application/ld+json">[{{"description": "Abstract: {long}"}}]</script>', None) == long.strip()
    assert html.abstract_of(f"<meta name='description' content='{long}'>", "Unknown") == long.strip()
    assert html.abstract_of(f"<section data-title='Abstract'><p>{long}</p></section>", "Springer") == long.strip()
    assert html.abstract_of(None, None) is None and html.abstract_of("<p", "ACM") is None


def test_page_counts(spark):
    cases = {"107-122": 16, "1049-58": 10, "5": 1, "e123": None, "9-3": None, "1-900": None, "n.d.": None}
    for given, wanted in cases.items():
        assert _one(spark, identity.page_count, given) == wanted, given


def test_identity(spark):
    body = "An introduction to many things that fill a page with words and more words of prose. " * 8
    schema = "doi string, arxiv_id string, title string, page_range string, source_url string, front_text string, title_text string, n_pages int, embedded_title string"
    rows = [
        ("10.1/x", None, "T", None, None, f"{body} doi 10.1/X", None, 3, None),
        (None, None, "A Title of Some Length", None, None, f"A Title of\nSome Len-\ngth {body}", None, 3, None),
        (None, None, "A Title of Some Length", None, None, body, None, 3, "Quite Another Document with a Long Name of Its Own"),
        (None, None, None, None, None, body, None, 3, None),
        (None, None, "A Title of Some Length", "1-20", None, f"A Title of Some Length {body}", None, 2, None),
        (None, None, "A Title", None, None, "short", None, 2, None),
        (None, "2101.1", "Other", None, "https://arxiv.org/pdf/2101.1v2", body, None, 4, None),
    ]
    got = [(r.state, r.signal) for r in identity.verified(spark.createDataFrame(rows, schema)).collect()]
    assert got == [("verified", "doi-in-text"), ("verified", "title-on-page"), ("wrong", "calls-itself-otherwise"), ("no_reference", "nothing-known"), ("truncated", "title-on-page"), ("unreadable", "no-text"), ("verified", "arxiv-in-url")]


def test_reasons_by_precedence(spark):
    schema = "paper_key string, pdf_url string, http_status int, source_name string, host_blocked boolean, host_denied boolean, host_challenged boolean, wrong_document boolean, not_a_pdf boolean"
    rows = [("a", "u", 404, "x", False, False, False, False, False), ("a", "u", None, "x", True, False, True, False, False), ("b", "u", 404, "arxiv", False, False, False, False, False), ("c", "u", 404, "x", False, False, False, True, False), ("d", "u", None, "x", None, None, None, None, None)]
    got = {r.paper_key: r.reason for r in outcomes.failure_reasons(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"a": "client_challenged", "b": "withdrawn", "c": "wrong_document", "d": "transient"}


def test_responses(spark):
    schema = "status int, final_url string, headers map<string,string>, body string"
    rows = [(200, "https://x.org", {"CF-Mitigated": "challenge"}, "ok"), (403, "https://x.org", {}, ""), (403, "https://x.org", {}, "x" * 5000), (403, "https://api.x.org", {}, ""), (200, "https://x.org", {}, "a paper on captcha"), (200, "https://x.org", {}, "Just a moment...")]
    df = spark.createDataFrame(rows, schema).select(hosts.response_kind(F.col("status"), F.col("final_url"), F.col("headers"), F.col("body"), api_hosts=("api.x.org",)).alias("k"))
    assert [r.k for r in df.collect()] == ["challenge", "refusal", None, None, None, "challenge"]


def test_keywords(spark):
    papers = [(1, "Graph Neural Networks", None), (2, "neural nets", "about graphs"), (3, "Networks", "graph mining"), (4, None, None)]
    df = spark.createDataFrame(papers, "i int, title string, abstract string")
    run = lambda q: [r.i for r in df.where(search.matches(q, F.col("title"), F.col("abstract"))).orderBy("i").collect()]
    assert run('"neural networks"') == [1]
    assert run("graph* + (mining | nets)") == [2, 3]
    assert run("graph -mining") == [1]
    assert run("neural | mining") == [1, 2, 3]


def test_first_key(spark):
    records = spark.createDataFrame([(1, "a", "b"), (2, "z", "b"), (3, None, None)], "i int, k1 string, k2 string")
    results = spark.createDataFrame([("b", 2, "late"), ("b", 1, "early"), ("a", 3, "own")], "k string, result_pos int, v string")
    got = joins.first_key(records, "i", [F.col("k1"), F.col("k2")], results, [F.col("k")], ["v"]).orderBy("i").collect()
    assert [r.v for r in got] == ["own", "early", None]

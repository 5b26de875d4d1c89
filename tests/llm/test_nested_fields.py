from scholarlake.llm import fusion

LOG = "category string, normalized_title string, kept_paperId string, kept_citations int, dropped_paperId string, dropped_citations int, run_id string, logged_at int"
PAPERS = "paperId string, cat string, title string, abstract string, year int, venue string, publicationDate string, citationCount int, url string, isOpenAccess boolean, publicationTypes array<string>, authors array<struct<authorId:string,name:string>>, externalIds map<string,string>, openAccessPdf struct<url:string,license:string,status:string>, publicationVenue struct<name:string,alternate_names:array<string>>"


def test_nested_fields_are_completed(spark):
    log = spark.createDataFrame([("c", "t", "p1", 9, "p2", 3, "r", 1)], LOG)
    flat = ("T", None, 2020, None, None, None, None)
    rows = [
        ("p1", "c", *flat, None, [], [("7", "Ada")], {"DOI": "10.1/a", "MAG": " "}, (None, None, "GREEN"), None),
        ("p2", "c", *flat, True, ["Review"], [("8", "Bo")], {"DOI": "10.1/b", "MAG": "5"}, ("http://x", None, "GOLD"), ("V", ["v", "w"])),
    ]
    got = fusion.completed(log, spark.createDataFrame(rows, PAPERS)).first()
    assert got.survivor_id == "p1" and got.isOpenAccess is True and got.publicationTypes == ["Review"]
    assert [tuple(a) for a in got.authors] == [("7", "Ada")]
    assert got.externalIds == {"DOI": "10.1/a", "MAG": "5"}
    assert tuple(got.openAccessPdf) == ("http://x", None, "GREEN") and tuple(got.publicationVenue) == ("V", ["v", "w"])
    assert got.n_fields == 8


def test_nested_fields_nobody_gives_are_null(spark):
    log = spark.createDataFrame([("c", "t", "p1", 9, "p2", 3, "r", 1)], LOG)
    rows = [("p1", "c", "T", *[None] * 6, None, None, None, {}, None, (None, []))]
    got = fusion.completed(log, spark.createDataFrame(rows, PAPERS)).first()
    assert [got[f] for f in fusion.TYPED] == [None] * 6 and got.n_fields == 1

import difflib
import random

from pyspark.sql import functions as F

from scholarlake.operators import joins
from scholarlake.plans.records import QUERIES


def test_titles_with_another_first_word_are_compared(spark, tmp_path):
    hits = [(1, "Toward lightweight morphological tagging with sparse lexicons", 2020), (2, "A study of nothing in particular", 2020), (3, "Toward lightweight morphological tagging with sparse lexicons", 1999), (4, "...", 2020), (5, "Open graphs without a year at all", None)]
    records = [(7, "Towards lightweight morphological tagging with sparse lexicons", 2020), (8, "Lattice methods for tides", 2020), (9, "...", 2020), (10, "Opn graphs without a year at all", None)]
    spark.createDataFrame(hits, "hit_id bigint, title string, year int").write.parquet(f"{tmp_path}/arxiv_hits.parquet")
    spark.createDataFrame(records, "record_id bigint, title string, year int").write.parquet(f"{tmp_path}/paper_records.parquet")
    got = {(x.hit_id, x.record_id) for x in QUERIES["similar_titles"](spark, str(tmp_path)).collect()}
    assert got == {(1, 7), (5, 10)}


def test_similar_titles_equal_all_pairs_compared(spark, monkeypatch):
    monkeypatch.setattr(joins, "PIECE", 7)
    rng = random.Random(5)
    words = "graph route model tide lattice query sparse token yield alloy".split()

    def slip(t):
        for _ in range(rng.randrange(6)):
            k = rng.randrange(len(t))
            t = t[:k] + rng.choice(["", "x", " ", t[k] * 2]) + t[k + 1 :]
        return " ".join(t.split())

    base = [" ".join(rng.choices(words, k=rng.randrange(2, 9))) for _ in range(12)] + ["long title " * 30]
    one = [(i, slip(rng.choice(base)), i % 2) for i in range(40)]
    two = [(i, slip(rng.choice(base)), i % 2) for i in range(60)]
    l, r = spark.createDataFrame(one, "i int, t string, y int"), spark.createDataFrame(two, "k int, u string, y int")
    got = sorted((x.i, x.k, x.score, x["rank"]) for x in joins.similar_titles(l, "i", "t", r, "k", "u", [F.col("y")], [F.col("y")]).collect())
    want = []
    for i, t, y in one:
        near = sorted((-s, k) for k, u, z in two if z == y and (s := difflib.SequenceMatcher(None, t, u).ratio()) >= 0.9)
        want += [(i, k, round(-s, 6), n + 1) for n, (s, k) in enumerate(near[:3])]
    assert got == sorted(want) and any(0.9 <= s < 1 for _, _, s, _ in want)

"""Order-aware deduplication against a sequential simulation."""

import random
import re

from pyspark.sql import functions as F

from scholarlake.functions.text import dedup_title
from scholarlake.operators import dedup

SCHEMA = "cat string, cat_pos int, pos bigint, paperId string, title string, citationCount int"


def _rows(n, seed):
    r = random.Random(seed)
    return [(f"c{c}", c, p, r.choice([None, "", " ", *[f"id{k}" for k in range(8)]]), r.choice([None, "", "A B", "a-b", "A b (Preprint)", "Other v2", "other", "YOLOv5", "x y"]), r.choice([None, 0, 1, 2, 2, 5])) for c in range(3) for p in range(n)]


def _norm(title):
    t = re.sub(r"\s*[(\[]?\s*(extended version|extended abstract|preprint|arxiv|v\d+|version \d+|workshop version|camera ready|camera-ready|under review|technical report)\s*[)\]]?\s*$", "", (title or "").lower())
    return re.sub(r"\s+", " ", re.sub(r"[^a-z0-9\s]", "", t)).strip()


def _simulate(rows, across):
    slots, order, audit = {}, [], []
    for row in sorted(rows, key=lambda x: (x[1], x[2])):
        key = _norm(row[4]) if across else (row[0], _norm(row[4]))
        if not _norm(row[4]):
            continue
        if key not in slots:
            slots[key] = [row, row]
            order.append(key)
            continue
        keep = slots[key][0]
        win = (row[5] or 0) > (keep[5] or 0)
        audit.append((row[0], row[2], (row if win else keep)[3], (keep if win else row)[3]))
        if win:
            slots[key][0] = row
    return {(s[1][0], s[1][2], s[0][0], s[0][2]) for s in slots.values()}, sorted(audit, key=str)


def test_titles_like_a_sequential_pass(spark):
    for seed in range(4):
        rows = _rows(14, seed)
        df = spark.createDataFrame(rows, SCHEMA)
        for across in (False, True):
            slots, audit = _simulate(rows, across)
            kept = dedup.by_title(df, across, keep_blank=False).select("owner", "slot", "cat", "pos").collect()
            assert {tuple(r) for r in kept} == slots
            seen = dedup.title_collisions(df, across).select("category", "pos", "kept_paperId", "dropped_paperId").collect()
            assert sorted((tuple(r) for r in seen), key=str) == audit


def test_ids_first_wins_and_blank_ids_stay(spark):
    df = spark.createDataFrame([("a", 0, 1, "x", "t", 1), ("a", 0, 2, "x", "t", 9), ("a", 0, 3, None, "t", 0), ("a", 0, 4, " ", "t", 0), ("b", 1, 1, "x", "t", 0)], SCHEMA)
    within = dedup.by_id_within(df)
    assert sorted((r.cat, r.pos) for r in within.collect()) == [("a", 1), ("a", 3), ("a", 4), ("b", 1)]
    assert sorted((r.cat, r.pos) for r in dedup.by_id_across(within).collect()) == [("a", 1), ("a", 3), ("a", 4)]
    assert [tuple(r) for r in dedup.memberships(df).collect()] == [("x", ["a", "b"])]


def test_title_key(spark):
    given = ["YOLOv5", "Deep Nets (Extended Version)", "İstanbul", None, "A -- B [v2]"]
    df = spark.createDataFrame([(g,) for g in given], "t string").select(dedup_title(F.col("t")).alias("n"))
    assert [r.n for r in df.collect()] == ["yolo", "deep nets", "istanbul", "", "a b"]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert dedup.by_title(df).count() == 0
    assert dedup.title_collisions(df).count() == 0
    assert dedup.id_report(df).count() <= 1

"""Joins that need more than an equality of one key."""

from __future__ import annotations

import difflib
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from scholarlake.functions import text


def first_key(records: DataFrame, record_id: str, keys: list[Column], results: DataFrame, result_keys: list[Column], values: list[str]) -> DataFrame:
    """Each record with the result under its first key that has one (left
    join); of results under one key the first by ``result_pos`` counts."""
    lines = lambda cols: F.explode(F.filter(F.array(*[F.struct(F.lit(i).alias("order"), c.alias("key")) for i, c in enumerate(cols)]), lambda x: x["key"].isNotNull())).alias("k")
    indexed = results.select(lines(result_keys), "result_pos", *values).groupBy("k.key").agg(F.min_by(F.struct(*values), "result_pos").alias("v"))
    asked = records.select(F.col(record_id), lines(keys)).select(record_id, "k.order", "k.key")
    best = asked.join(indexed, "key").groupBy(record_id).agg(F.min_by("v", "order").alias("v"))
    return records.join(best, record_id, "left").select(*records.columns, *[F.col(f"v.{v}").alias(v) for v in values])


#: Titles of one block that are compared at once, on each side; a block of more is split.
PIECE = 4000
_SCORED = pa.schema([("block", pa.string()), ("a", pa.string()), ("b", pa.string()), ("score", pa.float64())])


def _letters(titles: list[str], letters: dict[str, int]) -> np.ndarray:
    """How often each letter stands in each title."""
    out = np.zeros((len(letters), len(titles)), dtype=np.uint16)
    for i, t in enumerate(titles):
        for c, n in Counter(t).items():
            out[letters[c], i] = n
    return out


def _scored(one: pa.Table, two: pa.Table, threshold: float) -> pa.Table:
    """All pairs of two pieces of a block at or above the threshold.  No ratio is
    above twice the letters in common over the letters of both, so a pair that
    this bound rules out is left out without loss."""
    left, right = (sorted(t.column(c).to_pylist(), key=len) for t, c in ((one, "a"), (two, "b")))
    rows = []
    if left and right:
        letters = {c: i for i, c in enumerate(sorted(set("".join(left)) | set("".join(right))))}
        ml, mr = _letters(left, letters), _letters(right, letters)
        ll, lr = np.array([len(t) for t in left]), np.array([len(t) for t in right])
        # counts of a title below 256 letters add up within a byte
        small = np.uint8 if max(ll[-1], lr[-1]) < 256 else np.uint32
        ml, mr = ml.astype(small), mr.astype(small)
        reach = (2 - threshold) / threshold if threshold > 0 else np.inf
        for i in range(0, len(left), 64):
            la = ll[i : i + 64]
            # a slack of one letter, as the exact bound follows
            lo = np.searchsorted(lr, la[0] / reach - 1)
            hi = np.searchsorted(lr, la[-1] * reach + 1, "right")
            if lo >= hi:
                continue
            common = np.zeros((len(la), hi - lo), dtype=small)
            least = np.empty_like(common)
            for x, y in zip(ml[:, i : i + 64], mr[:, lo:hi]):
                if x.any():
                    np.minimum(x[:, None], y[None, :], out=least)
                    np.add(common, least, out=common)
            total = la[:, None] + lr[None, lo:hi]
            ks, js = np.nonzero(2.0 * common / total >= threshold)
            matcher, last = difflib.SequenceMatcher(), -1
            for j, k in sorted(zip((js + lo).tolist(), (ks + i).tolist())):
                if left[k] == right[j]:
                    rows.append((left[k], right[j], 1.0))
                    continue
                if j != last:
                    matcher.set_seq2(right[j])
                    last = j
                matcher.set_seq1(left[k])
                if (score := matcher.ratio()) >= threshold:
                    rows.append((left[k], right[j], score))
    block = (one if one.num_rows else two).column("block")[0].as_py()
    return pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*((block, *r) for r in rows)), _SCORED)] if rows else [pa.array([], t.type) for t in _SCORED], schema=_SCORED)


def similar_titles(left: DataFrame, left_id: str, left_title: str, right: DataFrame, right_id: str, right_title: str, block_left: list[Column], block_right: list[Column], threshold: float = 0.90, top: int = 3) -> DataFrame:
    """The ``top`` most similar titles at or above the threshold within a block.
    Each distinct title is compared with every one of its block: pairs whose
    letters rule the threshold out never reach the similarity function, and a
    block of many titles is split into pieces that meet pair by pair."""

    def side(df: DataFrame, key: str, title: str, block: list[Column], i: str, t: str) -> DataFrame:
        out = df.select(F.col(key).alias(i), text.match_title(F.col(title)).alias(t), F.concat_ws("\x1f", *[c.cast("string") for c in block]).alias("block"), reduce(lambda x, c: x & c.isNotNull(), block, F.lit(True)).alias("__blocked"))
        return out.where(F.col("__blocked") & (F.col(t) != "")).drop("__blocked")

    l, r = side(left, left_id, left_title, block_left, "l", "a"), side(right, right_id, right_title, block_right, "r", "b")
    la, rb = l.select("block", "a").distinct(), r.select("block", "b").distinct()
    pieces = lambda t, n: t.groupBy("block").agg(F.ceil(F.count("*") / PIECE).cast("int").alias(n))
    met = pieces(la, "n_l").join(pieces(rb, "n_r"), "block")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    la = la.join(met, "block").select("block", "a", F.pmod(F.xxhash64("a"), "n_l").cast("int").alias("i"), every("n_r").alias("j"))
    rb = rb.join(met, "block").select("block", "b", F.pmod(F.xxhash64("b"), "n_r").cast("int").alias("j"), every("n_l").alias("i"))
    by = ("block", "i", "j")
    scored = la.groupBy(*by).cogroup(rb.groupBy(*by)).applyInArrow(lambda x, y: _scored(x, y, threshold), "block string, a string, b string, score double")
    # of the rows of one title no more than the first can be among the top
    first = Window.partitionBy("block", "b").orderBy("r")
    rows = r.withColumn("__n", F.row_number().over(first)).where(F.col("__n") <= top).drop("__n")
    best = Window.partitionBy("block", "a").orderBy(F.col("score").desc(), "r")
    ranked = scored.join(rows, ["block", "b"]).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return l.join(ranked, ["block", "a"]).select(F.col("l").alias(left_id), F.col("r").alias(right_id), F.round("score", 6).alias("score"), "rank")


def year_close(a: Column, b: Column, back: int = 1, ahead: int = 1) -> Column:
    """Whether b lies within the band around a; an unknown year passes."""
    return F.coalesce((b - a).between(-back, ahead), F.lit(True))


def with_work(papers: DataFrame, doi_key: Column, works: DataFrame) -> DataFrame:
    """Papers with their registered work (``doi_key answered error`` and more):
    'found', 'absent' (asked, and there is none), 'error' or 'no_doi'."""
    joined = papers.withColumn("__k", doi_key).join(works.withColumnRenamed("doi_key", "__k"), "__k", "left")
    status = F.when(F.col("__k").isNull(), "no_doi").when(F.col("error").isNotNull() | F.col("answered").isNull(), "error").when(F.col("answered"), "found").otherwise("absent")
    return joined.withColumn("work_status", status).drop("__k")

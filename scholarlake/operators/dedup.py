"""Order-aware deduplication with an audit trail.

Papers carry ``cat`` and ``cat_pos`` (category and its rank) and ``pos`` (place
in the category); list order decides, so it is a column here.  Every operator is
one shuffle on its key and a window over it.  A key that holds a large part of
all rows would make that window one task: id deduplication therefore uses
aggregates, which combine before the shuffle, and windows run only over rows
that do share a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from scholarlake.functions.text import blank_to_null, dedup_title


def _first_of(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order``, by aggregation: the partial
    aggregate keeps one row a key and task, whatever the key's share of rows."""
    names = df.columns
    row = F.min_by(F.struct(*names), F.struct(*order)).alias("r")
    return df.groupBy(*keys).agg(row).select(*[F.col(f"r.`{n}`").alias(n) for n in names])


def by_id_within(papers: DataFrame) -> DataFrame:
    """The first row of each id in each category; rows without an id all stay."""
    key = blank_to_null(F.col("paperId"))
    named = papers.where(key.isNotNull()).withColumn("__k", key)
    return _first_of(named, ["cat", "__k"], ["pos"]).drop("__k").unionByName(papers.where(key.isNull()))


def by_id_across(papers: DataFrame) -> DataFrame:
    """The first category in query order owns an id; rows without one all stay."""
    key = blank_to_null(F.col("paperId"))
    named = papers.where(key.isNotNull()).withColumn("__k", key)
    return _first_of(named, ["__k"], ["cat_pos", "pos"]).drop("__k").unionByName(papers.where(key.isNull()))


def memberships(papers: DataFrame) -> DataFrame:
    """The categories in which each id was found: ``paperId``, ``matched``."""
    key = blank_to_null(F.col("paperId"))
    return papers.where(key.isNotNull()).groupBy(key.alias("paperId")).agg(F.array_sort(F.collect_set("cat")).alias("matched"))


def with_memberships(papers: DataFrame, found: DataFrame) -> DataFrame:
    """Each paper with its categories; its own one if none is known."""
    key = blank_to_null(F.col("paperId"))
    named = papers.where(key.isNotNull()).withColumn("__k", key)
    joined = named.join(found.select(F.col("paperId").alias("__k"), "matched"), "__k", "left").drop("__k")
    joined = joined.withColumn("matched", F.coalesce("matched", F.array("cat")))
    # rows without an id match nothing and stay out of the join
    return joined.unionByName(papers.where(key.isNull()).withColumn("matched", F.array("cat")))


def _citations() -> Column:
    return F.coalesce(F.col("citationCount").cast("bigint"), F.lit(0).cast("bigint"))


def _keyed(papers: DataFrame, across: bool) -> tuple[DataFrame, list[str], list[str]]:
    keys, order = (["norm"], ["cat_pos", "pos"]) if across else (["cat", "norm"], ["pos"])
    return papers.withColumn("norm", dedup_title(F.col("title"))), keys, order


def by_title(papers: DataFrame, across: bool = False, keep_blank: bool | None = None) -> DataFrame:
    """One paper for each normalised title (in each category, or ``across``
    them): the most cited, of equals the first; it takes the place of the first.
    Blank titles go within categories and stay across them, unless told.
    Adds ``norm``, ``owner`` (category of the place), ``slot`` (its pos) and
    ``swapped`` (the winner came from another category)."""
    keep_blank = across if keep_blank is None else keep_blank
    keyed, keys, order = _keyed(papers, across)
    names = keyed.columns
    titled = keyed.where("norm <> ''")
    place = F.struct(*order)
    best = F.min_by(F.struct(*names), F.struct((-_citations()).alias("c"), *order)).alias("r")
    first = F.min_by(F.struct("cat", "cat_pos", "pos"), place).alias("f")
    kept = titled.groupBy(*keys).agg(best, first).select(*[F.col(f"r.`{n}`").alias(n) for n in names], F.col("f.cat").alias("owner"), F.col("f.pos").alias("slot"), (F.col("f.cat") != F.col("r.cat")).alias("swapped"))
    if keep_blank:
        blank = keyed.where("norm = ''").withColumns({"owner": F.col("cat"), "slot": F.col("pos"), "swapped": F.lit(False)})
        kept = kept.unionByName(blank)
    return kept


def title_collisions(papers: DataFrame, across: bool = False) -> DataFrame:
    """The audit trail: for each paper after the first of its title, the keeper
    and the loser of the comparison as it stood then."""
    keyed, keys, order = _keyed(papers, across)
    shared = keyed.where("norm <> ''")
    counts = shared.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n > 1")
    shared = shared.join(counts, keys, "left_semi")
    me = F.struct(F.col("paperId").alias("id"), F.col("title").alias("title"), _citations().alias("cit"), F.col("cat").alias("cat"))
    w = Window.partitionBy(*keys).orderBy(*order)
    rank = F.struct(_citations().alias("c"), (-F.row_number().over(w)).alias("o"))
    ordered = shared.select(*keys, *[c for c in ("cat", "cat_pos", "pos") if c not in keys], me.alias("me"), rank.alias("rank"))
    before = F.max_by("me", "rank").over(w.rowsBetween(Window.unboundedPreceding, -1))
    seen = ordered.withColumn("keeper", before).where(F.col("keeper").isNotNull())
    wins = F.col("me.cit") > F.col("keeper.cit")
    kept, dropped = F.when(wins, F.col("me")).otherwise(F.col("keeper")), F.when(wins, F.col("keeper")).otherwise(F.col("me"))
    out = seen.select(F.col("me.cat").alias("category"), F.lit("inter" if across else "intra").alias("scope"), F.col("norm").alias("normalized_title"), "pos", kept.alias("k"), dropped.alias("d"), wins.alias("swap"))
    return out.select("category", "scope", "normalized_title", "pos", F.col("k.id").alias("kept_paperId"), F.col("k.cit").alias("kept_citations"), F.col("k.title").alias("kept_title"), F.col("k.cat").alias("kept_category"), F.col("d.id").alias("dropped_paperId"), F.col("d.cit").alias("dropped_citations"), F.col("d.title").alias("dropped_title"), F.col("d.cat").alias("dropped_category"), "swap")


def merged_memberships(papers: DataFrame, found: DataFrame, across: bool = True) -> DataFrame:
    """norm and the union of the memberships of all papers of a title."""
    keyed, keys, _ = _keyed(with_memberships(papers, found), across)
    return keyed.where("norm <> ''").select(*keys, F.explode("matched").alias("m")).groupBy(*keys).agg(F.array_sort(F.collect_set("m")).alias("matched"))


def id_report(papers: DataFrame) -> DataFrame:
    """Per category and in total: raw, intra_dupes, after_intra, inter_removed, final_unique."""
    papers = papers.select("cat", "cat_pos", "pos", "paperId")
    within = by_id_within(papers)
    counts = [papers.groupBy("cat").agg(F.count("*").alias("raw")), within.groupBy("cat").agg(F.count("*").alias("after_intra")), by_id_across(within).groupBy("cat").agg(F.count("*").alias("final_unique"))]
    return _report(counts, "raw", "intra_dupes", "after_intra", "final_unique")


def title_report(papers: DataFrame) -> DataFrame:
    """Per category and in total: input, intra_removed, after_intra, inter_removed, final_unique."""
    papers = papers.select("cat", "cat_pos", "pos", "title", "citationCount")
    within = by_title(papers).select(*papers.columns)
    across = by_title(within, across=True)
    counts = [papers.groupBy("cat").agg(F.count("*").alias("input")), within.groupBy("cat").agg(F.count("*").alias("after_intra")), across.groupBy(F.col("owner").alias("cat")).agg(F.count("*").alias("final_unique"))]
    return _report(counts, "input", "intra_removed", "after_intra", "final_unique")


def _report(counts: list[DataFrame], given: str, gone: str, after: str, final: str) -> DataFrame:
    joined = counts[0]
    for c in counts[1:]:
        joined = joined.join(c, "cat", "left")
    zero = F.lit(0).cast("bigint")
    joined = joined.select("cat", *[F.coalesce(c, zero).alias(c) for c in (given, after, final)])
    totals = joined.rollup("cat").agg(*[F.sum(c).alias(c) for c in (given, after, final)])
    return totals.select(F.coalesce("cat", F.lit("TOTAL")).alias("cat"), given, (F.col(given) - F.col(after)).alias(gone), after, (F.col(after) - F.col(final)).alias("inter_removed"), final)

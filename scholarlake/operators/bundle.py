"""Provenance, contract checks and the counts of an export bundle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from scholarlake.functions.text import blank_to_null

#: Kinds of runs, of edges and of fetches (fixed values).
RUNS = ("keyword_search", "by_id", "citation_graph")
EDGES = ("citation", "reference")
FETCHES = ("found", "not_found", "invalid_id")
PROVENANCE = "struct<matched_queries:array<string>,seed_paper_id:string,edge_type:string,is_influential:boolean,input_id:string,fetch_status:string,intents:array<string>,contexts:array<string>>"


def provenance(matched: Column | None = None, seed: Column | None = None, edge: Column | None = None, influential: Column | None = None, input_id: Column | None = None, status: Column | None = None, intents: Column | None = None, contexts: Column | None = None) -> Column:
    """Where a record came from, with all keys; empty lists of intents and
    contexts are left out (null)."""
    none = F.lit(None)
    some = lambda c: none if c is None else F.when(F.size(c) > 0, c)
    parts = [matched if matched is not None else F.array().cast("array<string>"), seed, edge, influential, input_id, status, some(intents), some(contexts)]
    names = [x.split(":")[0] for x in PROVENANCE[7:-1].replace("array<string>", "a").split(",")]
    return F.struct(*[(none if p is None else p).alias(n) for n, p in zip(names, parts)]).cast(PROVENANCE)


def has_identity(paper_id: str = "paperId", external: str = "externalIds") -> Column:
    found = [blank_to_null(F.col(paper_id)), *[blank_to_null(F.try_element_at(F.col(external), F.lit(k))) for k in ("DOI", "ArXiv")]]
    return F.coalesce(*found).isNotNull()


def violations(records: DataFrame, run: str, queries: list[str] | None = None) -> DataFrame:
    """Records (``idx``, ``_provenance``) that break the contract of a run, each
    with its first ``violation``."""
    if run not in RUNS:
        raise ValueError(f"no kind of run: {run!r}")
    p = F.col("_provenance")
    if run == "keyword_search":
        names = F.array(*[F.lit(q) for q in queries or []]).cast("array<string>")
        rule = F.when(F.coalesce(F.size(p["matched_queries"]), F.lit(0)) <= 0, "no matched query").when(F.size(F.array_except(p["matched_queries"], names)) > 0, "unknown query")
    elif run == "citation_graph":
        rule = F.when(p["seed_paper_id"].isNull(), "no seed").when(~F.coalesce(p["edge_type"].isin(*EDGES), F.lit(False)), "unknown edge").when(p["is_influential"].isNull(), "influence unknown")
    else:
        rule = F.when(p["input_id"].isNull(), "no input id").when(~F.coalesce(p["fetch_status"].isin(*FETCHES), F.lit(False)), "unknown status")
    return records.withColumn("violation", F.when(p.isNull(), "no provenance").otherwise(rule)).where("violation is not null")


def admitted(records: DataFrame, run: str, paper_id: str = "paperId", external: str = "externalIds") -> DataFrame:
    """``keep`` and ``identity_less``: records without any identity go, unless
    they are edges of a graph or were not found."""
    found = F.col("_provenance.fetch_status") == "found" if run == "by_id" else F.lit(True)
    less = F.coalesce(found, F.lit(False)) & ~has_identity(paper_id, external)
    return records.withColumns({"identity_less": less, "keep": ~less if run != "citation_graph" else F.lit(True)})


def counts(admitted_: DataFrame) -> DataFrame:
    return admitted_.agg(F.count_if("keep").alias("total_unique_papers"), F.count_if(~F.col("keep")).alias("identity_dropped"), F.count_if(F.col("keep") & F.col("identity_less")).alias("identity_less"))


def per_query(records: DataFrame) -> DataFrame:
    return records.select(F.explode("_provenance.matched_queries").alias("query")).groupBy("query").agg(F.count("*").alias("papers"))

"""Citation graph: edges of seeds, limits, summaries, and fetches by id."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from scholarlake.functions import ids

#: Edges of one seed and endpoint that the remote service can page through (fixed
#: value): so many recorded ones are a sign of more.  All that are recorded are kept.
CEILING = 9_999


def edges(raw: DataFrame, influential_only: bool = False, max_results: int | None = None, since: str | None = None, until: str | None = None) -> DataFrame:
    """Edges (``seed edge_type pos is_influential publication_date``) after the
    options; the date range holds for citations only, open at either end.  A limit,
    where one is given, counts in order of ``pos`` within seed and endpoint."""
    out = raw
    if max_results is not None:
        w = Window.partitionBy("seed", "edge_type").orderBy("pos")
        out = out.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= max_results)
    if influential_only:
        out = out.where(F.coalesce("is_influential", F.lit(False)))
    date = F.col("publication_date")
    if since:
        out = out.where((F.col("edge_type") != "citation") | (date >= since))
    if until:
        out = out.where((F.col("edge_type") != "citation") | (date <= until))
    return out.drop("nth")


def per_seed(seeds: DataFrame, raw: DataFrame, kept: DataFrame) -> DataFrame:
    """One row per seed, also for those without edges: raw and kept numbers of
    each endpoint, and whether the ceiling was reached."""
    count = lambda df, t: F.count_if(F.col("edge_type") == t)
    r = raw.groupBy("seed").agg(count(raw, "citation").alias("raw_citations"), count(raw, "reference").alias("raw_references"))
    k = kept.groupBy("seed").agg(count(kept, "citation").alias("citations"), count(kept, "reference").alias("references"))
    joined = seeds.join(r, "seed", "left").join(k, "seed", "left")
    numbers = ("raw_citations", "raw_references", "citations", "references")
    joined = joined.select(*seeds.columns, *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in numbers])
    return joined.withColumns({"citations_truncated": F.col("raw_citations") >= CEILING, "references_truncated": F.col("raw_references") >= CEILING})


def seed_errors(seeds: DataFrame) -> DataFrame:
    """Seeds (``raw``) with their canonical id as ``seed``, and ``error`` for those
    that have none; these stay as rows."""
    canonical = ids.graph_id(F.col("raw"))
    return seeds.select("*", canonical.alias("seed"), ids.id_error(F.col("raw"), canonical).alias("error"))


def outcomes(seeds: DataFrame) -> DataFrame:
    """Endpoints that failed (``citations_error``, ``references_error``) over seeds."""
    c, r = F.col("citations_error").isNotNull(), F.col("references_error").isNotNull()
    return seeds.agg(F.count_if(c).alias("citations_failed"), F.count_if(r).alias("references_failed"), F.count_if(c & r).alias("both_failed"), F.count_if(~c & ~r).alias("both_success"))


def summary(seeds: DataFrame) -> DataFrame:
    """Counters over all seeds, from ``per_seed``."""
    c, r = F.col("citations"), F.col("references")
    return seeds.agg(
        F.count("*").alias("seeds"), F.sum("raw_citations").alias("raw_citations"), F.sum("raw_references").alias("raw_references"), F.sum(c).alias("citations"), F.sum(r).alias("references"), F.count_if(c > 0).alias("with_citations"), F.count_if(r > 0).alias("with_references"),
        F.count_if((c > 0) & (r > 0)).alias("with_both"), F.count_if((c == 0) & (r == 0)).alias("with_neither"), F.count_if("citations_truncated").alias("citations_truncated"), F.count_if("references_truncated").alias("references_truncated"), F.max("raw_citations").alias("most_citations"),
    )


def fetch_by_id(asked: DataFrame, papers: DataFrame) -> DataFrame:
    """Each asked id (``input_pos raw``) with its paper: ``fetch_status`` found,
    not_found or invalid_id, in chunks of 500; as many rows as were asked."""
    key = ids.batch_id(F.col("raw"))
    stored = papers.withColumn("__id", F.lower("lookup_id"))
    names = papers.columns
    first = stored.groupBy("__id").agg(F.min_by(F.struct(*names), F.struct("lookup_id")).alias("p"))
    joined = asked.withColumn("canonical", key).withColumn("__id", F.lower("canonical")).join(first, "__id", "left")
    status = F.when(F.col("canonical").isNull(), "invalid_id").when(F.col("p").isNull(), "not_found").otherwise("found")
    return joined.select("input_pos", "raw", "canonical", F.floor(F.col("input_pos") / 500).cast("int").alias("chunk"), status.alias("fetch_status"), *[F.col(f"p.{n}").alias(n) for n in names])

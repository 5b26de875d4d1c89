"""The façade: what a caller does with a corpus, as lazy DataFrames.

``Corpus`` wraps the search rows of a run; each method is a view, and only the
export functions act.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from scholarlake import config
from scholarlake.operators import bundle, dedup, graph, providers, recovery, resolve, search
from scholarlake.sources import readers, writers


@dataclass(frozen=True)
class Corpus:
    """Search rows with ``cat``, ``cat_pos`` and ``pos``."""

    papers: DataFrame

    def preview(self) -> DataFrame:
        """How many rows each category has."""
        return self.papers.groupBy("cat").agg(F.count("*").alias("total"))

    def sample(self, n: int = 5) -> DataFrame:
        """The first rows of each category, a hundred at most."""
        nth = F.row_number().over(Window.partitionBy("cat").orderBy("pos"))
        picked = self.papers.withColumn("__n", nth).where(F.col("__n") <= min(n, 100))
        return picked.select("cat", "pos", "paperId", "title", "year", "venue", "citationCount")

    def unique(self) -> DataFrame:
        """Deduplicated by id and by title, within and across categories, with
        the categories in which a paper or another of its title was found."""
        found = dedup.memberships(self.papers)
        ids = dedup.by_id_across(dedup.by_id_within(self.papers))
        titles = dedup.by_title(dedup.by_title(ids).select(*ids.columns), across=True)
        merged = dedup.merged_memberships(ids, found).withColumnRenamed("matched", "__m")
        joined = dedup.with_memberships(titles, found).join(merged, "norm", "left")
        return joined.withColumn("matched", F.coalesce("__m", "matched")).drop("__m")

    def recovered(self, hits: DataFrame, scraped: DataFrame | None = None) -> DataFrame:
        return recovery.filled(self.unique(), hits, scraped)

    def search(self, query: str, params: dict[str, str] | None = None) -> DataFrame:
        return search.searched(self.papers, query, params)


def fetch_metadata(spark: SparkSession, pages: str, query_file: str) -> Corpus:
    """The corpus of recorded result pages, in the order of the query file."""
    order = readers.queries(spark, query_file).select(F.col("id").alias("cat"), "cat_pos")
    return Corpus(readers.search_pages(spark, pages).join(order, "cat"))


def list_runs(spark: SparkSession, path: str) -> DataFrame:
    return readers.runs(spark, path)


def fetch_papers_by_id(spark: SparkSession, ids: str, papers: DataFrame) -> DataFrame:
    return graph.fetch_by_id(readers.id_list(spark, ids), papers)


def citations_and_references(seeds: DataFrame, edges: DataFrame, options: dict | None = None, **shorthand) -> tuple[DataFrame, DataFrame]:
    """The edges after the options (an object, or one by one), and one row per seed."""
    kept = graph.edges(edges, **config.graph_options(options, **shorthand))
    return kept, graph.per_seed(seeds, edges, kept)


def resolve_candidates(answers: DataFrame, settings: config.Settings | None = None, blocked_hosts: list[str] | None = None) -> DataFrame:
    """Candidates of recorded answers, scored, in rounds, and ranked; denied hosts come
    last, and neither they nor those blocked for now end a round."""
    r = (settings or config.Settings()).resolution
    trusted = r.trusted_domains or resolve.TRUSTED
    found = resolve.by_url(providers.candidates(answers, list(r.source_priority) if r.source_priority else None))
    found = resolve.denied(found, r.denied_hosts).withColumn("score", resolve.score(r.prefer_publisher_version, r.allow_preprints, trusted, r.title_similarity_threshold))
    good = resolve.good_enough(r.prefer_publisher_version, trusted, r.stop_confidence_threshold, (*r.denied_hosts, *(blocked_hosts or ()))) if r.stop_when_confident else F.lit(False)
    return resolve.ranked(resolve.rounds(found.withColumn("good", good)))


def parse_inputs(spark: SparkSession, value: object) -> DataFrame:
    """Papers of ids, records, documents or files, with their keys."""
    return readers.inputs(spark, value)


def export_keyword_bundle(papers: DataFrame, path: str, queries: dict[str, str]) -> dict:
    """Papers of ``Corpus.unique`` as a bundle."""
    records = papers.withColumns({"idx": F.col("cat_pos").cast("bigint") * 100_000_000 + F.col("pos"), "_provenance": bundle.provenance(matched=F.col("matched"))})
    return writers.export_bundle(records, path, "keyword_search", {"queries": queries}, list(queries))


def export_by_id_bundle(fetched: DataFrame, path: str) -> dict:
    records = fetched.withColumns({"idx": F.col("input_pos"), "_provenance": bundle.provenance(input_id=F.col("raw"), status=F.col("fetch_status"))})
    return writers.export_bundle(records, path, "by_id", {})


def export_citation_bundle(edges: DataFrame, path: str) -> dict:
    nth = F.xxhash64("seed", "edge_type", "pos")
    records = edges.select(nth.alias("idx"), "paper.*", bundle.provenance(seed=F.col("seed"), edge=F.col("edge_type"), influential=F.col("is_influential"), intents=F.col("intents"), contexts=F.col("contexts")).alias("_provenance"))
    return writers.export_bundle(records, path, "citation_graph", {})

"""Commands over stored corpora: ``python -m scholarlake preview|runs|keyword|by-id|citations``.

Tables are parquet, query files and pages as the readers take them; results are written
as bundles or shown as tables.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import functions as F

from scholarlake import api, session
from scholarlake.operators import bundle
from scholarlake.sources import readers


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="scholarlake")
    commands = out.add_subparsers(dest="command", required=True)
    for name in ("preview", "keyword"):
        one = commands.add_parser(name)
        one.add_argument("pages", help="recorded result pages, in folders cat=<id>")
        one.add_argument("queries", help="the query file")
    commands.choices["keyword"].add_argument("out", help="where the bundle goes")
    runs = commands.add_parser("runs")
    runs.add_argument("path", help="audits of runs")
    by_id = commands.add_parser("by-id")
    by_id.add_argument("ids", help="a JSON list or a comma list of ids")
    by_id.add_argument("papers", help="a parquet table with lookup_id")
    by_id.add_argument("out")
    cited = commands.add_parser("citations")
    cited.add_argument("edges", help="recorded edges")
    cited.add_argument("out")
    cited.add_argument("--citations", action="store_true")
    cited.add_argument("--references", action="store_true")
    cited.add_argument("--influential-only", action="store_true")
    cited.add_argument("--max-results", type=int)
    return out


def main(arguments: list[str] | None = None, spark=None) -> dict | None:
    """Runs a command; gives the manifest of a bundle, if it wrote one."""
    a = parser().parse_args(arguments)
    spark = spark or session.session()
    if a.command == "runs":
        api.list_runs(spark, a.path).select("run_id", "status", "papers").show(truncate=False)
    elif a.command == "preview":
        api.fetch_metadata(spark, a.pages, a.queries).preview().orderBy("cat").show(truncate=False)
    elif a.command == "keyword":
        corpus = api.fetch_metadata(spark, a.pages, a.queries)
        queries = {r.id: r.query for r in readers.queries(spark, a.queries).collect()}
        return api.export_keyword_bundle(corpus.unique(), a.out, queries)
    elif a.command == "by-id":
        return api.export_by_id_bundle(api.fetch_papers_by_id(spark, a.ids, spark.read.parquet(a.papers)), a.out)
    else:
        # neither endpoint named means both
        wanted = [e for e, on in zip(bundle.EDGES, (a.citations, a.references)) if on] or list(bundle.EDGES)
        raw = readers.edges(spark, a.edges).where(F.col("edge_type").isin(*wanted)).withColumn("publication_date", F.col("paper.publicationDate"))
        kept, _ = api.citations_and_references(raw.select("seed").distinct(), raw, influential_only=a.influential_only, max_results=a.max_results)
        return api.export_citation_bundle(kept, a.out)
    return None


if __name__ == "__main__":
    if made := main():
        print(json.dumps(made, indent=2))

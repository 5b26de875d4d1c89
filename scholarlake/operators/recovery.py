"""Missing abstracts: hits of many sources, the first in a chain of priority."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window, functions as F

from scholarlake.functions import html, urls
from scholarlake.functions.text import blank_to_null, collapse, from_inverted_index, recovery_title, similarity

#: Sources in the order in which they are asked, for papers with an arXiv id and
#: for those without (fixed values).
WITH_ARXIV = ("arxiv", "openalex_doi", "openalex_title", "pubmed", "acl", "europepmc_doi", "europepmc_pmid", "crossref", "core", "semantic_scholar")
WITHOUT_ARXIV = ("openalex_doi", "pubmed", "acl", "europepmc_doi", "europepmc_pmid", "crossref", "openalex_title", "europepmc_title", "core", "semantic_scholar")


def missing(papers: DataFrame) -> DataFrame:
    return papers.where(blank_to_null(F.col("abstract")).isNull())


def first_hits(hits: DataFrame, threshold: float = 0.85) -> DataFrame:
    """Of the hits (``paperId route has_arxiv title_score text``) of a paper the
    first in its chain with a text; title hits need the threshold."""
    rank = lambda chain: F.array_position(F.array(*[F.lit(c) for c in chain]), F.col("route"))
    order = F.when(F.col("has_arxiv"), rank(WITH_ARXIV)).otherwise(rank(WITHOUT_ARXIV))
    usable = hits.withColumns({"order": order, "text": blank_to_null(F.col("text"))}).where("order > 0 and text is not null")
    usable = usable.where(~F.col("route").endswith("_title") | (F.col("title_score") >= threshold))
    best = F.min_by(F.struct("route", "text"), F.struct("order", "text")).alias("b")
    return usable.groupBy("paperId").agg(best).select("paperId", F.col("b.route").alias("source"), F.col("b.text").alias("text"))


#: What answers of all sources hold of an abstract, parsed once whichever the source.
ANSWER = """message struct<abstract:string>, abstract string, abstract_inverted_index map<string,array<int>>, resultList struct<result:array<struct<title:string,abstractText:string>>>,
results array<struct<title:string,displayTitle:string,abstract:string,abstract_inverted_index:map<string,array<int>>>>"""


def _texts(answer: Column) -> dict[str, Column]:
    """The abstract in an answer of each source, before it is tidied."""
    feed = F.from_xml("payload", "entry array<struct<title:string,summary:string>>", {"ignoreNamespace": "true", "mode": "PERMISSIVE"})
    listed = F.get(answer["resultList"]["result"], 0)["abstractText"]
    return {
        "arxiv": F.get(feed["entry"], 0)["summary"],
        "pubmed": F.when(F.length("payload") > 20, F.col("payload")),
        "acl": html.acl_abstract(F.col("payload")),
        "crossref": F.regexp_replace(answer["message"]["abstract"], "<[^>]+>", ""),
        "semantic_scholar": answer["abstract"],
        "openalex_doi": from_inverted_index(F.to_json(answer["abstract_inverted_index"])),
        "openalex_title": from_inverted_index(F.to_json(F.get(answer["results"], 0)["abstract_inverted_index"])),
        "europepmc_doi": listed,
        "europepmc_pmid": listed,
        "europepmc_title": listed,
        "core": F.get(F.filter(answer["results"], lambda w: blank_to_null(w["abstract"]).isNotNull()), 0)["abstract"],
    }


def _titles(answer: Column) -> dict[str, Column]:
    """The title of an answer to a search by title, where the source is asked so."""
    return {"openalex_title": F.get(answer["results"], 0)["title"], "europepmc_title": F.get(answer["resultList"]["result"], 0)["title"]}


def read_answers(answers: DataFrame) -> DataFrame:
    """Recorded answers (``paperId title has_arxiv route status payload``) as hits for
    ``first_hits``: a status other than 200, a payload that cannot be read and a blank
    text give none."""
    asked = answers.where(F.col("status") == 200)
    parsed = asked.withColumn("__a", F.from_json("payload", ANSWER, {"mode": "PERMISSIVE"}))
    texts, titles = _texts(F.col("__a")), _titles(F.col("__a"))
    # a generated column is computed once, whatever reads it
    pick = lambda by: F.coalesce(*[F.when(F.col("route") == r, c) for r, c in by.items()])
    read = parsed.where(F.col("route").isin(*texts)).select("paperId", "route", "has_arxiv", recovery_title(F.col("title")).alias("__own"), recovery_title(pick(titles)).alias("__hit"), F.explode(F.array(collapse(pick(texts)))).alias("text")).where("text <> ''")
    score = F.when(F.col("route").isin(*titles), similarity(F.coalesce("__own", F.lit("")), F.coalesce("__hit", F.lit(""))))
    read = read.select("paperId", "route", "has_arxiv", score.alias("title_score"), "text")
    return read


#: Pages of two publishers that stand before the DOI's own (fixed values).
PAGES_OF = {"Springer": ("https://link.springer.com/article/{0}", "https://link.springer.com/chapter/{0}", "https://www.nature.com/articles/{1}")}
PAGES_OF["Nature"] = PAGES_OF["Springer"]


def page_requests(papers: DataFrame) -> DataFrame:
    """The pages to look at for each DOI (``paperId doi``), in order of ``step``, with
    the publisher that the DOI tells; the DOI's own address comes last."""
    doi, last = F.col("doi"), F.element_at(F.split("doi", "/"), -1)
    publisher = urls.publisher_of_doi(doi)
    own = F.array(*[F.concat(*[doi if x == "{0}" else last if x == "{1}" else F.lit(x) for x in re.split(r"(\{[01]\})", u) if x]) for u in PAGES_OF["Springer"]])
    through = F.array(F.concat(F.lit("https://doi.org/"), doi))
    pages = F.when(publisher.isin(*PAGES_OF), F.concat(own, through)).otherwise(through)
    return papers.where(blank_to_null(doi).isNotNull()).select("paperId", "doi", publisher.alias("publisher"), F.posexplode(pages).alias("step", "url"))


def scraped(requests: DataFrame, pages: DataFrame) -> DataFrame:
    """The first abstract on a paper's pages (``url final_url status html``): pages of a
    publisher by its own rules, the one behind the DOI by those of the address that
    answered, else of the DOI.  ``publisher`` says whose rules they were."""
    resolved = F.coalesce(F.nullif(urls.publisher_of_url(F.coalesce("final_url", "url")), F.lit("Unknown")), F.col("publisher"))
    rules = F.when(F.col("url").startswith("https://doi.org/"), resolved).otherwise(F.col("publisher"))
    read = requests.join(pages.where("status = 200").select("url", "final_url", "html"), "url").select("paperId", "step", rules.alias("publisher"), "html")
    found = read.select("paperId", "step", "publisher", html.abstract(F.col("html"), F.col("publisher")).alias("text")).where("text is not null")
    return found.groupBy("paperId").agg(F.min_by(F.struct("publisher", "text"), "step").alias("f")).select("paperId", "f.publisher", "f.text")


def filled(papers: DataFrame, hits: DataFrame, scraped: DataFrame | None = None) -> DataFrame:
    """Papers with their abstract, the one found for it, or the scraped one;
    ``abstract_source`` says which."""
    out = papers.join(first_hits(hits).select("paperId", F.col("source").alias("__s"), F.col("text").alias("__t")), "paperId", "left")
    if scraped is not None:
        out = out.join(scraped.select("paperId", F.concat(F.lit("scrape:"), "publisher").alias("__p"), F.col("text").alias("__x")), "paperId", "left")
    else:
        out = out.withColumns({"__p": F.lit(None).cast("string"), "__x": F.lit(None).cast("string")})
    own = blank_to_null(F.col("abstract"))
    source = F.when(own.isNotNull(), "original").when(F.col("__t").isNotNull(), F.col("__s")).when(F.col("__x").isNotNull(), F.col("__p"))
    return out.withColumns({"abstract": F.coalesce(own, "__t", "__x"), "abstract_source": source}).drop("__s", "__t", "__p", "__x")


def by_source(filled_: DataFrame) -> DataFrame:
    """Recovered abstracts by source, the most frequent first, and their share of all
    that were missing."""
    was = filled_.where("abstract_source is null or abstract_source <> 'original'")
    per = was.groupBy("abstract_source").agg(F.count("*").alias("n"))
    # one row a source by now, so the total is a window over a handful of rows
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    per = per.withColumn("missing", total).where("abstract_source is not null")
    return per.select(F.col("abstract_source").alias("source"), F.col("n").alias("recovered"), F.round(100.0 * F.col("n") / F.col("missing"), 2).alias("rate")).orderBy(F.col("recovered").desc(), "source")


def by_publisher(filled_: DataFrame) -> DataFrame:
    """Missing by the publisher of the DOI, recovered by scraping by the one it
    resolved to, per category and over all (cat null)."""
    gone = filled_.where("abstract_source is null or abstract_source like 'scrape:%'").select("cat", urls.publisher_of_doi(F.col("doi")).alias("publisher"), F.lit(1).alias("missing"), F.lit(0).alias("recovered"))
    back = filled_.where("abstract_source like 'scrape:%'").select("cat", F.substring("abstract_source", 8, 200).alias("publisher"), F.lit(0).alias("missing"), F.lit(1).alias("recovered"))
    both = gone.unionByName(back)
    return both.groupingSets([["cat", "publisher"], ["publisher"]], "cat", "publisher").agg(F.sum("missing").alias("missing"), F.sum("recovered").alias("recovered"))

"""Kinds of records from registration metadata: an ordered cascade.

Input columns: ``title``, ``crossref`` (struct: DOI, type, subtype, title,
container_title, issue, update_to (array of types), online, published, issued
(arrays of date parts)) and ``openalex`` (struct: type, display_name,
is_paratext, is_retracted), as ``schemas.WORK`` declares them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Classes after which nothing is downloaded (fixed values).
TERMINAL = ("conference_abstract", "poster", "withdrawn", "paratext", "not_an_article", "correction")
#: Titles that number meeting abstracts (fixed values).
ABSTRACT_TITLES = r"(?i)^(abstract\s+[a-z]{0,3}\d+\s*[:.]|\d{1,4}[a-z]{1,3}\s+\S|[a-d]\d{1,4}-\d{1,4}\s+\S|lba\d+)"
ABSTRACT_BOOKS = r"(?i)(abstract|supplement|proceedings of the .*(meeting|congress|symposium))"
CORRECTION_TITLES = r"(?i)^\s*(erratum|corrigendum|correction to|publisher correction|author correction)\b"
#: Registered types by class (fixed values).
PARATEXT_TYPES = ("journal-issue", "journal-volume", "book-series")
OTHER_TYPES = ("dataset", "peer-review", "book", "standard", "report-component", "component", "grant", "database")
OTHER_OPEN_TYPES = ("dataset", "peer-review", "grant", "libguides")
POSTER_PREFIX = "10.26226/"


def iso_date(parts: Column) -> Column:
    """[y, m, d] as an ISO date; a missing month or day is 1; null without a year."""
    part = lambda i: F.coalesce(F.get(parts, i), F.lit(1))
    return F.when(F.get(parts, 0).isNotNull(), F.format_string("%04d-%02d-%02d", F.get(parts, 0), part(1), part(2)))


def published_online(work: Column) -> Column:
    return F.coalesce(iso_date(work["online"]), iso_date(work["published"]), iso_date(work["issued"]))


def retracted(work: Column, indexed: Column) -> Column:
    noted = F.exists(F.coalesce(work["update_to"], F.array().cast("array<string>")), lambda t: F.lower(t).contains("retraction"))
    return F.coalesce(noted, F.lit(False)) | F.coalesce(indexed["is_retracted"], F.lit(False))


def classified(records: DataFrame) -> DataFrame:
    """``record_class`` and its ``class_reason``, ``retracted`` (never a class of
    its own), ``published_online`` and ``terminal``."""
    work, indexed = F.col("crossref"), F.col("openalex")
    text = lambda c: F.coalesce(F.trim(c), F.lit(""))
    title = F.coalesce(F.nullif(text(F.col("title")), F.lit("")), F.nullif(text(work["title"]), F.lit("")), text(indexed["display_name"]))
    kind, open_kind = F.lower(text(work["type"])), F.lower(text(indexed["type"]))
    supplement, book = F.lower(text(work["issue"])).contains("suppl"), text(work["container_title"]).rlike(ABSTRACT_BOOKS)
    types = F.transform(F.coalesce(work["update_to"], F.array().cast("array<string>")), F.lower)
    rules = [
        ("conference_abstract", open_kind == "conference-abstract", "typed as a conference abstract"),
        ("conference_abstract", supplement & book, "a supplement of an abstract book"),
        ("conference_abstract", title.rlike(ABSTRACT_TITLES) & (supplement | book), "numbered title in an abstract book"),
        ("poster", F.lower(text(work["DOI"])).startswith(POSTER_PREFIX), "prefix of a poster deposit"),
        ("poster", (kind == "posted-content") & F.lower(text(work["subtype"])).isin("other", "poster"), "posted content of no article kind"),
        ("correction", title.rlike(CORRECTION_TITLES), "title begins as a correction"),
        ("correction", F.arrays_overlap(types, F.array(F.lit("correction"), F.lit("erratum"))), "registered as a correction"),
        ("paratext", F.coalesce(indexed["is_paratext"], F.lit(False)) | kind.isin(*PARATEXT_TYPES), "paratext"),
        ("not_an_article", kind.isin(*OTHER_TYPES), "registered type is no article"),
        ("not_an_article", open_kind.isin(*OTHER_OPEN_TYPES), "indexed type is no article"),
    ]
    found = F.lit(0)
    for i, (_, condition, _) in reversed(list(enumerate(rules, 1))):
        found = F.when(condition, i).otherwise(found)
    out = records.withColumn("__rule", found)
    pick = lambda k: F.get(F.array(F.lit(None).cast("string"), *[F.lit(r[k]) for r in rules]), F.col("__rule"))
    out = out.withColumns({"record_class": pick(0), "class_reason": pick(2), "retracted": retracted(work, indexed), "published_online": published_online(work)})
    return out.withColumn("terminal", F.coalesce(F.col("record_class").isin(*TERMINAL), F.lit(False))).drop("__rule")

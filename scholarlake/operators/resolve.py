"""Candidates of a paper: score, duplicates, early stop, rank, first success.

A candidate row has ``paper_key``, ``provider``, ``provider_rank`` (the order in
which providers are asked), ``cand_pos`` (place in the provider's answer) and the
columns that ``score`` reads.  All windows run within one paper.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from scholarlake.functions import urls

#: Domains whose files are trusted (fixed values; a parameter where used).
TRUSTED = (
    "arxiv.org",
    "biorxiv.org",
    "medrxiv.org",
    "aclanthology.org",
    "openaccess.thecvf.com",
    "api.openalex.org",
    "content.openalex.org",
    "api.wiley.com",
    "api.elsevier.com",
    "doi.org",
    "dl.acm.org",
    "ieeexplore.ieee.org",
    "link.springer.com",
    "nature.com",
    "sciencedirect.com",
    "pmc.ncbi.nlm.nih.gov",
    "europepmc.org",
    "zenodo.org",
    "doaj.org",
    "osf.io",
    "hal.science",
    "ssrn.com",
    "core.ac.uk",
    "mdpi.com",
    "frontiersin.org",
    "journals.plos.org",
)
THRESHOLD = 0.90
GOOD = 0.75


def score(prefer_publisher: bool = True, allow_preprints: bool = True, trusted: tuple[str, ...] = TRUSTED, threshold: float = THRESHOLD) -> Column:
    """Weights of a candidate's traits, rounded to six places."""
    version, kind, title = F.col("version_type"), F.col("host_type"), F.col("title_match_score")
    parts = (
        F.when(F.col("is_direct_pdf"), 0.20).otherwise(0.0),
        F.when(urls.under(F.lower("domain"), trusted), 0.20).otherwise(0.0),
        F.when(version == "publisher", 0.30 if prefer_publisher else 0.15).when(version == "accepted", 0.20).when(version == "preprint", 0.10 if allow_preprints else -1.00).otherwise(0.0),
        F.when(kind == "publisher", 0.10).when(kind == "repository", 0.05).otherwise(0.0),
        F.when(title.isNull(), 0.0).when(title >= threshold, 0.10).otherwise(-0.20),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce("confidence", F.lit(0.0)))) * 0.10,
    )
    return F.round(sum(parts[1:], parts[0]), 6)


def denied(candidates: DataFrame, hosts: list[str] | tuple[str, ...]) -> DataFrame:
    """Candidates of a denied host stay, as a last resort (``fallback_only``)."""
    if not hosts:
        return candidates
    return candidates.withColumn("fallback_only", F.coalesce("fallback_only", F.lit(False)) | urls.under(urls.host(F.col("pdf_url")), hosts))


def good_enough(prefer_publisher: bool = True, trusted: tuple[str, ...] = TRUSTED, least: float = GOOD, avoided: list[str] | tuple[str, ...] = ()) -> Column:
    """Whether a scored candidate allows to stop asking; one on an ``avoided`` host,
    denied or blocked for now, never does, as it will fail without a request."""
    ok = ~urls.under(urls.host(F.col("pdf_url")), avoided) if avoided else F.lit(True)
    ok = ok & ~F.col("fallback_only") & F.col("is_direct_pdf") & (F.col("score") >= least) & urls.under(F.lower("domain"), trusted)
    return F.coalesce(ok & (F.col("version_type") == "publisher") if prefer_publisher else ok, F.lit(False))


def by_url(candidates: DataFrame) -> DataFrame:
    """One candidate per paper and address: the most confident, of equals the
    first; it keeps the place at which the address was first seen (``seen``)."""
    place = F.struct("provider_rank", "cand_pos")
    names = candidates.columns
    best = F.min_by(F.struct(*names), F.struct((-F.col("confidence")).alias("c"), "provider_rank", "cand_pos")).alias("r")
    return candidates.groupBy("paper_key", "pdf_url").agg(best, F.min(place).alias("seen")).select(*[F.col(f"r.`{n}`").alias(n) for n in names], "seen")


def rounds(candidates: DataFrame) -> DataFrame:
    """The round in which each candidate is asked for: a round ends with the
    first provider that gives a good-enough candidate (column ``good``).  Windows of
    one paper, which share a shuffle with those of ``ranked``."""
    of_provider = Window.partitionBy("paper_key", "provider_rank")
    first = F.row_number().over(of_provider.orderBy(F.col("good").desc_nulls_last())) == 1
    ends = F.when(first & F.coalesce("good", F.lit(False)), 1).otherwise(0)
    before = Window.partitionBy("paper_key").orderBy("provider_rank").rangeBetween(Window.unboundedPreceding, -1)
    out = candidates.repartition("paper_key").withColumn("__ends", ends)
    return out.withColumn("round", (F.lit(1) + F.coalesce(F.sum("__ends").over(before), F.lit(0))).cast("int")).drop("__ends")


def ranked(candidates: DataFrame, top: int | None = None) -> DataFrame:
    """``rank`` of the candidates of a paper and round: fallbacks last, then
    publisher's version, direct file, publisher's host, score, first seen."""
    order = [F.col("fallback_only").asc(), (F.col("version_type") == "publisher").desc(), F.col("is_direct_pdf").desc(), (F.col("host_type") == "publisher").desc(), F.col("score").desc(), F.col("seen").asc()]
    out = candidates.withColumn("rank", F.row_number().over(Window.partitionBy("paper_key", "round").orderBy(*order)))
    return out.where(F.col("rank") <= top) if top else out


def first_success(attempts: DataFrame) -> DataFrame:
    """The attempts that happen: repeated addresses are tried once, and nothing
    after the first success (column ``ok``) in order of round and rank."""
    place = F.struct("round", "rank")
    names = attempts.columns
    once = attempts.groupBy("paper_key", "pdf_url").agg(F.min_by(F.struct(*names), place).alias("r")).select(*[F.col(f"r.`{n}`").alias(n) for n in names])
    won = once.where("ok").groupBy("paper_key").agg(F.min(place).alias("won"))
    return once.join(won, "paper_key", "left").where(F.col("won").isNull() | (place <= F.col("won"))).withColumn("winner", F.coalesce(place == F.col("won"), F.lit(False))).drop("won")


def open_access_by(candidates: DataFrame) -> DataFrame:
    """Providers that call a paper open, in the order in which they are asked."""
    each = candidates.where("asserts_open_access").groupBy("paper_key", "provider").agg(F.min("provider_rank").alias("r"))
    return each.groupBy("paper_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "provider"))), lambda x: x["provider"]).alias("providers"))


def attempt_status(payloads: DataFrame) -> DataFrame:
    """What came of each provider's answer: failed for a status of 400 or more
    other than 404 or for an error, else whether there were candidates."""
    status = F.when(F.col("error").isNotNull() | (F.col("status") >= 400) & (F.col("status") != 404), "failed").when(F.col("n_candidates") > 0, "candidates_found").otherwise("no_candidates")
    return payloads.withColumn("attempt", status)


def not_yet(left: DataFrame, tried: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key has not been tried: an anti-join."""
    return left.join(tried.select(*keys).distinct(), keys, "left_anti")

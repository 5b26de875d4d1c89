"""What became of the attempts: reasons, statuses, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Reasons why there is no file, the one that counts first (fixed values).
REASONS = ("client_challenged", "host_refused_client", "host_denied", "transient", "wrong_document", "page_without_link", "withdrawn", "not_yet_available", "not_free", "dead_link")
RECENT_DAYS = 60


def recent(published: Column, as_of: Column, days: int = RECENT_DAYS) -> Column:
    age = F.datediff(as_of, F.try_to_date(published))
    return F.coalesce(age.between(0, days), F.lit(False))


def attempt_reason(recently: Column) -> Column:
    """The reason that one failed attempt gives."""
    status = F.col("http_status")
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    return (
        F.when(flag("host_blocked") & flag("host_denied"), "host_denied")
        .when(flag("host_blocked") & flag("host_challenged"), "client_challenged")
        .when(flag("host_blocked"), "host_refused_client")
        .when((status >= 500) | (status == 429), "transient")
        .when(flag("wrong_document"), "wrong_document")
        .when(flag("not_a_pdf"), F.when(recently & F.lower("pdf_url").contains(".pdf"), "not_yet_available").otherwise("page_without_link"))
        .when((status == 404) & (F.col("source_name") == "arxiv"), "withdrawn")
        .when(status.isin(401, 403), "not_free")
        .when(status.isNotNull(), "dead_link")
        .otherwise("transient")
    )


def failure_code(kind: Column, message: Column) -> Column:
    """The code of an error by its kind: metadata, resolution, download or other."""
    nothing = F.coalesce(message.contains("No downloadable source candidate found"), F.lit(False))
    return (
        F.when(kind == "metadata", "metadata_fetch_failed")
        .when(kind == "resolution", F.when(nothing, "unresolved_no_legal_pdf").otherwise("resolution_failed"))
        .when(kind == "download", "download_failed_all_candidates")
        .otherwise("pipeline_error")
    )


def statuses(results: DataFrame) -> DataFrame:
    """``status`` of results (``record_class terminal downloaded reused_existing error_kind
    error failure_reason``): what is no article is skipped and has no reason for a failure."""
    done = F.coalesce("downloaded", F.lit(False))
    skipped = F.coalesce("terminal", F.lit(False))
    status = (
        F.when(skipped, F.concat(F.lit("skipped_"), "record_class"))
        .when(done, F.when(F.coalesce("reused_existing", F.lit(False)), "already_exists").otherwise("downloaded"))
        .otherwise(F.concat(F.lit("failed_"), failure_code(F.col("error_kind"), F.col("error"))))
    )
    return results.withColumns({"status": status, "failure_reason": F.when(~skipped & ~done, F.col("failure_reason"))})


def withdrawals(attempts: DataFrame, hits: DataFrame) -> DataFrame:
    """Papers (``paper_key arxiv_id``) whose preprint's known address answered 404, with the
    archive's own note of the withdrawal where a hit (``arxiv_id comment``) holds one."""
    gone = attempts.where((F.col("source_name") == "arxiv") & (F.col("http_status") == 404)).select("paper_key", "arxiv_id").distinct()
    noted = hits.where(F.lower("comment").contains("withdrawn")).groupBy("arxiv_id").agg(F.min("comment").alias("note"))
    reason = F.concat(F.lit("arxiv: "), F.coalesce("note", F.lit("404 for a known id")))
    return gone.join(noted, "arxiv_id", "left").select("paper_key", F.lit("withdrawn").alias("record_class"), reason.alias("class_reason"))


def precedence(reason: Column) -> Column:
    return F.array_position(F.array(*[F.lit(r) for r in REASONS]), reason)


def failure_reasons(attempts: DataFrame, recently: Column | None = None) -> DataFrame:
    """The first reason in order of precedence over a paper's attempts."""
    reason = attempt_reason(F.lit(False) if recently is None else recently)
    worst = attempts.groupBy("paper_key").agg(F.min(precedence(reason)).alias("p"), F.count("*").alias("attempts"))
    return worst.select("paper_key", F.element_at(F.array(*[F.lit(r) for r in REASONS]), F.col("p").cast("int")).alias("reason"), "attempts")


def summary(results: DataFrame, status: str = "status") -> DataFrame:
    """One row: total, fresh, existed, skipped, failed."""
    s = F.col(status)
    return results.agg(F.count("*").alias("total"), F.count_if(s == "downloaded").alias("fresh"), F.count_if(s == "already_exists").alias("existed"), F.count_if(s.startswith("skipped")).alias("skipped"), F.count_if(~s.isin("downloaded", "already_exists")).alias("failed"))


def by_each(results: DataFrame, columns: list[str]) -> DataFrame:
    """Counts by each of several columns, in one pass: ``by``, ``value``, ``n``."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("by"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x")
    return results.select(each).groupBy("x.by", "x.value").agg(F.count("*").alias("n"))


def latest(events: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    """The last value of each key, and how many events it had."""
    return events.groupBy(*keys).agg(F.max_by(value, F.struct(at, value)).alias(value), F.max(at).alias(at), F.count("*").alias("events"))

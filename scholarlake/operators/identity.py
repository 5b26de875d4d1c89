"""Whether a document is the paper asked for, from its text as columns.

Input columns: ``doi arxiv_id title page_range source_url front_text title_text
n_pages embedded_title``.  The signals are tried in order; only a positive
contradiction (wrong) or a fragment (truncated) speaks against a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from scholarlake.functions import ids, text

#: Shares of a title and numbers of characters and pages (fixed values).
NEAR, PARTIAL, FOREIGN = 0.85, 0.55, 0.30
LEGIBLE_FRONT, LEAST_FRONT = 400, 200
TRUNCATED_SHARE, TRUNCATED_FROM, SLACK, LEAST_SPAN, LARGEST_SPAN = 0.5, 4, 2, 2, 400
#: Titles that name no work (fixed values).
GENERIC = r"(?i)^(untitled|microsoft word|microsoft powerpoint|document|manuscript|paper|article|print|pdf|slide|draft|final|revised|proof|template|no title|title)?[\s\-_.]*(document|file|manuscript|copy|version|\d+)?$"
FILE_NAME = r"(?i)^[\w \-.]{1,60}\.(tif|tiff|pdf|doc|docx|rtf|qxd|indd|eps|ps|xps|pmd|cdr|tex|dvi)$"


def page_count(page_range: Column) -> Column:
    """Pages of '107-122' (16), '1049-58' (10) or '5' (1); null for a lettered
    single page, a range that runs backwards or a span beyond 400."""
    shape = r"^\s*([A-Za-z]*)(\d{1,9})\s*(?:[-–—]\s*[A-Za-z]*(\d{1,9}))?\s*$"
    letters, first, last = (F.regexp_extract(page_range, shape, i) for i in (1, 2, 3))
    short = F.length(last) < F.length(first)
    whole = F.when(short & (last.cast("bigint") < first.cast("bigint")), F.concat(F.expr("''"), F.substring(first, F.lit(1), F.length(first) - F.length(last)), last)).otherwise(last)
    span = F.try_subtract(whole.try_cast("bigint"), first.try_cast("bigint")) + 1
    return F.when(first == "", F.lit(None).cast("bigint")).when(last == "", F.when(letters == "", F.lit(1).cast("bigint"))).when(span.between(1, LARGEST_SPAN), span)


def is_generic(title: Column) -> Column:
    clean = F.trim(F.coalesce(title, F.lit("")))
    return clean.rlike(GENERIC) | clean.rlike(FILE_NAME)


def served_by_arxiv(url: Column, arxiv_id: Column) -> Column:
    plain = F.lower(F.regexp_replace(F.trim(arxiv_id), r"v\d+$", ""))
    path = F.regexp_extract(F.lower(url), r"^https?://(?:www\.|export\.)?arxiv\.org(/[^?#]*)", 1)
    return F.coalesce((plain != "") & (path.startswith(F.concat(F.lit("/pdf/"), plain)) | path.startswith(F.concat(F.lit("/abs/"), plain))), F.lit(False))


def verified(documents: DataFrame) -> DataFrame:
    """``state`` (verified, truncated, wrong, unreadable, no_reference) and the
    ``signal`` that decided."""
    front = F.when(F.length("front_text") >= LEAST_FRONT, F.col("front_text"))
    df = documents.withColumns({"__front": text.squash(F.coalesce(front, F.lit(""))), "__title": text.squash(F.coalesce("title", F.lit(""))), "__pages": text.squash(F.coalesce("title_text", front, F.lit(""))), "__own": text.squash(F.coalesce("embedded_title", F.lit(""))), "__doi": text.squash(ids.doi_printed(F.col("doi"))), "__arxiv": text.squash(F.regexp_replace(F.coalesce(F.trim("arxiv_id"), F.lit("")), r"v\d+$", ""))})
    # the UDFs run for all rows they are given: only rows still undecided get the costly one
    wanted = F.when(~F.col("__pages").contains(F.col("__title")), F.col("__title"))
    df = df.withColumns({"__share": text.matched_fraction(wanted, F.col("__pages")), "__claim": text.matched_fraction(F.when(F.col("__own") != "", F.col("__title")), F.col("__own"))})
    expected, pages = page_count(F.col("page_range")), F.col("n_pages")
    fragment = F.coalesce((expected >= TRUNCATED_FROM) & (pages > 0) & (pages < expected * TRUNCATED_SHARE), F.lit(False))
    same_length = F.coalesce((expected >= LEAST_SPAN) & pages.between(expected, expected + SLACK), F.lit(False))
    has = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    nothing = ~has(F.col("doi")) & ~has(F.col("arxiv_id")) & ~has(F.col("title"))
    titled, short = F.col("__title") != "", F.length("__front") < LEGIBLE_FRONT
    own = titled & has(F.col("embedded_title")) & ~is_generic(F.col("embedded_title"))
    could = (F.length("__own") > 0) & (F.length("__own") >= F.length("__title") * NEAR)
    signal = (
        F.when(nothing, "nothing-known")
        .when(F.col("__front") == "", F.when(same_length, "page-count").otherwise("no-text"))
        .when((F.col("__doi") != "") & F.col("__front").contains(F.col("__doi")), "doi-in-text")
        .when((F.col("__arxiv") != "") & F.col("__front").contains(F.concat(F.lit("arxiv"), F.col("__arxiv"))), "arxiv-in-text")
        .when(served_by_arxiv(F.col("source_url"), F.col("arxiv_id")), "arxiv-in-url")
        .when(titled & F.col("__pages").contains(F.col("__title")), "title-on-page")
        .when(titled & (F.col("__share") >= NEAR), "title-near")
        .when(titled & (F.col("__share") >= PARTIAL) & same_length, "title-partial-with-page-count")
        .when(own & (F.col("__claim") >= NEAR), "title-in-metadata")
        .when(own & could & (F.col("__claim") < FOREIGN) & ~short, "calls-itself-otherwise")
        .when(titled & short, F.when(same_length, "page-count").otherwise("little-text"))
        .when(titled, "nothing-matches")
        .otherwise("title-unknown")
    )
    state = F.when(signal.isin("nothing-known", "title-unknown"), "no_reference").when(signal.isin("no-text", "little-text"), "unreadable").when(signal.isin("calls-itself-otherwise", "nothing-matches"), "wrong").when(fragment, "truncated").otherwise("verified")
    return df.withColumns({"signal": signal, "state": state}).drop("__front", "__title", "__pages", "__own", "__doi", "__arxiv", "__share", "__claim")


def file_verdict(content: Column, content_type: Column, status: Column, least: int = 1024, most: int = 100 << 20) -> Column:
    """Whether bytes are a usable PDF: magic, size, declared type, in this order."""
    size = F.octet_length(content)
    magic = F.locate("%PDF-", F.substring(F.decode(content, "ISO-8859-1"), 1, 1024)) > 0
    declared = F.lower(F.coalesce(F.split_part(content_type, F.lit(";"), F.lit(1)), F.lit("")))
    allowed = declared.isin("", "application/pdf", "application/octet-stream", "binary/octet-stream") | declared.contains("/pdf")
    return F.when(F.coalesce(size, F.lit(0)) == 0, F.when(status != 200, "challenge").otherwise("empty")).when(~magic, "not_a_pdf").when(size < least, "too_small").when(size > most, "too_large").when(~allowed, "wrong_type").otherwise("ok")

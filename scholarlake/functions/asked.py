"""What is asked of remote indexes: query texts, waits and stamps, as Columns.

A recorded answer is found again by what was asked, so these are the join keys of
the tables of answers.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from scholarlake.functions.text import collapse, strip


def letters_only(title: Column) -> Column:
    """A title for a preprint search: ASCII letters, digits and single blanks."""
    return collapse(F.regexp_replace(title, "[^A-Za-z0-9 ]+", " "))


def arxiv_title(title: Column) -> Column:
    return F.concat(F.lit('ti:"'), letters_only(title), F.lit('"'))


def core_title(title: Column) -> Column:
    """Parentheses make the index honour the quotes."""
    return F.concat(F.lit('title:("'), F.replace(strip(title), F.lit('"'), F.lit(" ")), F.lit('")'))


def quoted(field: str, value: Column) -> Column:
    return F.concat(F.lit(f'{field}:"'), value, F.lit('"'))


def doaj_path(query: Column) -> Column:
    """A query as part of a path: a slash is escaped, then all is encoded."""
    return F.replace(F.url_encode(F.replace(query, F.lit("/"), F.lit("\\/"))), F.lit("+"), F.lit("%20"))


def site_title(domain: Column, title: Column) -> Column:
    return F.concat(F.lit("site:"), domain, F.lit(' "'), title, F.lit('"'))


def backoff(attempt: Column, base: float = 2.0) -> Column:
    """Seconds before the next attempt after the n-th: doubled each time."""
    return F.lit(base) * F.pow(F.lit(2.0), attempt - 1)


def retry_after(header: Column) -> Column:
    """Seconds that a header asks to wait; 60 where it is absent or a date."""
    seconds = F.trim(header).try_cast("double")
    return F.when(seconds.isNull(), 60.0).otherwise(F.greatest(F.lit(0.0), seconds))


def stamp(at: Column) -> Column:
    """An instant as part of a file name; the session's zone is UTC."""
    return F.date_format(at, "yyyyMMdd'T'HHmmss'Z'")

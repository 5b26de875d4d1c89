"""Reports as lines of text, from the small tables of counts.

Each report is a DataFrame of ``line_no`` and ``line``: aggregated rows only, one a
category or publisher, so that writing or showing it collects nothing large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def _row(columns: list[Column], widths: list[int]) -> Column:
    return F.rtrim(F.concat_ws("  ", *[F.rpad(c.cast("string"), w, " ") for c, w in zip(columns, widths)]))


def table(counts: DataFrame, columns: list[str], headers: list[str], title: str, first: str = "cat", last: str | None = "TOTAL") -> DataFrame:
    """A table of counts with a title and a header; the row of ``last`` comes last."""
    widths = [28, *[12] * (len(columns) - 1)]
    rule = "-" * (sum(widths) + 2 * (len(widths) - 1))
    spark = counts.sparkSession
    body = counts.select((F.col(first) == last if last else F.lit(False)).alias("end"), F.col(first).alias("key"), _row([F.col(c) for c in columns], widths).alias("line"))
    head = "  ".join(h.ljust(w) for h, w in zip(headers, widths)).rstrip()
    top = spark.createDataFrame([(0, "", title), (1, "", head), (2, "", rule)], "part int, key string, line string")
    rows = top.unionByName(body.select(F.when(F.col("end"), 4).otherwise(3).alias("part"), "key", "line"))
    # one row a category: a window over a table of counts
    numbered = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("part", "key")).alias("line_no")
    return rows.select(numbered, "line")


def acquisition(counts: DataFrame) -> DataFrame:
    return table(counts, ["cat", "raw", "intra_dupes", "after_intra", "inter_removed", "final_unique"], ["Category", "Raw", "IntraDupes", "AfterIntra", "InterRemoved", "FinalUnique"], "SEARCH & DEDUPLICATION REPORT")


def titles(counts: DataFrame) -> DataFrame:
    return table(counts, ["cat", "input", "intra_removed", "after_intra", "inter_removed", "final_unique"], ["Category", "Input", "IntraRemoved", "AfterIntra", "InterRemoved", "FinalUnique"], "TITLE DEDUPLICATION REPORT")


def recovery(sources: DataFrame, total: int) -> DataFrame:
    """Recovered abstracts by source, the most frequent first (``source recovered``)."""
    lines = sources.select((-F.col("recovered")).alias("o"), "source", F.format_string("  %-20s: %d", "source", "recovered").alias("line"))
    top = sources.sparkSession.createDataFrame([("ABSTRACT RECOVERY",), (f"Total papers: {total}",)], "line string").select(F.lit(None).cast("bigint").alias("o"), F.lit("").alias("source"), "line")
    numbered = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("o").asc_nulls_first(), "source", "line")).alias("line_no")
    return top.unionByName(lines).select(numbered, "line")


def publishers(matrix: DataFrame) -> DataFrame:
    """Missing and recovered by publisher (``publisher missing recovered``), with the rate."""
    rate = F.when(F.col("missing") > 0, F.concat(F.round(F.col("recovered") / F.col("missing") * 100, 0).cast("int").cast("string"), F.lit("%"))).otherwise("-")
    return table(matrix.withColumn("rate", rate), ["publisher", "missing", "recovered", "rate"], ["Publisher", "Missing", "Recovered", "Rate"], "SCRAPE SUMMARY", first="publisher", last=None)

"""Streaming forms: refusals of hosts, ingest without repeats, upserts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from scholarlake.operators.hosts import LADDER, WINDOW_SECONDS

_OUT = "host string, at double, recent bigint, cooloff double, blocked_until double, newly boolean"
_STATE = "times array<double>, blocked_until double"


def _step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    times, until = state.get if state.exists else ([], float("-inf"))
    times, rows = list(times), []
    for at in sorted(t for b in batches for t in b["at"]):
        times.append(at)
        recent = sum(at - WINDOW_SECONDS <= t <= at for t in times)
        cooloff = float(LADDER[min(recent, len(LADDER)) - 1])
        newly = until <= at
        until = max(until, at + cooloff)
        rows.append((key[0], at, recent, cooloff, until, newly))
        newest = max(times)
        times = [t for t in times if t >= newest - WINDOW_SECONDS]
    state.update((times, until))
    yield pd.DataFrame(rows, columns=["host", "at", "recent", "cooloff", "blocked_until", "newly"])


def refusal_stream(refusals: DataFrame) -> DataFrame:
    """The refusal ladder over a stream of (host, at in seconds), with the times
    of the trailing window as state.  Refusals are expected in order of time; what
    comes late within a batch is put in order, and what comes in a later batch counts
    those before it, while rows given out already stay as they are."""
    return refusals.select("host", F.col("at").cast("double").alias("at")).groupBy("host").applyInPandasWithState(_step, _OUT, _STATE, "append", GroupStateTimeout.NoTimeout)


def ingest(papers: DataFrame, delay: str = "1 hour", at: str = "fetched_at") -> DataFrame:
    """A stream of search rows without repeats of an id in a category, as long
    as they come within the delay; the state is dropped behind the watermark.
    Rows without an id are no repeats of each other and all stay: each has a key of
    its own, so one operator and one watermark serve both."""
    own = F.coalesce(F.nullif(F.trim("paperId"), F.lit("")), F.concat(F.lit("\0"), F.expr("uuid()")))
    keyed = papers.withColumn("__id", own).withWatermark(at, delay)
    return keyed.dropDuplicatesWithinWatermark(["cat", "__id"]).drop("__id")


def windowed_counts(events: DataFrame, at: str, by: str, delay: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Events by kind in tumbling windows; late rows count until the watermark."""
    return events.withWatermark(at, delay).groupBy(F.window(at, width).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")


def _versions(spark: SparkSession, path: str) -> list[tuple[int, bool]]:
    """(number, whether it is a base) of the whole versions below a path, in order."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    return sorted((int(n[1:]), n[0] == "b") for n in names if n[:1] in "bv" and n[1:].isdigit() and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS")))


def _latest(df: DataFrame, keys: list[str], at: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.col(at)).alias("r")).select("r.*")


def upsert(batch: DataFrame, path: str, keys: list[str], at: str, fold_after: int = 16) -> None:
    """For foreachBatch: a batch's latest row of each key becomes a version of its own,
    so a batch costs what it holds; after ``fold_after`` of them the versions are folded
    into a new base.  A version counts once it is whole, so a lost write leaves nothing."""
    spark: SparkSession = batch.sparkSession
    done = _versions(spark, path)
    number = done[-1][0] + 1 if done else 0
    _latest(batch, keys, at).write.mode("overwrite").parquet(f"{path}/v{number}")
    since = [n for n, base in done if not base and all(n > m for m, b in done if b)]
    if len(since) + 1 >= fold_after:
        current(spark, path, keys, at).write.mode("overwrite").parquet(f"{path}/b{number + 1}")


def current(spark: SparkSession, path: str, keys: list[str], at: str) -> DataFrame:
    """The latest row of each key: the last base and the versions after it."""
    done = _versions(spark, path)
    base = max((n for n, is_base in done if is_base), default=None)
    places = [f"{path}/b{base}"] if base is not None else []
    places += [f"{path}/v{n}" for n, is_base in done if not is_base and (base is None or n > base)]
    if not places:
        raise ValueError(f"nothing is stored at {path}")
    return _latest(spark.read.option("mergeSchema", True).parquet(*places), keys, at)

"""Writers: stages by category, reports, bundles, and small documents."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from scholarlake.functions import ids
from scholarlake.operators import bundle, hosts, joins, outcomes

#: Folders of a run, in order of the stages (fixed values).
STAGES = ("raw", "final", "final_title_deduped", "final_recovered_abstract", "publisher_scraped", "reports", "bundle")


def document(spark: SparkSession, path: str, value: object) -> None:
    """A small JSON document, on whatever file system the path names: written beside
    its place and moved there, so that no reader sees half of it."""
    text(spark, path, json.dumps(value, ensure_ascii=False, indent=2, default=str))


def text(spark: SparkSession, path: str, value: str) -> None:
    jvm = spark.sparkContext._jvm
    place, beside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(beside, True)
    try:
        out.write(bytearray(value.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(place):
        fs.delete(place, False)
    if not fs.rename(beside, place):
        raise OSError(f"{path} could not be put in place")


def stage(df: DataFrame, run_dir: str, name: str) -> str:
    if name not in STAGES:
        raise ValueError(f"no stage {name!r}")
    path = f"{run_dir}/{name}"
    df.write.mode("overwrite").partitionBy("cat").parquet(path)
    return path


def report(df: DataFrame, path: str) -> None:
    """A report as CSV with a header; lists are joined with a semicolon."""
    flat = [F.array_join(c, ";").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes]
    df.select(*flat).write.mode("overwrite").option("header", True).csv(path)


def export_bundle(records: DataFrame, path: str, run: str, manifest: dict, queries: list[str] | None = None) -> dict:
    """Checks the contract, writes the papers, and the manifest last: a bundle
    without one is not whole."""
    broken = bundle.violations(records, run, queries).agg(F.min_by("violation", "idx").alias("v"), F.min("idx").alias("i")).first()
    if broken.v is not None:
        raise ValueError(f"record {broken.i}: {broken.v}")
    kept = bundle.admitted(records, run)
    kept.where("keep").drop("keep", "identity_less").write.mode("overwrite").json(f"{path}/papers")
    counts = bundle.counts(kept).first().asDict()
    if not counts["identity_less"]:
        del counts["identity_less"]
    full = {"schema_version": "1.1", "run_type": run, "written_at": datetime.now(timezone.utc).isoformat(timespec="seconds"), "counts": counts} | manifest
    document(records.sparkSession, f"{path}/manifest.json", full)
    return full


def graph(edges: DataFrame, summary: DataFrame, path: str) -> None:
    """Edges by endpoint and seed, so that a seed without edges leaves nothing, and
    the summary of all seeds."""
    named = edges.withColumn("seed_file", ids.graph_file(F.col("seed")))
    named.write.mode("overwrite").partitionBy("edge_type", "seed_file").json(f"{path}/edges")
    document(edges.sparkSession, f"{path}/fetch_summary.json", summary.first().asDict())


#: Columns of a short record of a download (fixed values).
SHORT = ("paper_id", "title", "downloaded", "reused_existing", "status", "pdf_path")


def short_results(results: DataFrame) -> DataFrame:
    return results.withColumn("paper_id", F.coalesce(F.nullif("semantic_scholar_id", F.lit("")), "paper_key")).select(*SHORT)


def results_summary(results: DataFrame) -> DataFrame:
    """total, freshly_downloaded, already_existed, failed, and status_counts."""
    done, old = F.coalesce("downloaded", F.lit(False)), F.coalesce("reused_existing", F.lit(False))
    per = results.groupBy("status").agg(F.count("*").alias("n"), F.count_if(done & ~old).alias("fresh"), F.count_if(done & old).alias("old"), F.count_if(~done).alias("failed"))
    counts = F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n"))))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0).cast("bigint"))
    return per.agg(zero("n").alias("total"), zero("fresh").alias("freshly_downloaded"), zero("old").alias("already_existed"), zero("failed").alias("failed"), counts.alias("status_counts"))


def download_stats(results: DataFrame, path: str, stamp: str, label: str | None = None) -> dict[str, str]:
    """The results of a run in full and in short, as JSON and CSV tables under names
    with the stamp, and their summary as a document written last."""
    name = "_".join(x for x in ("download_stats", label, stamp) if x)
    places = {"full_json": f"{path}/{name}_full", "short_json": f"{path}/{name}_short", "csv": f"{path}/{name}_short_csv", "summary": f"{path}/{name}_summary.json"}
    results.write.mode("overwrite").json(places["full_json"])
    short_results(results).write.mode("overwrite").json(places["short_json"])
    short_results(results).write.mode("overwrite").option("header", True).csv(places["csv"])
    document(results.sparkSession, places["summary"], {"run_timestamp": stamp, "run_label": label, "summary": results_summary(results).first().asDict()})
    return places


def enriched_inputs(records: DataFrame, results: DataFrame) -> DataFrame:
    """Input records (``input_pos``, ``record`` as JSON or null for a bare id, and the
    keys ``paperId corpus_id arxiv_id doi``) with what became of them: ``pdf_path``,
    ``download_status`` (not_attempted without a result) and ``downloaded``.  Bare ids
    come out as they are."""
    doi = ids.doi(F.col("doi"))
    named = lambda prefix, c: F.concat(F.lit(prefix), c)
    keys = [F.col("paperId"), named("corpus__", F.col("corpus_id")), named("arxiv__", F.col("arxiv_id")), F.translate(named("doi__", doi), "/.", "__"), doi]
    found = joins.first_key(records, "input_pos", keys, results.withColumn("result_pos", F.monotonically_increasing_id()) if "result_pos" not in results.columns else results, [F.col("semantic_scholar_id"), F.col("original_paper_key"), F.col("paper_key")], ["pdf_path", "status", "downloaded"])
    mine = F.col("record").isNotNull()
    status = F.when(mine, F.coalesce("status", F.lit("not_attempted")))
    return found.select("input_pos", "record", F.when(mine, F.col("pdf_path")).alias("pdf_path"), status.alias("download_status"), F.when(mine, F.coalesce("downloaded", F.lit(False))).alias("downloaded"))


def enriched_copy(records: DataFrame, results: DataFrame, path: str) -> bool:
    """The enriched records as JSON; nothing is written where all inputs are bare ids."""
    if records.where("record is not null").isEmpty():
        return False
    enriched_inputs(records, results).write.mode("overwrite").json(path)
    return True


def batch_results(results: DataFrame, path: str, asked: str) -> None:
    """All results, those that failed apart, and a document with their counts."""
    results.write.mode("overwrite").json(f"{path}/batch_results")
    results.where("status = 'failed'").write.mode("overwrite").json(f"{path}/unresolved_results")
    counts = [r.asDict() for r in outcomes.by_each(results, ["status", "version_type", "source_name"]).collect()]
    document(results.sparkSession, f"{path}/batch_summary.json", {"input": asked, "summary": counts})


def refusal_history(refusals: DataFrame, path: str, now: float, window: int = hosts.WINDOW_SECONDS) -> None:
    """The refusals (``host at reason``) that still count, of the trailing window."""
    refusals.where(F.col("at") >= now - window).write.mode("overwrite").parquet(path)

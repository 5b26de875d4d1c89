"""The queries of the training-data problems and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from scholarlake.llm import abuse, bpe, entities, fusion, leaks, mojibake, neartitles, truncation

#: The rank file of the public tokenizer byte_bpe_50k.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.matches(_table(spark, sf_dir, "paper_records"), "record_id", _table(spark, sf_dir, "arxiv_hits"), "hit_id")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_matches(spark, sf_dir).select("record_id", "hit_id").distinct()


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = fusion.survivors(_table(spark, sf_dir, "intra_title_duplicates"))
    return best.select("category", "normalized_title", "survivor_id")


def p2_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fusion.completed(_table(spark, sf_dir, "intra_title_duplicates"), _table(spark, sf_dir, "search_papers"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _table(spark, sf_dir, "paper_records")
    return mojibake.garbled(records, "record_id", ["title", "abstract"]).select("record_id", "field")


def p3_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mojibake.garbled(_table(spark, sf_dir, "paper_records"), "record_id", ["title", "abstract"])


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _table(spark, sf_dir, "paper_records")
    return truncation.truncated(records, "record_id", "abstract", "abstract_source").select("record_id")


def p4_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.rates(_table(spark, sf_dir, "paper_records"), "record_id", "abstract", "abstract_source")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = neartitles.similar_pairs(_table(spark, sf_dir, "intra_title_duplicates"), "normalized_title")
    return pairs.selectExpr("a as title_a", "b as title_b")


def p5_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neartitles.groups(_table(spark, sf_dir, "intra_title_duplicates"), "normalized_title")


def p6_ids(spark: SparkSession, sf_dir: str, tokenizer: str = TOKENIZER) -> DataFrame:
    return bpe.encode(_table(spark, sf_dir, "documents"), "doc_id", "text", tokenizer)


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaks(_table(spark, sf_dir, "documents"), "doc_id", "text", _table(spark, sf_dir, "eval_items"), "item_id", "text")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir).selectExpr("doc as doc_id", "item as item_id")


def p7_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents leak each item, and the largest share of it."""
    return _leaks(spark, sf_dir).groupBy("item").agg(F.count("*").alias("documents"), F.max("share").alias("largest_share"))


def p8_scores(spark: SparkSession, sf_dir: str, tokenizer: str = TOKENIZER) -> DataFrame:
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "content_labels")
    usual = abuse.vocabulary_words(tokenizer)
    scores = abuse.scores(documents, "doc_id", "text", "source", labels, "text", "label", vocabulary=usual)
    return scores.withColumnRenamed("doc", "doc_id")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_scores(spark, sf_dir).where("score >= 0.5").select("doc_id")


def p8_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = F.sum(F.when(F.col("score") >= 0.5, 1).otherwise(0))
    rates = p8_scores(spark, sf_dir).groupBy("source").agg(F.count("*").alias("documents"), bad.alias("flagged"), F.avg("score").alias("mean_score"))
    return rates.withColumn("rate", F.round(F.col("flagged") / F.col("documents"), 6))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name[:1] == "p" and name[1:2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return ORACLES


ORACLES = {
    "p2_found": """
        with o as (
            select category, normalized_title, lower(trim(kept_paperId)) paper, kept_citations c, logged_at from intra_title_duplicates
            union all
            select category, normalized_title, lower(trim(dropped_paperId)), dropped_citations, logged_at from intra_title_duplicates),
        l as (select category, normalized_title, paper, arg_max(c, logged_at) c from o where c is not null and paper is not null and paper not in ('', 'n/a') group by all)
        select category, normalized_title, arg_max(paper, row(c, paper)) as survivor_id from l group by all""",
    "p5_found": """
        with v as (select distinct normalized_title t from intra_title_duplicates where normalized_title is not null),
        w as (select distinct t, unnest(string_split(t, ' ')) x from v),
        k as (select t, x from w where x <> ''),
        n as (select t, count(*) n from k group by t),
        s as (select a.t a, b.t b, count(*) c from k a join k b on a.x = b.x and a.t < b.t group by 1, 2)
        select a as title_a, b as title_b from s join n p on p.t = a join n q on q.t = b
        where 10 * c >= 7 * (p.n + q.n - c)""",
    "p5_groups": """
        with recursive v as (select distinct normalized_title t from intra_title_duplicates where normalized_title is not null and trim(normalized_title) <> ''),
        w as (select distinct t, unnest(string_split(t, ' ')) x from v),
        k as (select t, x from w where x <> ''),
        n as (select t, count(*) n from k group by t),
        s as (select a.t a, b.t b, count(*) c from k a join k b on a.x = b.x and a.t <> b.t group by 1, 2),
        p as (select a, b from s join n p on p.t = a join n q on q.t = b where 10 * c >= 7 * (p.n + q.n - c)),
        r as (select a title, b other from p union select r.title, p.b from r join p on p.a = r.other)
        select t as title, coalesce(least(t, (select min(other) from r where r.title = t)), t) as class, (select count(*) from p where p.a = t)::int as links from v""",
}

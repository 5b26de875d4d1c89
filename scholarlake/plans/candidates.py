"""Candidates, attempts and hosts, on the order lines and the event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from scholarlake.operators import hosts, outcomes, resolve

DOMAINS = ("arxiv.org", "www.nature.com", "files.example", "europepmc.org", "dl.acm.org")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of an order as candidates of a paper: line number is the
    provider's rank, part and supplier name the address."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    pick = F.element_at(F.array(*[F.lit(d) for d in DOMAINS]), (F.col("l_suppkey") % 5 + 1).cast("int"))
    return li.select(
        F.col("l_orderkey").alias("paper_key"), F.concat(F.lit("p"), F.col("l_linenumber")).alias("provider"), F.col("l_linenumber").alias("provider_rank"),
        F.concat_ws("|", F.lpad(F.col("l_partkey").cast("string"), 12, "0"), F.lpad(F.col("l_suppkey").cast("string"), 12, "0"), F.col("l_extendedprice").cast("decimal(20,2)").cast("string"), F.col("l_shipdate").cast("string")).alias("cand_pos"),
        F.concat(F.lit("https://"), pick, F.lit("/"), (F.col("l_partkey") % 50).cast("string")).alias("pdf_url"), pick.alias("domain"),
        F.when(F.col("l_returnflag") == "A", "publisher").when(F.col("l_returnflag") == "N", "accepted").otherwise("preprint").alias("version_type"),
        F.when(F.col("l_linestatus") == "F", "publisher").otherwise("repository").alias("host_type"), F.round(F.col("l_discount") * 10, 4).alias("confidence"),
        (F.col("l_quantity") >= 20).alias("is_direct_pdf"), F.when(F.col("l_tax") > 0.02, F.col("l_tax") * 10 + 0.3).alias("title_match_score"), (F.col("l_quantity") > 45).alias("fallback_only"), (F.col("l_tax") < 0.03).alias("asserts_open_access"),
    )


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = resolve.by_url(candidates(spark, sf_dir)).withColumn("score", resolve.score())
    return resolve.rounds(c.withColumn("good", resolve.good_enough()))


def _ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.ranked(_scored(spark, sf_dir))


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.first_success(_ranked(spark, sf_dir).withColumn("ok", F.col("confidence") >= 0.9))


def _failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = candidates(spark, sf_dir)
    n = F.pmod(F.substring_index("cand_pos", "|", 1).cast("bigint"), F.lit(11))
    a = c.select("paper_key", "pdf_url", F.when(n < 10, F.get(F.array(*[F.lit(x) for x in (404, 403, 500, 200, 429, 401, 404, 200, 403, 404)]), n.cast("int"))).alias("http_status"), F.when(F.col("provider_rank") == 1, "arxiv").otherwise("other").alias("source_name"), (n == 1).alias("host_blocked"), (F.col("provider_rank") == 2).alias("host_denied"), (F.col("provider_rank") == 3).alias("host_challenged"), (n == 3).alias("wrong_document"), (n == 7).alias("not_a_pdf"))
    return outcomes.failure_reasons(a)


def _refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet").where("event_type = 'error'")
    return e.select(F.col("user_id").alias("host"), (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)).alias("at"))


def _slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    arrivals = e.select(F.col("user_id").alias("host"), F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)).cast("double").alias("at"), F.col("event_id").alias("seq"))
    return hosts.rate_slots(arrivals, F.lit(3600.0)).select("host", "seq", "start", "wait")


def _policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    policies = spark.createDataFrame([("arxiv.org", 2, 0.5), ("acm.org", 1, 3.0), ("dl.acm.org", 1, 5.0), ("nature.com", 1, 1.0)], "host string, concurrency int, min_interval double")
    c = candidates(spark, sf_dir).select("paper_key", "cand_pos", "provider_rank", "domain")
    found = hosts.with_policy(c.groupBy("domain").count().select("domain", "count"), "domain", policies, ["domain"])
    return found.select("domain", "count", F.coalesce("policy_host", F.lit("")).alias("policy_host"), F.coalesce("concurrency", F.lit(1)).alias("concurrency"), F.coalesce("min_interval", F.lit(1.0)).alias("min_interval"))


QUERIES = {
    "candidate_scores": lambda s, d: _scored(s, d).select("paper_key", "pdf_url", "score", "good", "round"),
    "candidate_ranks": lambda s, d: _ranked(s, d).select("paper_key", "round", "rank", "pdf_url", "score"),
    "candidate_top3": lambda s, d: resolve.ranked(_scored(s, d), top=3).select("paper_key", "round", "rank", "pdf_url"),
    "first_success": lambda s, d: _attempts(s, d).select("paper_key", "pdf_url", "round", "rank", "winner"),
    "open_access_by": lambda s, d: resolve.open_access_by(candidates(s, d)).select("paper_key", F.array_join("providers", ",").alias("providers")),
    "untried_urls": lambda s, d: resolve.not_yet(candidates(s, d).select("paper_key", "pdf_url").distinct(), _attempts(s, d), ["paper_key", "pdf_url"]),
    "failure_reasons": _failures,
    "candidate_summary": lambda s, d: outcomes.by_each(candidates(s, d), ["version_type", "host_type", "provider"]),
    "refusal_ladder": lambda s, d: hosts.refusal_ladder(_refusals(s, d)).select("host", F.round("at", 6).alias("at"), "recent", "cooloff", F.round("blocked_until", 6).alias("blocked_until"), "newly"),
    "blocked_hosts": lambda s, d: hosts.blocked(hosts.refusal_ladder(_refusals(s, d)), F.lit(1705708800.0)).select("host", F.round("blocked_until", 3).alias("blocked_until")),
    "rate_slots": _slots,
    "host_policies": _policies,
}
_C = """c as (select l_orderkey paper_key, 'p' || l_linenumber provider, l_linenumber provider_rank,
        lpad(l_partkey::varchar, 12, '0') || '|' || lpad(l_suppkey::varchar, 12, '0') || '|' || l_extendedprice::decimal(20,2)::varchar || '|' || l_shipdate::varchar cand_pos, l_partkey,
        list_extract(['arxiv.org', 'www.nature.com', 'files.example', 'europepmc.org', 'dl.acm.org'], (l_suppkey % 5 + 1)::int) as domain,
        'https://' || list_extract(['arxiv.org', 'www.nature.com', 'files.example', 'europepmc.org', 'dl.acm.org'], (l_suppkey % 5 + 1)::int) || '/' || (l_partkey % 50)::varchar pdf_url,
        case l_returnflag when 'A' then 'publisher' when 'N' then 'accepted' else 'preprint' end version_type, case when l_linestatus = 'F' then 'publisher' else 'repository' end host_type,
        round(l_discount * 10, 4) confidence, l_quantity >= 20 is_direct_pdf, case when l_tax > 0.02 then l_tax * 10 + 0.3 end title_match_score, l_quantity > 45 fallback_only, l_tax < 0.03 asserts_open_access from lineitem)"""
_S = f"""{_C}, u as (select *, row_number() over (partition by paper_key, pdf_url order by confidence desc, provider_rank, cand_pos) rn,
        first_value(row(provider_rank, cand_pos)) over (partition by paper_key, pdf_url order by provider_rank, cand_pos) seen from c),
    s as (select *, domain in ('arxiv.org', 'www.nature.com', 'europepmc.org', 'dl.acm.org') trusted, round(case when is_direct_pdf then 0.20 else 0 end + case when domain in ('arxiv.org', 'www.nature.com', 'europepmc.org', 'dl.acm.org') then 0.20 else 0 end
        + case version_type when 'publisher' then 0.30 when 'accepted' then 0.20 when 'preprint' then 0.10 else 0 end + case host_type when 'publisher' then 0.10 when 'repository' then 0.05 else 0 end
        + case when title_match_score is null then 0 when title_match_score >= 0.9 then 0.10 else -0.20 end + greatest(0, least(1, confidence)) * 0.10, 6) score from u where rn = 1),
    g as (select *, not fallback_only and is_direct_pdf and score >= 0.75 and trusted and version_type = 'publisher' good from s),
    p as (select paper_key, provider_rank, max(good) any_good from g group by all),
    q as (select paper_key, provider_rank, (1 + coalesce(sum(any_good::int) over (partition by paper_key order by provider_rank rows between unbounded preceding and 1 preceding), 0))::int round from p),
    r as (select g.*, q.round from g join q using (paper_key, provider_rank)),
    k as (select *, row_number() over (partition by paper_key, round order by fallback_only, (version_type = 'publisher') desc, is_direct_pdf desc, (host_type = 'publisher') desc, score desc, seen) rank from r)"""
_F = f"""{_S}, o as (select *, confidence >= 0.9 ok from k), f as (select paper_key, min(row(round, rank)) won from o where ok group by 1), h as (select o.*, f.won from o left join f using (paper_key)),
    t as (select *, coalesce(row(round, rank) = won, false) winner from h where won is null or row(round, rank) <= won)"""
_R = """e as (select user_id host, epoch_us(ts) us, epoch_us(ts) / 1e6 as "at" from events where event_type = 'error'),
    n as (select *, count(*) over (partition by host order by us range between 604800000000 preceding and current row) recent from e),
    l as (select *, case least(recent, 3) when 1 then 900.0 when 2 then 21600.0 else 172800.0 end::double cooloff from n),
    b as (select *, max("at" + cooloff) over (partition by host order by us rows between unbounded preceding and current row) blocked_until, max("at" + cooloff) over (partition by host order by us rows between unbounded preceding and 1 preceding) bef from l)"""
ORACLES = {
    "candidate_scores": f"with {_S} select paper_key, pdf_url, score, good, round from r",
    "candidate_ranks": f"with {_S} select paper_key, round, rank, pdf_url, score from k",
    "candidate_top3": f"with {_S} select paper_key, round, rank, pdf_url from k where rank <= 3",
    "first_success": f"with {_F} select paper_key, pdf_url, round, rank, winner from t",
    "open_access_by": f"with {_C}, x as (select paper_key, provider, min(provider_rank) r from c where asserts_open_access group by all) select paper_key, string_agg(provider, ',' order by r, provider) as providers from x group by 1",
    "untried_urls": f"with {_F} select distinct paper_key, pdf_url from c where (paper_key, pdf_url) not in (select (paper_key, pdf_url) from t)",
    "failure_reasons": f"""with {_C}, a as (select paper_key, provider_rank, l_partkey % 11 n, list_extract([404, 403, 500, 200, 429, 401, 404, 200, 403, 404], (l_partkey % 11 + 1)::int) st from c),
        x as (select paper_key, case when n = 1 and provider_rank = 2 then 3 when n = 1 and provider_rank = 3 then 1 when n = 1 then 2 when st >= 500 or st = 429 then 4 when n = 3 then 5 when n = 7 then 6
            when st = 404 and provider_rank = 1 then 7 when st in (401, 403) then 9 when st is not null then 10 else 4 end p from a)
        select paper_key, list_extract(['client_challenged', 'host_refused_client', 'host_denied', 'transient', 'wrong_document', 'page_without_link', 'withdrawn', 'not_yet_available', 'not_free', 'dead_link'], min(p)::int) as reason, count(*) as attempts from x group by 1""",
    "candidate_summary": f"with {_C} select 'version_type' as by, version_type as value, count(*) as n from c group by all union all select 'host_type', host_type, count(*) from c group by all union all select 'provider', provider, count(*) from c group by all",
    "refusal_ladder": f'with {_R} select host, round("at", 6) as "at", recent, cooloff, round(blocked_until, 6) as blocked_until, coalesce(bef <= "at", true) as newly from b',
    "blocked_hosts": f'with {_R} select host, round(max(blocked_until), 3) as blocked_until from b where "at" <= 1705708800.0 group by 1 having max(blocked_until) > 1705708800.0',
    "rate_slots": """with a as (select user_id host, event_id seq, floor(epoch_us(ts) / 1e6) as "at" from events), n as (select *, 3600.0 * row_number() over (partition by host order by "at", seq) nth from a),
        s as (select *, nth + max("at" - nth) over (partition by host order by "at", seq rows between unbounded preceding and current row) st from n) select host, seq, round(st, 6)::double as start, round(st - "at", 6)::double as wait from s""",
    "host_policies": f"""with {_C}, x as (select domain, count(*) as count from c group by 1), p(h, concurrency, min_interval) as (values ('arxiv.org', 2, 0.5::double), ('acm.org', 1, 3.0), ('dl.acm.org', 1, 5.0), ('nature.com', 1, 1.0))
        select domain, count, coalesce(arg_max(h, length(h)), '') as policy_host, coalesce(arg_max(concurrency, length(h)), 1) as concurrency, coalesce(arg_max(min_interval, length(h)), 1.0) as min_interval from x left join p on domain = h or domain like '%.' || h group by 1, 2""",
}

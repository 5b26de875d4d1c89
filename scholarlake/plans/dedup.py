"""Deduplication over the search rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from scholarlake.operators import dedup

SP = r"\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x0B\x1C-\x1F"
NORM = rf"""trim(regexp_replace(regexp_replace(regexp_replace(lower(coalesce(title, '')), '[{SP}]*[(\[]?[{SP}]*(extended version|extended abstract|preprint|arxiv|v\d+|version \d+|workshop version|camera ready|camera-ready|under review|technical report)[{SP}]*[)\]]?[{SP}]*$', ''), '[^a-z0-9{SP}]', '', 'g'), '[{SP}]+', ' ', 'g'))"""
PID = "nullif(trim(paperId), '')"
WITHIN = f"""w1 as (select * from (select *, row_number() over (partition by cat, {PID} order by pos) rn from search_papers) where rn = 1 or {PID} is null)"""
ACROSS = f"""w2 as (select * from (select * exclude (rn), row_number() over (partition by {PID} order by cat_pos, pos) rn from w1) where rn = 1 or {PID} is null)"""
TITLED = f"""t as (select *, coalesce(citationCount, 0)::bigint cit, {NORM} norm from search_papers)"""
INTRA = f"""{TITLED}, g as (select *, row_number() over (partition by cat, norm order by cit desc, pos) best, min(pos) over (partition by cat, norm) slot from t where norm <> ''),
    intra as (select * from g where best = 1)"""
INTER = f"""{INTRA}, h as (select *, row_number() over (partition by norm order by cit desc, cat_pos, pos) best2,
        first_value(cat) over (partition by norm order by cat_pos, pos) own, first_value(pos) over (partition by norm order by cat_pos, pos) slot2 from intra),
    inter as (select * from h where best2 = 1)"""


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/search_papers.parquet")


def _collisions(across: bool):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        p = papers(spark, sf_dir)
        return dedup.title_collisions(dedup.by_title(p).select(*p.columns) if across else p, across)

    return query


def _by_title_across(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = papers(spark, sf_dir)
    return dedup.by_title(dedup.by_title(p).select(*p.columns), across=True).select("owner", "slot", "norm", "cat", "pos", "paperId", "swapped")


QUERIES = {
    "id_dedup_intra": lambda s, d: dedup.by_id_within(papers(s, d)).select("cat", "pos", "paperId", "title"),
    "id_dedup_inter": lambda s, d: dedup.by_id_across(dedup.by_id_within(papers(s, d))).select("cat", "pos", "paperId", "title"),
    "memberships": lambda s, d: dedup.memberships(papers(s, d)).select("paperId", F.array_join("matched", ",").alias("matched")),
    "matched_queries": lambda s, d: dedup.with_memberships(dedup.by_id_across(dedup.by_id_within(papers(s, d))), dedup.memberships(papers(s, d))).select("cat", "pos", F.array_join("matched", ",").alias("matched")),
    "title_dedup_intra": lambda s, d: dedup.by_title(papers(s, d)).select("cat", "slot", "norm", "pos", "paperId"),
    "title_dedup_inter": _by_title_across,
    "title_audit_intra": _collisions(False),
    "title_audit_inter": _collisions(True),
    "merged_memberships": lambda s, d: dedup.merged_memberships(papers(s, d), dedup.memberships(papers(s, d))).select("norm", F.array_join("matched", ",").alias("matched")),
    "acquisition_stats": lambda s, d: dedup.id_report(papers(s, d)),
    "title_stats": lambda s, d: dedup.title_report(papers(s, d)),
}
_MEMBERS = f"m as (select {PID} pid, string_agg(distinct cat, ',' order by cat) matched from search_papers where {PID} is not null group by 1)"
_AUDIT = """k as (select *, arg_max(row(paperId, title, cit, cat), row(cit, -ord)) over (partition by {keys} order by {order} rows between unbounded preceding and 1 preceding) keep
        from (select *, row_number() over (partition by {keys} order by {order}) ord from {source} where norm <> '')),
    a as (select *, cit > keep[3] swap from k where ord > 1)
    select cat as category, '{scope}' as scope, norm as normalized_title, pos,
        case when swap then paperId else keep[1] end as kept_paperId, case when swap then cit else keep[3] end as kept_citations, case when swap then title else keep[2] end as kept_title, case when swap then cat else keep[4] end as kept_category,
        case when swap then keep[1] else paperId end as dropped_paperId, case when swap then keep[3] else cit end as dropped_citations, case when swap then keep[2] else title end as dropped_title, case when swap then keep[4] else cat end as dropped_category, swap from a"""
_STATS = """c as (select cat, count(*) n from {given} group by 1), d as (select cat, count(*) n from {after} group by 1), e as (select {own} cat, count(*) n from {final} group by 1),
    j as (select c.cat, c.n::bigint as a, coalesce(d.n, 0)::bigint as b, coalesce(e.n, 0)::bigint as f from c left join d using (cat) left join e on e.cat = c.cat)
    select coalesce(cat, 'TOTAL') as cat, sum(a)::bigint as {x}, sum(a - b)::bigint as {y}, sum(b)::bigint as after_intra, sum(b - f)::bigint as inter_removed, sum(f)::bigint as final_unique from j group by rollup (cat)"""
ORACLES = {
    "id_dedup_intra": f"with {WITHIN} select cat, pos, paperId, title from w1",
    "id_dedup_inter": f"with {WITHIN}, {ACROSS} select cat, pos, paperId, title from w2",
    "memberships": f"with {_MEMBERS} select pid as paperId, matched from m",
    "matched_queries": f"with {WITHIN}, {ACROSS}, {_MEMBERS} select cat, pos, coalesce(matched, cat) as matched from w2 left join m on m.pid = {PID}",
    "title_dedup_intra": f"with {INTRA} select cat, slot, norm, pos, paperId from intra",
    "title_dedup_inter": f"with {INTER} select own as owner, slot2 as slot, norm, cat, pos, paperId, own <> cat as swapped from inter",
    "title_audit_intra": f"with {TITLED}, " + _AUDIT.format(keys="cat, norm", order="pos", source="t", scope="intra"),
    "title_audit_inter": f"with {INTRA}, " + _AUDIT.format(keys="norm", order="cat_pos, pos", source="intra", scope="inter"),
    "merged_memberships": f"with {TITLED}, {_MEMBERS}, u as (select norm, unnest(string_split(coalesce(matched, cat), ',')) x from t left join m on m.pid = {PID} where norm <> '') select norm, string_agg(distinct x, ',' order by x) as matched from u group by 1",
    "acquisition_stats": f"with {WITHIN}, {ACROSS}, " + _STATS.format(given="search_papers", after="w1", final="w2", own="cat", x="raw", y="intra_dupes"),
    "title_stats": f"with {INTER}, " + _STATS.format(given="search_papers", after="intra", final="inter", own="own", x="input", y="intra_removed"),
}

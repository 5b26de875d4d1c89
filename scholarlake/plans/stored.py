"""Sources, sinks, inputs and streams: tables written in the forms that readers take,
read back, and streams run to their end; files lie in the folder that all executors share."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from scholarlake.functions import ids, text
from scholarlake.operators import bundle, dedup, graph, outcomes, reports
from scholarlake.plans import dedup as sql
from scholarlake.session import shared_folder
from scholarlake.sources import readers, schemas, writers
from scholarlake.streaming import refusals


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _place(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}"


def _pages(s, d):
    """Search rows as recorded result pages of a hundred rows, read again."""
    p, place = _t(s, d, "search_papers"), _place(s)
    page = p.select("cat", F.format_string("%012d", F.floor(F.col("pos") / 100)).alias("page"), F.col("pos"), F.struct("paperId", "title", "year", "citationCount").alias("r"))
    made = page.groupBy("cat", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "r"))), lambda x: x["r"]).alias("data"))
    # a file a page: the name of the file is the order
    made.repartitionByRange("cat", "page").sortWithinPartitions("cat", "page").select("cat", "data").write.option("maxRecordsPerFile", 1).partitionBy("cat").json(place)
    return readers.search_pages(s, f"{place}/cat=*").groupBy("cat").agg(F.count("*").alias("n"), F.max("pos").alias("last"), F.count("paperId").alias("named"), F.sum(F.coalesce("citationCount", F.lit(0))).alias("cited"))


def _categories(s, d):
    """Papers as stages by category and again."""
    p, place = _t(s, d, "search_papers"), _place(s)
    back = s.read.parquet(writers.stage(p, place, "final"))
    return back.groupBy("cat").agg(F.count("*").alias("n"), F.count("abstract").alias("abstracts"))


def _runs(s, d):
    """A catalogue of runs with a broken one, the newest first."""
    place = _place(s)
    for i in range(3):
        writers.document(s, f"{place}/{i}/run.json", {"run_id": f"r{i}", "label": "x", "started_at": f"2026-01-0{i + 1}", "status": "complete", "counts": {"a": {"raw": 5, "final": i}, "b": {"raw": 1, "final": 1}}})
    writers.text(s, f"{place}/9/run.json", "{broken")
    return readers.runs(s, f"{place}/*/run.json").select("run_id", "status", "papers")


def _inputs(s, d):
    """Identifiers in several forms, records and wrapped lists as inputs."""
    value = {
        "papers": [
            "10.1000/ABC.d,", "arXiv:2101.00001v2", "CorpusID:77", "A title of its own", "PMID:12", "acl:P19-1001", "f" * 40,
            {"title": "T", "externalIds": {"DOI": "10.2000/x", "DBLP": "journals/corr/abs-2001-01234"}}, {"title": "Only a Title!"}, {"paperId": "p9", "corpusId": 5},
        ]
    }
    return readers.keyed_inputs(s.createDataFrame(readers.parse_inputs(value), "input_pos int, raw string, record string")).select("input_pos", "kind", "paper_key", F.coalesce("arxiv_id", F.lit("")).alias("arxiv_id"))


def _results(s, d):
    """What became of records: made up from their ids."""
    r = _t(s, d, "paper_records")
    n = F.col("record_id") % 5
    status = F.when(n == 0, "downloaded").when(n == 1, "already_exists").when(n == 2, "failed").when(n == 3, "skipped_poster").otherwise("failed_download")
    return r.select(F.concat(F.lit("doi__"), F.translate(ids.doi(F.col("doi")), "/.", "__")).alias("paper_key"), F.col("paper_key").alias("original_paper_key"), F.when(F.col("record_id") % 2 == 0, F.col("semantic_scholar_paper_id")).alias("semantic_scholar_id"), "title", status.alias("status"), (n < 2).alias("downloaded"), (n == 1).alias("reused_existing"), F.when(n < 2, F.concat(F.lit("/f/"), "record_id")).alias("pdf_path"), F.lit("publisher").alias("version_type"), F.lit("arxiv").alias("source_name"), "record_id")


def _summary(s, d):
    out = writers.results_summary(_results(s, d))
    return out.select("total", "freshly_downloaded", "already_existed", "failed", F.array_join(F.transform(F.map_entries("status_counts"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias("statuses"))


def _stats_files(s, d):
    """The short table of results, written as JSON and CSV and read again."""
    place = _place(s)
    files = writers.download_stats(_results(s, d).drop("record_id"), place, "20260101T000000Z", "q")
    short = s.read.option("header", True).schema("paper_id string, title string, downloaded string, reused_existing string, status string, pdf_path string").option("multiLine", True).option("escape", '"').csv(files["csv"])
    whole = s.read.json(files["full_json"])
    return whole.agg(F.count("*").alias("full")).crossJoin(short.agg(F.count_if(F.col("downloaded") == "true").alias("done"), F.count("pdf_path").alias("paths")))


def _enriched(s, d):
    """Records, and bare ids, with what became of them under the first key that fits."""
    r = _t(s, d, "paper_records")
    records = r.select(F.col("record_id").alias("input_pos"), F.when(F.col("record_id") % 7 != 0, F.lit("{}")).alias("record"), F.col("semantic_scholar_paper_id").alias("paperId"), F.lit(None).cast("string").alias("corpus_id"), F.lit(None).cast("string").alias("arxiv_id"), "doi")
    results = _results(s, d).where("record_id % 3 = 0").withColumn("result_pos", F.col("record_id"))
    return writers.enriched_inputs(records, results).select("input_pos", "download_status", "downloaded", "pdf_path")


def _bundle(s, d):
    """Edges as a bundle on disk, with the manifest last."""
    p, place = _t(s, d, "search_papers"), _place(s)
    cited = p.select((F.col("cat_pos").cast("bigint") * 100_000_000 + F.col("pos")).alias("idx"), "paperId", "externalIds", "title", bundle.provenance(seed=F.lit("s1"), edge=F.when(F.col("pos") % 2 == 0, "citation").otherwise("reference"), influential=F.col("pos") % 3 == 0, intents=F.when(F.col("pos") % 5 == 0, F.array(F.lit("background"))).otherwise(F.array().cast("array<string>")), contexts=F.array().cast("array<string>")).alias("_provenance"))
    full = writers.export_bundle(cited, place, "citation_graph", {})
    back = s.read.schema(f"paperId string, _provenance {bundle.PROVENANCE}").json(f"{place}/papers")
    counts = full["counts"]
    return back.agg(F.count("*").alias("papers"), F.count_if(F.col("_provenance.edge_type") == "citation").alias("citations"), F.count_if(F.col("_provenance.intents").isNotNull()).alias("with_intents")).withColumns({"counted": F.lit(counts["total_unique_papers"]).cast("bigint"), "identity_less": F.lit(counts.get("identity_less", 0)).cast("bigint")})


def _seed_errors(s, d):
    raw = _t(s, d, "paper_records").select("record_id", F.coalesce("doi", F.concat(F.lit(""), "record_id"), F.lit("")).alias("raw"))
    return graph.seed_errors(raw).select("record_id", "seed", "error")


def _seed_outcomes(s, d):
    c = _t(s, d, "customer").select(F.when(F.col("c_custkey") % 3 == 0, "http 500").alias("citations_error"), F.when(F.col("c_custkey") % 4 == 0, "http 404").alias("references_error"))
    return graph.outcomes(c)


def _samples(s, d):
    from scholarlake.api import Corpus

    return Corpus(_t(s, d, "search_papers")).sample(4).select("cat", "pos", "citationCount")


def _unique(s, d):
    """The whole chain of deduplication, with the categories of each paper left."""
    from scholarlake.api import Corpus

    out = Corpus(_t(s, d, "search_papers")).unique()
    return out.groupBy("owner").agg(F.count("*").alias("papers"), F.sum(F.size("matched")).alias("memberships"), F.count_if("swapped").alias("swapped"))


def _report(s, d):
    return reports.acquisition(dedup.id_report(_t(s, d, "search_papers"))).where("line_no > 3").select("line_no", F.regexp_replace("line", " +", " ").alias("line"))


def _recovery_report(s, d):
    r = _t(s, d, "paper_records").withColumn("abstract_source", F.coalesce("abstract_source", F.lit("none")))
    return reports.recovery(r.groupBy(F.col("abstract_source").alias("source")).agg(F.count("*").alias("recovered")), 7)


def _download_counts(s, d):
    return outcomes.summary(_results(s, d))


def _arxiv_ids(s, d):
    r = _t(s, d, "paper_records")
    return r.select("record_id", ids.recovery_arxiv(F.col("arxiv_id"), F.col("doi"), F.col("dblp_id")).alias("arxiv"), F.length(text.recovery_title(F.coalesce("title", F.lit("")))).alias("n"))


def _files(s, d):
    """Stored files with their sizes and hashes."""
    place = _place(s)
    rows = _t(s, d, "region").select(F.concat(F.lit("body of "), "r_name").alias("value"), "r_regionkey")
    for r in rows.collect():  # five regions
        writers.text(s, f"{place}/{r.r_regionkey}.pdf", r.value)
    writers.text(s, f"{place}/x.txt", "no file")
    return readers.files(s, place).select(F.regexp_extract("path", r"(\d+)\.pdf$", 1).cast("int").alias("r_regionkey"), F.col("size").cast("bigint").alias("size"), "sha256")


def _feed(s, d):
    """Feeds of preprints, one of them broken."""
    h = _t(s, d, "arxiv_hits").select("hit_id", "year", (F.col("hit_id") % 10 == 0).alias("broken"))
    feed = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>http://arxiv.org/abs/2101.'), F.lpad(F.col("hit_id").cast("string"), 5, "0"), F.lit("v2</id><title> A\n title </title><published>"), F.coalesce("year", F.lit(1999)).cast("string"), F.lit("-05-01T00:00:00Z</published><author><name>Ada B</name></author><author><name>C D</name></author></entry>"), F.when(F.col("broken"), "<unclosed").otherwise("</feed>"))
    e = h.select("hit_id", F.get(readers.feed_entries(feed), 0).alias("e"))
    return e.select("hit_id", "e.arxiv_id", "e.title", F.size("e.authors").alias("authors"), "e.year")


def _stream(s: SparkSession, d: str, name: str) -> DataFrame:
    """A stored table as a stream, be it one file or a folder of files."""
    schema, path = _t(s, d, name).schema, s.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{d}/{name}.parquet")
    one = path.getFileSystem(s.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path).isFile()
    reader = s.readStream.schema(schema)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(d) if one else reader.parquet(f"{d}/{name}.parquet")


def _ran(stream: DataFrame, mode: str = "append") -> DataFrame:
    """All that a stream of stored files gives, run to its end."""
    s, place = stream.sparkSession, _place(stream.sparkSession)
    stream.writeStream.format("parquet").option("checkpointLocation", f"{place}/checkpoint").option("path", f"{place}/rows").outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    return s.read.schema(stream.schema).parquet(f"{place}/rows")


def _refusals(s, d):
    e = _stream(s, d, "events").where("event_type = 'error'")
    made = _ran(refusals.refusal_stream(e.select(F.col("user_id").cast("string").alias("host"), (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)).alias("at"))))
    return made.select(F.col("host").cast("bigint").alias("host"), F.round("at", 6).alias("at"), "recent", "cooloff", F.round("blocked_until", 6).alias("blocked_until"), "newly")


def _ingest(s, d):
    p = _stream(s, d, "search_papers").withColumn("fetched_at", F.col("fetched_at").cast("timestamp"))
    return _ran(refusals.ingest(p, "3650 days")).groupBy("cat").agg(F.count("*").alias("n"), F.count_if(text.blank_to_null(F.col("paperId")).isNull()).alias("unnamed"))


def _windows(s, d):
    e = _stream(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return _ran(refusals.windowed_counts(e, "ts", "event_type", "10 minutes", "1 day"))


def _upserts(s, d):
    """The latest event of each user and kind, stored batch by batch."""
    place = _place(s)
    e = _stream(s, d, "events").select("user_id", "event_type", F.struct(F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "event_id").alias("at"))

    def store(batch: DataFrame, _: int) -> None:
        half = F.col("at.event_id") % 2 == 0
        refusals.upsert(batch.where(half), f"{place}/t", ["user_id", "event_type"], "at", fold_after=2)
        refusals.upsert(batch.where(~half), f"{place}/t", ["user_id", "event_type"], "at", fold_after=2)

    e.writeStream.foreachBatch(store).option("checkpointLocation", f"{place}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return refusals.current(s, f"{place}/t", ["user_id", "event_type"], "at").select("user_id", "event_type", F.col("at.event_id").alias("last_event"))


QUERIES = {
    "stored_pages": _pages,
    "stored_stages": _categories,
    "stored_runs": _runs,
    "stored_files": _files,
    "stored_stats": _stats_files,
    "stored_graph_bundle": _bundle,
    "input_forms": _inputs,
    "download_summary": _summary,
    "download_counts": _download_counts,
    "enriched_inputs": _enriched,
    "graph_seed_errors": _seed_errors,
    "graph_seed_outcomes": _seed_outcomes,
    "sampled_papers": _samples,
    "unique_papers": _unique,
    "acquisition_report": _report,
    "recovery_report": _recovery_report,
    "recovery_ids": _arxiv_ids,
    "feed_entries": _feed,
    "stream_refusals": _refusals,
    "stream_ingest": _ingest,
    "stream_windows": _windows,
    "stream_upserts": _upserts,
}
_D = r"lower(nullif(regexp_replace(nullif(regexp_extract(replace(trim(doi), '\', ''), '(10\.\d{4,9}/\S+)', 1), ''), '[ .;,)]+$', ''), ''))"
_R = f"""r as (select record_id, paper_key, semantic_scholar_paper_id ss, {_D} d, record_id % 5 n from paper_records),
    x as (select *, case n when 0 then 'downloaded' when 1 then 'already_exists' when 2 then 'failed' when 3 then 'skipped_poster' else 'failed_download' end status from r)"""
ORACLES = {
    "stored_pages": """select cat, count(*) as n, max(i) as last, count(paperId) as named, sum(coalesce(citationCount, 0))::bigint as cited from (select *, row_number() over (partition by cat order by pos) - 1 i from search_papers) group by 1""",
    "stored_stages": "select cat, count(*) as n, count(abstract) as abstracts from search_papers group by 1",
    "stored_runs": "select * from (values ('r2', 'complete', 3::bigint), ('r1', 'complete', 2), ('r0', 'complete', 1)) v(run_id, status, papers)",
    "stored_files": "select r_regionkey, length('body of ' || r_name)::bigint as size, sha256('body of ' || r_name) as sha256 from region",
    "stored_stats": 'select count(*) as "full", count(*) filter (record_id % 5 < 2) as done, count(*) filter (record_id % 5 < 2) as paths from paper_records',
    "stored_graph_bundle": """select count(*) as papers, count(*) filter (pos % 2 = 0) as citations, count(*) filter (pos % 5 = 0) as with_intents, count(*) as counted,
        count(*) filter (coalesce(nullif(trim(paperId), ''), nullif(trim(map_extract_value(externalIds, 'DOI')), ''), nullif(trim(map_extract_value(externalIds, 'ArXiv')), '')) is null) as identity_less from search_papers""",
    "input_forms": """select * from (values (0, 'doi', 'doi__10.1000_abc.d', ''), (1, 'arxiv', 'arxiv__2101.00001', '2101.00001'), (2, 'corpus_id', 'corpus__77', ''), (3, 'title_or_unknown', 'title__' || substr(sha1('a title of its own'), 1, 16), ''), (4, 'pmid', 'title__' || substr(sha1('unknown'), 1, 16), ''),
        (5, 'acl_id', 'title__' || substr(sha1('unknown'), 1, 16), ''), (6, 'semantic_scholar_paper_id', 'ss__ffffffffffffffffffffffffffffffffffffffff', ''), (7, 'metadata_json', 'doi__10.2000_x', '2001.01234'), (8, 'metadata_json', 'title__' || substr(sha1('only a title'), 1, 16), ''), (9, 'metadata_json', 'ss__p9', '')) v(input_pos, kind, paper_key, arxiv_id)""",
    "download_summary": f"""with {_R} select count(*) as total, count(*) filter (n = 0) as freshly_downloaded, count(*) filter (n = 1) as already_existed, count(*) filter (n > 1) as failed, (select string_agg(status || '=' || c, ',' order by status) from (select status, count(*) c from x group by 1)) as statuses from x""",
    "download_counts": f"with {_R} select count(*) as total, count(*) filter (n = 0) as fresh, count(*) filter (n = 1) as existed, count(*) filter (n = 3) as skipped, count(*) filter (n > 1) as failed from x",
    "enriched_inputs": f"""with {_R}, k as (select 'doi__' || translate(d, '/.', '__') k, record_id, status, n from x where record_id % 3 = 0 and d is not null union all select paper_key, record_id, status, n from x where record_id % 3 = 0 union all select ss, record_id, status, n from x where record_id % 3 = 0 and record_id % 2 = 0 and ss is not null),
        f as (select k, min(record_id) rid, arg_min(status, record_id) status, arg_min(n, record_id) n from k where k is not null group by 1),
        j as (select x.record_id, a.k is not null ha, a.rid ra, a.status sa, a.n na, b.k is not null hb, b.rid rb, b.status sb, b.n nb, c.k is not null hc, c.rid rc, c.status sc, c.n nc from x left join f a on a.k = x.ss left join f b on b.k = 'doi__' || translate(x.d, '/.', '__') left join f c on c.k = x.d),
        m as (select record_id, case when ha then ra when hb then rb when hc then rc end rid, case when ha then sa when hb then sb when hc then sc end st, case when ha then na when hb then nb when hc then nc end nn from j)
        select record_id as input_pos, case when record_id % 7 <> 0 then coalesce(st, 'not_attempted') end as download_status, case when record_id % 7 <> 0 then coalesce(nn < 2, false) end as downloaded, case when record_id % 7 <> 0 and nn < 2 then '/f/' || rid end as pdf_path from m""",
    "graph_seed_errors": r"""select record_id, case when doi is null then null when regexp_matches(trim(doi), '^10\.\d{4,9}/\S+$') then 'DOI:' || trim(doi) end as seed, case when doi is null then 'ambiguous number' when regexp_matches(trim(doi), '^10\.\d{4,9}/\S+$') then null when trim(doi) = '' then 'empty' else 'unrecognised' end as error from paper_records""",
    "graph_seed_outcomes": "select count(*) filter (c_custkey % 3 = 0) as citations_failed, count(*) filter (c_custkey % 4 = 0) as references_failed, count(*) filter (c_custkey % 12 = 0) as both_failed, count(*) filter (c_custkey % 3 <> 0 and c_custkey % 4 <> 0) as both_success from customer",
    "sampled_papers": "select cat, pos, citationCount from search_papers qualify row_number() over (partition by cat order by pos) <= 4",
    "unique_papers": f"""with {sql.WITHIN}, {sql.ACROSS}, {sql.INTER.replace("from search_papers", "from w2")}, m as (select {sql.PID} pid, list(distinct cat) cats from search_papers where {sql.PID} is not null group by 1),
        u as (select norm, unnest(coalesce(cats, [cat])) x from t left join m on m.pid = {sql.PID} where norm <> ''), k as (select norm, count(distinct x) k from u group by 1)
        select own as owner, count(*) as papers, sum(k)::bigint as memberships, count(*) filter (own <> cat) as swapped from inter join k using (norm) group by 1""",
    "acquisition_report": """with n as (select *, nullif(trim(paperId), '') k from search_papers), w as (select * from n where k is not null qualify row_number() over (partition by cat, k order by pos) = 1 union all select * from n where k is null), a as (select * from w where k is not null qualify row_number() over (partition by k order by cat_pos, pos) = 1 union all select * from w where k is null),
        c as (select cat, (select count(*) from n where n.cat = x.cat) r, (select count(*) from w where w.cat = x.cat) s, (select count(*) from a where a.cat = x.cat) t from (select distinct cat from n) x), u as (select 0 o, cat, r, s, t from c union all select 1, 'TOTAL', sum(r), sum(s), sum(t) from c)
        select (3 + row_number() over (order by o, cat))::int as line_no, concat_ws(' ', cat, r, r - s, s, s - t, t) as line from u""",
    "recovery_report": """with c as (select coalesce(abstract_source, 'none') source, count(*) n from paper_records group by 1), l as (select null o, '' source, 'ABSTRACT RECOVERY' as line union all select null, '', 'Total papers: 7' union all select -n, source, printf('  %-20s: %d', source, n) from c)
        select row_number() over (order by o nulls first, source, line)::int as line_no, line from l""",
    "recovery_ids": r"""select record_id, coalesce(nullif(arxiv_id, ''), case when contains(doi, 'arXiv') then list_last(string_split(doi, 'arXiv.')) when contains(dblp_id, 'journals/corr/abs-') then replace(list_last(string_split(dblp_id, 'abs-')), '-', '.') end) as arxiv,
        length(trim(regexp_replace(lower(coalesce(title, '')), '[^a-z0-9\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x0B\x1C-\x1F]', '', 'g'), ' '))::int as n from paper_records""",
    "feed_entries": "select hit_id, case when hit_id % 10 <> 0 then '2101.' || lpad(hit_id::varchar, 5, '0') end as arxiv_id, case when hit_id % 10 <> 0 then 'A title' end as title, case when hit_id % 10 <> 0 then 2 end as authors, case when hit_id % 10 <> 0 then coalesce(year, 1999) end as year from arxiv_hits",
    "stream_refusals": """with e as (select user_id host, epoch_us(ts) us, epoch_us(ts) / 1e6 as "at" from events where event_type = 'error'), n as (select *, count(*) over (partition by host order by us range between 604800000000 preceding and current row) recent from e),
        l as (select *, case least(recent, 3) when 1 then 900.0 when 2 then 21600.0 else 172800.0 end::double cooloff from n), b as (select *, max("at" + cooloff) over (partition by host order by us rows between unbounded preceding and current row) blocked_until, max("at" + cooloff) over (partition by host order by us rows between unbounded preceding and 1 preceding) bef from l)
        select host, round("at", 6) as "at", recent, cooloff, round(blocked_until, 6) as blocked_until, coalesce(bef <= "at", true) as newly from b""",
    "stream_ingest": "select cat, count(distinct nullif(trim(paperId), '')) + count(*) filter (nullif(trim(paperId), '') is null) as n, count(*) filter (nullif(trim(paperId), '') is null) as unnamed from search_papers group by 1",
    "stream_windows": "with w as (select date_trunc('day', ts)::timestamp as start, event_type from events) select start, event_type, count(*) as n from w where start + interval 1 day <= (select max(ts) - interval 10 minute from events) group by all",
    "stream_upserts": "select user_id, event_type, arg_max(event_id, row(epoch_us(ts), event_id)) as last_event from events group by all",
}

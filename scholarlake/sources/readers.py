"""Readers of recorded responses, query files, id lists, runs and files.

Requests are not made here: answers come in as files, and what could not be
asked is a status, not a missing row.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from scholarlake.functions import ids
from scholarlake.functions.text import blank_to_null
from scholarlake.operators.lookups import recovered_ids
from scholarlake.sources import schemas

#: Keys of a query file by the name of the parameter they set (fixed values).
PARAMETERS = {"date_range": "publicationDateOrYear", "min_citations": "minCitationCount", "publication_types": "publicationTypes", "venue": "venue", "fields_of_study": "fieldsOfStudy", "open_access_pdf": "openAccessPdf", "year": "year"}


def parse_queries(text: str) -> tuple[list[tuple[str, int, str, dict[str, str]]], list[str]]:
    """(id, rank, query, parameters) of a query file, and its unknown keys.  A
    query's own settings win over the defaults; entries without a query are
    left out; a minimum of 0 citations is none."""
    raw = json.loads(text)
    rows, unknown = [], []
    for name, entry in raw.get("queries", {}).items():
        if not entry.get("query"):
            continue
        merged = raw.get("defaults", {}) | {k: v for k, v in entry.items() if k != "query"}
        unknown += [f"{name}.{k}" for k in merged if k not in PARAMETERS]
        params = {PARAMETERS[k]: str(v) for k, v in merged.items() if k in PARAMETERS}
        if params.get("minCitationCount") == "0":
            del params["minCitationCount"]
        rows.append((name, len(rows), entry["query"], params))
    return rows, unknown


def queries(spark: SparkSession, path: str) -> DataFrame:
    """A query file, wherever the cluster's file systems hold it."""
    text = spark.read.text(path, wholetext=True).first()[0]
    return spark.createDataFrame(parse_queries(text)[0], schemas.QUERY)


def search_pages(spark: SparkSession, path: str) -> DataFrame:
    """Recorded result pages under ``cat=<id>`` folders: one row per result, with
    ``cat``, and ``pos`` counted over the pages of a category in name order."""
    pages = spark.read.schema(f"total bigint, token string, data array<{_struct(schemas.PAPER)}>").option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    named = pages.withColumn("file", F.input_file_name())
    named = named.select(F.url_decode(F.regexp_extract("file", r"/cat=([^/]+)/", 1)).alias("cat"), "file", "data")
    # where each page starts: a window over pages, not over their results
    before = Window.partitionBy("cat").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    size = F.coalesce(F.size("data"), F.lit(0)).cast("bigint")
    starts = named.select("cat", "file", size.alias("n")).select("cat", "file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    rows = named.join(starts, ["cat", "file"]).select("cat", "start", F.posexplode("data").alias("i", "r"))
    return rows.select("cat", (F.col("start") + F.col("i")).cast("bigint").alias("pos"), "r.*")


def _struct(ddl: str) -> str:
    """A table's declared columns as the type of a struct."""
    return StructType.fromDDL(ddl).simpleString()


def categories(spark: SparkSession, path: str) -> DataFrame:
    """A folder of JSON lists, one file a category, in order of names."""
    df = spark.read.schema(schemas.PAPER).option("multiLine", True).json(path).withColumn("cat", F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1))
    return df.withColumn("cat", F.url_decode("cat"))


def edges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.EDGE).json(path)


def payloads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PAYLOAD).json(path)


def runs(spark: SparkSession, path: str) -> DataFrame:
    """Audits of runs, the newest first by path; malformed ones are left out."""
    df = spark.read.schema(schemas.RUN).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)
    total = F.aggregate(F.map_values("counts"), F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x["final"], F.lit(0)))
    return df.where("run_id is not null").select("*", F.input_file_name().alias("path"), total.alias("papers")).orderBy(F.col("path").desc())


def id_list(spark: SparkSession, text: str) -> DataFrame:
    """Ids of a JSON array or a comma list: ``input_pos`` and ``raw``."""
    text = text.strip()
    values = json.loads(text) if text.startswith("[") else text.split(",")
    return spark.createDataFrame([(i, str(v).strip()) for i, v in enumerate(x for x in values if str(x).strip())], "input_pos bigint, raw string")


def files(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """Stored files: path, size, SHA-256 and content."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return df.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"), "content")


def feed_entries(feed: Column) -> Column:
    """The entries of an Atom feed of preprints as an array of structs (id,
    title, authors, year, comment); null for a malformed feed."""
    entry = "struct<id:string,title:string,published:string,author:array<struct<name:string>>,comment:string>"
    parsed = F.from_xml(feed, f"entry array<{entry}>", {"ignoreNamespace": "true", "mode": "PERMISSIVE"})
    return F.transform(parsed["entry"], lambda e: F.struct(F.regexp_extract(e["id"], r"abs/(.+?)(v\d+)?$", 1).alias("arxiv_id"), F.trim(F.regexp_replace(e["title"], r"\s+", " ")).alias("title"), F.transform(e["author"], lambda a: a["name"]).alias("authors"), F.substring(e["published"], 1, 4).try_cast("int").alias("year"), blank_to_null(e["comment"]).alias("comment")))


def pages(spark: SparkSession, path: str) -> DataFrame:
    """Recorded web pages: the address asked for, the one that answered, status, headers and text."""
    return spark.read.schema(schemas.PAGE).json(path)


#: Wrappers under which an input document holds its items (fixed values).
WRAPPERS = ("papers", "paperIds", "ids")


def parse_inputs(value: object) -> list[tuple[int, str | None, str | None]]:
    """(input_pos, raw id, record as JSON) of an input: an id, a record, a wrapped
    list, or a list of any of these.  A list's items keep their order."""
    found: list[tuple[str | None, str | None]] = []

    def walk(item: object) -> None:
        if isinstance(item, str):
            found.append((item, None))
        elif isinstance(item, dict):
            for key in WRAPPERS:
                if isinstance(item.get(key), list):
                    for x in item[key]:
                        walk(x if key == "papers" else str(x))
                    return
            found.append((None, json.dumps(item, ensure_ascii=False)))
        elif isinstance(item, (list, tuple)):
            for x in item:
                walk(x)
        else:
            raise ValueError(f"no input of type {type(item).__name__}")

    walk(value)
    return [(i, raw, record) for i, (raw, record) in enumerate(found)]


def inputs(spark: SparkSession, value: object) -> DataFrame:
    """Papers of an input, with their kind, identifiers and key: a path of a JSON
    document, a PDF or a folder of PDFs (``.json``, ``.pdf`` or ``/`` at the end), an id,
    a record, or a list.  Records are read with the declared schema of a paper."""
    if isinstance(value, str) and value.lower().endswith(".json"):
        value = json.loads(spark.read.text(value, wholetext=True).first()[0])
    if isinstance(value, str) and (value.lower().endswith(".pdf") or value.endswith("/")):
        stored = spark.read.format("binaryFile").option("pathGlobFilter", "*.[pP][dD][fF]").load(value).select("path")
        key = F.concat(F.lit("localpdf__"), F.substring(F.sha1("path"), 1, 16))
        return stored.select(key.alias("paper_key"), F.lit("local_pdf").alias("kind"), F.col("path").alias("raw"), *[F.lit(None).cast("string").alias(c) for c in _IDS]).orderBy("raw")
    rows = spark.createDataFrame(parse_inputs(value), "input_pos int, raw string, record string")
    return keyed_inputs(rows).orderBy("input_pos")


_IDS = ("doi", "arxiv_id", "semantic_scholar_paper_id", "corpus_id", "acl_id", "pmid", "pmcid", "mag_id", "title")


def keyed_inputs(rows: DataFrame) -> DataFrame:
    """Inputs (``input_pos raw record``) with ``kind``, identifiers and ``paper_key``."""
    kind = F.when(F.col("record").isNotNull(), "metadata_json").otherwise(ids.kind_of_input(F.col("raw")))
    rest = F.regexp_replace(F.trim("raw"), "^[^:]*:", "")
    of = lambda name, value: F.when(kind == name, value)
    paper = F.from_json("record", f"{schemas.PAPER}, doi string, arxivId string, dblpId string, aclId string, pmid string, pmcid string")
    record = recovered_ids(paper["externalIds"], {"doi": paper["doi"], "arxiv_id": paper["arxivId"], "dblp_id": paper["dblpId"], "acl_id": paper["aclId"], "pmid": paper["pmid"], "pmcid": paper["pmcid"], "corpus_id": paper["corpusId"], "paperId": paper["paperId"]})
    single = {
        "doi": of("doi", ids.doi(F.col("raw"))), "arxiv_id": of("arxiv", ids.arxiv(F.col("raw"))), "semantic_scholar_paper_id": of("semantic_scholar_paper_id", F.trim("raw")),
        "corpus_id": of("corpus_id", rest), "acl_id": of("acl_id", rest), "pmid": of("pmid", rest), "pmcid": of("pmcid", rest), "mag_id": of("mag", rest), "title": of("title_or_unknown", F.trim("raw")),
    }
    both = {c: F.coalesce(single[c], paper["title"] if c == "title" else record.get(c, F.lit(None).cast("string"))) for c in _IDS}
    out = rows.select("input_pos", kind.alias("kind"), "raw", *[v.alias(c) for c, v in both.items()])
    return out.withColumn("paper_key", ids.paper_key(*[F.col(c) for c in ("doi", "arxiv_id", "semantic_scholar_paper_id", "corpus_id", "title")]))

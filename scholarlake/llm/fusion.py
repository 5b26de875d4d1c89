"""Best representative of each duplicate group (problem 2).

Method: Bayesian fusion with copy detection.  A claim says that a source gives a
value to an item.  Rounds estimate, in turn, how accurate each source is, how
likely one source copies another (sources that share many values that others
reject), and the probability of each value, until the accuracies stand still; a
copied vote counts only as far as it is likely to be its source's own.  The value
of the highest posterior wins.

Recency is part of the model: a claim of an item's k-th last moment has ``STALE`` to
the power k of its weight, so old values compete but what is newer weighs more than
all that is older, and a source whose claims are out of date loses accuracy by it.
For the survivor an item is a paper of a group and the claims are its citation
counts, each run of the audit being a source; the paper with the highest count
survives.  Its fields are then fused one by one from the search rows of the group,
with the survivor's own rows for the latest moment and those of the others, which
only complete it, for the one before.

Only items with more than one value go through the rounds, those of the same pattern
of sources and moments once; of the others, equal sets of sources are counted natively.  Values longer than a hash travel as their hash and
are joined to the winners.  A group of an item and a value holds each source at most
once, so it is bounded by the number of sources (``MOST_SOURCES``, checked), and only
tables of sources and of pairs of sources reach the driver.

Defined results for odd input: a null count is no observation, and a null, blank
or ``N/A`` id no paper; rows logged twice count once; ties between counts go to
the greater id; a group without any observation has no survivor; a field nobody
gives is null; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from scholarlake.llm.common import settle

MOST_SOURCES = 5000
#: Claims of an item up to which it is compared with others as a whole.
MOST_CLAIMS = 64
#: Rounds at most, and the change of an accuracy that counts as none.
ROUNDS, STILL = 8, 0.002
#: Weight of a claim against one of the item's next moment: with accuracies kept from
#: 0.05 to 0.99 even all sources of an older moment weigh less than one of a newer.
STALE = 1e-6
COPY_PRIOR, COPY_SHARE, WRONG_VALUES = 0.05, 0.8, 50.0
FIELDS = ("title", "abstract", "year", "venue", "publicationDate", "citationCount", "url")
#: Fields that come out in the type of their column; where a table lacks one, so does the result.
TYPED = ("isOpenAccess", "publicationTypes", "authors", "externalIds", "openAccessPdf", "publicationVenue")


class Model:
    """Accuracies of sources, and for a pair how likely it is that one copies."""

    def __init__(self) -> None:
        self.accuracy: dict[str, float] = {}
        self.copies: dict[tuple[str, str], float] = {}

    def vote(self, sources: list[str]) -> float:
        """The log weight of a value: the sources in order of accuracy, each
        discounted by the chance that it copied one before it."""
        total, before = 0.0, []
        for s in sorted(sources, key=lambda x: (-self.accuracy.get(x, 0.8), x)):
            a = min(0.99, max(0.05, self.accuracy.get(s, 0.8)))
            own = 1.0
            for b in before:
                own *= 1 - COPY_SHARE * self.copies.get((min(s, b), max(s, b)), 0.0)
            total += own * math.log(WRONG_VALUES * a / (1 - a))
            before.append(s)
        return total

    def learn(self, source: dict[str, tuple[float, float]], true: Counter, false: Counter, overlap: Counter) -> None:
        """source: (claims, sum of their probabilities); true, false, overlap: number of
        items on which a pair shares a right or a wrong value, or both speak."""
        self.accuracy = {s: (p + 4) / (n + 5) for s, (n, p) in source.items()}
        for pair, both in overlap.items():
            a = min(0.99, max(0.01, (self.accuracy.get(pair[0], 0.8) + self.accuracy.get(pair[1], 0.8)) / 2))
            kt, kf = true[pair], false[pair]
            kd = max(0.0, both - kt - kf)
            alone = (a * a, (1 - a) ** 2 / WRONG_VALUES)
            alone = (*alone, max(1e-9, 1 - sum(alone)))
            copied = tuple(COPY_SHARE * c + (1 - COPY_SHARE) * x for c, x in zip((a, 1 - a, 0.0), alone))
            z = sum(k * (math.log(max(c, 1e-12)) - math.log(max(x, 1e-12))) for k, c, x in zip((kt, kf, kd), copied, alone))
            z += math.log(COPY_PRIOR / (1 - COPY_PRIOR))
            self.copies[pair] = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _pairs(sources: list[str]) -> Iterator[tuple[str, str]]:
    sources = sorted(sources)
    return ((sources[i], sources[j]) for i in range(len(sources)) for j in range(i + 1, len(sources)))


def _votes(batches: Iterator[pa.RecordBatch], sent: Broadcast) -> Iterator[pa.RecordBatch]:
    """Adds the ``vote`` of the sources of each row."""
    model, known = sent.value, {}
    for batch in batches:
        sources = [tuple(sorted(s)) for s in batch.column("sources").to_pylist()]
        for s in sources:
            if s not in known:
                known[s] = model.vote(list(s))
        yield batch.append_column("vote", pa.array([known[s] for s in sources], pa.float64()))


_STAT = pa.schema([("kind", pa.string()), ("a", pa.string()), ("b", pa.string()), ("n", pa.float64()), ("p", pa.float64())])
_STAT_SQL = "kind string, a string, b string, n double, p double"


def _statistics(batches: Iterator[pa.RecordBatch], alone: bool) -> Iterator[pa.RecordBatch]:
    """Claims of each source with their probability, and the pairs of sources that
    share a value; ``alone``: nobody else speaks, so the pairs overlap as well."""
    n: Counter = Counter()
    p: Counter = Counter()
    for batch in batches:
        for sources, probability, best, times in zip(*(batch.column(c).to_pylist() for c in ("sources", "probability", "best", "times"))):
            for s in sources:
                n["source", s, ""] += times
                p["source", s, ""] += times * probability
            for a, b in _pairs(sources):
                n["true" if best else "false", a, b] += times
                if alone:
                    n["overlap", a, b] += times
    yield _stat_batch(n, p)


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n: Counter = Counter()
    for batch in batches:
        for sources, times in zip(*(batch.column(c).to_pylist() for c in ("sources", "times"))):
            for a, b in _pairs(sources):
                n["overlap", a, b] += times
    yield _stat_batch(n, Counter())


def _stat_batch(n: Counter, p: Counter) -> pa.RecordBatch:
    rows = [(*k, float(v), float(p.get(k, 0.0))) for k, v in n.items()]
    return pa.RecordBatch.from_pylist([dict(zip(_STAT.names, r)) for r in rows], schema=_STAT)


def _collected(stats: DataFrame) -> dict[str, Counter]:
    """Sums by source and by pair of sources: bounded by the number of sources."""
    out: dict[str, Counter] = {k: Counter() for k in ("source", "right", "true", "false", "overlap")}
    for r in stats.groupBy("kind", "a", "b").agg(F.sum("n").alias("n"), F.sum("p").alias("p")).collect():
        if r.kind == "source":
            out["source"][r.a], out["right"][r.a] = r.n, r.p
        else:
            out[r.kind][r.a, r.b] = r.n
    return out


def _posteriors(contested: DataFrame, item: list[str], model: Model) -> DataFrame:
    """item, vid, the sources that give it, ``probability`` and ``best``, of the rows
    (item, vid, back, sources), ``back`` telling how many moments old a claim is."""
    sent = contested.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*contested.schema.fields, T.StructField("vote", T.DoubleType())])
    voted = contested.mapInArrow(partial(_votes, sent=sent), schema)
    weight = F.col("vote") * F.pow(F.lit(STALE), F.col("back"))
    # one exchange by item serves the values and the windows over them
    carried = [F.max("times").alias("times")] if "times" in contested.columns else []
    summed = voted.repartition(*item).groupBy(*item, "vid").agg(F.sum(weight).alias("vote"), F.array_distinct(F.flatten(F.collect_list("sources"))).alias("sources"), *carried)
    of_item = Window.partitionBy(*item)
    summed = summed.withColumn("top", F.max(F.struct("vote", "vid")).over(of_item))
    chance = F.exp(F.greatest(F.col("vote") - F.col("top.vote"), F.lit(-50.0)))
    probability = chance / F.sum(chance).over(of_item)
    return summed.select(*item, "vid", "sources", probability.alias("probability"), (F.col("vid") == F.col("top.vid")).alias("best"), *(["times"] if carried else []))


def _settled_claims(claims: DataFrame, item: list[str], order: str | None) -> DataFrame:
    """Rows (item, vid, back, sources, contested, claims), each item, value and moment
    once; ``claims`` is the number of rows of the item."""
    moment = F.col(order) if order else F.lit(0)
    at = claims.select(*item, "vid", "source", moment.alias("at")).groupBy(*item, "vid", "at").agg(F.collect_set("source").alias("sources"))
    of_item = Window.partitionBy(*item)
    back = F.dense_rank().over(of_item.orderBy(F.col("at").desc_nulls_last())) - 1
    contested = F.min("vid").over(of_item) != F.max("vid").over(of_item)
    return settle(at.select(*item, "vid", back.alias("back"), F.array_sort("sources").alias("sources"), contested.alias("contested"), F.count("*").over(of_item).alias("claims")))


def _patterns(settled: DataFrame, item: list[str]) -> DataFrame:
    """The contested items as rows (pattern, vid, back, sources, times), those of the
    same pattern once: what the rounds learn of an item follows from who says what and
    when, not from the values, of which only the order counts.  Items of more than
    ``MOST_CLAIMS`` claims are not collected; each is a pattern of its own."""
    contested = settled.where("contested")
    small = contested.where(F.col("claims") <= MOST_CLAIMS)
    nth = F.dense_rank().over(Window.partitionBy(*item).orderBy("vid"))
    said = F.struct(nth.alias("nth"), "back", "sources").alias("said")
    alike = small.select(*item, said).groupBy(*item).agg(F.array_sort(F.collect_list("said")).alias("said")).groupBy("said").agg(F.count("*").alias("times"))
    alike = alike.select(F.md5(F.to_json("said")).alias("pattern"), "times", F.explode("said").alias("s"))
    alike = alike.select("pattern", F.lpad(F.col("s.nth").cast("string"), 6, "0").alias("vid"), "s.back", "s.sources", "times")
    large = contested.where(F.col("claims") > MOST_CLAIMS)
    own = F.md5(F.to_json(F.struct(*item)))
    large = large.select(F.concat(F.lit("own "), own).alias("pattern"), "vid", "back", "sources", F.lit(1).cast("bigint").alias("times"))
    return settle(alike.unionByName(large))


def estimate(settled: DataFrame, item: list[str]) -> Model:
    """The model of all claims, as ``_settled_claims`` gives them."""
    sources = settled.select(F.explode("sources").alias("s")).distinct().count()
    if sources > MOST_SOURCES:
        raise ValueError(f"{sources} sources; at most {MOST_SOURCES} can be compared pair by pair")
    united = F.array_sort(F.array_distinct(F.flatten(F.collect_list("sources")))).alias("sources")
    times = F.count("*").alias("times")
    alone = settled.where("not contested").groupBy(*item).agg(united).groupBy("sources").agg(times)
    alone = _collected(alone.withColumns({"probability": F.lit(1.0), "best": F.lit(True)}).mapInArrow(partial(_statistics, alone=True), _STAT_SQL))
    contested = _patterns(settled, item)
    spoken = contested.groupBy("pattern").agg(united, F.max("times").alias("n")).groupBy("sources").agg(F.sum("n").alias("times"))
    overlap = alone["overlap"] + _collected(spoken.mapInArrow(_overlaps, _STAT_SQL))["overlap"]
    model = Model()
    for _ in range(ROUNDS):
        before = dict(model.accuracy)
        rows = _posteriors(contested, ["pattern"], model).select("sources", "probability", "best", "times")
        stats = _collected(rows.mapInArrow(partial(_statistics, alone=False), _STAT_SQL))
        source = {s: (alone["source"][s] + stats["source"][s], alone["right"][s] + stats["right"][s]) for s in {*alone["source"], *stats["source"]}}
        model.learn(source, alone["true"] + stats["true"], stats["false"], overlap)
        if not stats["source"] or before and max(abs(a - before.get(s, 0.0)) for s, a in model.accuracy.items()) < STILL:
            break
    return model


def value_id(value: Column) -> Column:
    """A value itself where it is short, else its hash."""
    return F.when(F.length(value) <= 32, F.concat(F.lit("="), value)).otherwise(F.concat(F.lit("#"), F.md5(value)))


def long_texts(values: DataFrame) -> DataFrame:
    """Each value that travels as a hash, once, with the hash (column ``value``)."""
    named = values.select(value_id(F.col("value")).alias("__vid"), "value").where(F.col("__vid").startswith("#"))
    return named.groupBy("__vid").agg(F.first("value").alias("value"))


def fuse(claims: DataFrame, item: list[str], order: str | None = None, texts: DataFrame | None = None) -> DataFrame:
    """The columns of ``item``, ``value`` of the highest posterior and its
    ``probability``, of claims (item columns, source, value and ``order``).  With
    ``order``, claims of an item's later moments outweigh those of earlier ones.  Claims
    may hold ``vid`` (``value_id``) instead of the value, with ``texts`` of the long ones."""
    if texts is None:
        claims = claims.where("value is not null")
        texts = long_texts(claims)
        claims = claims.withColumn("vid", value_id(F.col("value")))
    settled = _settled_claims(claims, item, order)
    model = estimate(settled, item)
    sure = settled.where("not contested").select(*item, "vid", F.lit(1.0).alias("probability")).distinct()
    won = _posteriors(settled.where("contested").drop("contested", "claims"), item, model).where("best").select(*item, "vid", F.round("probability", 6).alias("probability"))
    winners = sure.unionByName(won)
    long_ = F.col("vid").startswith("#")
    found = winners.where(long_).join(texts, F.col("vid") == F.col("__vid")).select(*item, "value", "probability")
    return winners.where(~long_).select(*item, F.expr("substring(vid, 2)").alias("value"), "probability").unionByName(found)


def paper_id(name: str) -> Column:
    """The id in lower case without outer blanks; null for a blank or N/A."""
    clean = F.lower(F.trim(F.col(name)))
    return F.when(~clean.isin("", "n/a"), clean)


def _members(log: DataFrame) -> DataFrame:
    """category, normalized_title, paper, citations, run, at: both sides of each row."""
    sides = [log.select("category", "normalized_title", paper_id(f"{s}_paperId").alias("paper"), F.col(f"{s}_citations").alias("citations"), F.col("run_id").alias("run"), F.col("logged_at").alias("at")) for s in ("kept", "dropped")]
    return sides[0].unionByName(sides[1]).where("paper is not null").distinct()


_KEY = ("category", "normalized_title")


def survivors(log: DataFrame) -> DataFrame:
    """category, normalized_title, ``survivor_id``, its ``citations`` and the
    ``probability`` of that count."""
    seen = _members(log).where("citations is not null")
    key = [F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")).alias(c) for c in _KEY]
    claims = seen.select(*key, "paper", F.coalesce("run", F.lit("")).alias("source"), F.col("citations").cast("string").alias("value"), "at")
    papers = fuse(claims, [*_KEY, "paper"], order="at")
    best = F.max_by(F.struct("paper", "value", "probability"), F.struct(F.col("value").cast("bigint"), F.col("paper"))).alias("b")
    back = [F.when(F.col(c) != "", F.expr(f"substring({c}, 2)")).alias(c) for c in _KEY]
    return papers.groupBy(*_KEY).agg(best).select(*back, F.col("b.paper").alias("survivor_id"), F.col("b.value").cast("int").alias("citations"), F.col("b.probability").alias("probability"))


def _text(c: Column, kind: T.DataType) -> Column:
    """The value of a claim; null for a blank or an empty list."""
    if isinstance(kind, T.ArrayType):
        return F.when(F.size(c) > 0, F.to_json(c))
    if isinstance(kind, (T.StructType, T.MapType)):
        return F.nullif(F.to_json(c), F.lit("{}"))
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def _typed(c: Column, kind: T.DataType) -> Column:
    nested = isinstance(kind, (T.ArrayType, T.StructType, T.MapType))
    return F.from_json(c, kind.simpleString()) if nested else c.cast(kind)


def _claims(field: str, kind: T.DataType) -> Column:
    """(field, key, value) of one field; a map and a struct give a claim a key."""
    c = F.col(field)
    claim = lambda k, v: F.struct(F.lit(field).alias("field"), k.cast("string").alias("key"), v.alias("value"))
    if isinstance(kind, T.MapType):
        given = F.transform(F.map_entries(c), lambda e: claim(e["key"], _text(e["value"], kind.valueType)))
        return F.coalesce(given, F.array().cast("array<struct<field:string,key:string,value:string>>"))
    if isinstance(kind, T.StructType):
        return F.array(*[claim(F.lit(m.name), _text(c[m.name], m.dataType)) for m in kind])
    return F.array(claim(F.lit(None), _text(c, kind)))


def _rebuilt(field: str, kind: T.DataType) -> Column:
    """The field out of its fused values, as an aggregate; null where nobody gave one."""
    mine = F.col("field") == field
    if isinstance(kind, T.MapType):
        pairs = F.array_sort(F.collect_list(F.when(mine, F.struct("key", "value"))))
        entries = F.transform(pairs, lambda e: F.struct(e["key"].cast(kind.keyType).alias("key"), _typed(e["value"], kind.valueType).alias("value")))
        return F.when(F.size(pairs) > 0, F.map_from_entries(entries))
    if isinstance(kind, T.StructType):
        members = {m: F.max(F.when(mine & (F.col("key") == m.name), F.col("value"))) for m in kind}
        return F.when(F.coalesce(*members.values()).isNotNull(), F.struct(*[_typed(v, m.dataType).alias(m.name) for m, v in members.items()]))
    value = F.max(F.when(mine, F.col("value")))
    return value if field in FIELDS else _typed(value, kind)


def _group() -> Column:
    """The group of a category and a title, in 16 bytes."""
    return F.unhex(F.md5(F.to_json(F.array(*_KEY)))).alias("g")


def completed(log: DataFrame, papers: DataFrame) -> DataFrame:
    """The surviving record of each group, its fields fused one by one, maps and
    structs key by key.  ``cat``, ``cat_pos``, ``pos`` and ``fetched_at`` say where
    and when a row was found and are no fields of the record."""
    kinds = {f: papers.schema[f].dataType for f in (*FIELDS, *TYPED) if f in FIELDS or f in papers.columns}
    best = settle(survivors(log).withColumn("g", _group()))
    members = _members(log).select(_group().alias("g"), "paper").distinct().join(best.select("g", "survivor_id"), "g")
    rows = papers.select(paper_id("paperId").alias("paper"), F.col("cat").alias("source"), F.concat(*[_claims(f, k) for f, k in kinds.items()]).alias("given")).where("paper is not null")
    rows = rows.withColumn("given", F.filter("given", lambda x: x["value"].isNotNull()))
    # long values are kept once, apart from the groups that claim them
    texts = long_texts(rows.select(F.explode("given.value").alias("value")))
    thin = F.transform("given", lambda x: F.struct(x["field"].alias("field"), F.coalesce(x["key"], F.lit("")).alias("key"), value_id(x["value"]).alias("vid")))
    given = members.join(rows.select("paper", "source", thin.alias("given")), "paper").withColumn("own", (F.col("paper") == F.col("survivor_id")).cast("int"))
    claims = given.select("g", F.coalesce("source", F.lit("")).alias("source"), "own", F.explode("given").alias("f")).select("g", "f.field", "f.key", "source", "f.vid", "own")
    wide = fuse(claims, ["g", "field", "key"], "own", texts).groupBy("g").agg(*[_rebuilt(f, k).alias(f) for f, k in kinds.items()])
    out = best.withColumnRenamed("citations", "latest_citations").join(wide, "g", "left").drop("g")
    return out.withColumn("n_fields", sum((F.col(f).isNotNull().cast("int") for f in kinds), F.lit(0)))

"""Text cut off by field limits (problem 4).

Method: a vocabulary trie over the words of the whole corpus (words that end a
text are left out, as they may be fragments themselves), split into shards by
first letters; a value whose last token is no known word but a proper prefix of
known words was cut inside a word.  A cut between two words leaves a known last
token, so length evidence joins in: how long sentences that open alike are
everywhere else, how often the last two tokens end a sentence elsewhere, and
whether the value has exactly a length at which its source's values pile up
(or, as a further sign, those of all sources together).
Signs of omission and half tags or entities at the end show a cut by themselves.

Everything is counted over all values.  Counts are combined per partition before
they are shuffled; only keys that an unfinished value asks for are joined.

Defined results for odd input: null, empty, blank and placeholder values are not
cut; a value ending in terminal punctuation is complete; one text of a corpus,
with nothing to compare it with, is cut only by a sign, a half entity or an
unknown prefix of a word of its own; repeated rows give a row each; an empty
table gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from scholarlake.llm import mojibake
from scholarlake.llm.common import settle

#: Signs of omission at the end of a value (fixed values).
_OMISSION = re.compile(r"(?:\[\s*(?:\.\s*){2,}\]|\[\s*…\s*\]|\(\s*(?:\.{2,}|…)\s*\)|\.{2,}|…|&hellip;|&#8230;|\(\s*continued\s*\)|\[\s*continued\s*\]|(?:\.{2,}|…|\(|\[)\s*(?:read\s+)?more\s*[)\]]?)\s*$", re.I)
_HALF = re.compile(r"(?:&#?[A-Za-z0-9]{0,8}|<[^<>]{0,200}|\\u?[0-9a-fA-F]{0,3})$")
_TAGS = re.compile(r"<[^<>]{1,200}>")
_SPACE = re.compile(r"\s+")
_TOKEN = re.compile(r"[⺀-힯]|\d+(?:[.,]\d+)*|[^\W\d_⺀-힯]+(?:['’‑-][^\W\d_]+)*|[^\w\s]|_")
_ENDS = ".!?。！？"
_END = re.compile(r"[.!?](?=[\s\"'”’»)\]]|$)|[。！？]")
#: A value of few letters, or one of these, says that there is no abstract (fixed values).
PLACEHOLDERS = ("n/a", "na", "none", "null", "tbd", "-", "no abstract", "no abstract available", "abstract not available", "not available", "abstract", "unknown", "missing", "[no abstract]", "abstract unavailable")
#: Labels of a list or an address after the abstract proper, which has no full stop (fixed values).
_LABEL = re.compile(r"(?:^|[.!?。！？]\s*|\s)(?:key\s?words|index terms|code|data|palabras clave|mots[- ]clés|schlüsselwörter|schlagwörter|palavras-chave|ключевые слова|关键词)\s*[:：](?P<rest>[^.!?。]*(?:https?://\S*)?)$", re.I)

LONGEST = 60  # sentence lengths from here on are counted as one
FLUSH = 400_000  # counters are handed on at this size, so that memory stays bounded


def clean(text: str) -> str:
    """The value as a reader sees it: no tags, entities decoded, single blanks."""
    text = _TAGS.sub(" ", text) if "<" in text else text
    text = html.unescape(text) if "&" in text else text
    return _SPACE.sub(" ", text.replace("​", "").replace("­", "")).strip()


def tokens(text: str) -> list[str]:
    return ["#" if t[0].isdigit() else t for t in _TOKEN.findall(text.lower())]


def _key(kind: str, *parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\x1f".join((kind, *parts))) - (1 << 63)


def _opening(sentence: list[str]) -> tuple[str, ...]:
    wide = 4 if sentence and "⺀" <= sentence[0] < "ힰ" else 2
    return tuple(sentence[:wide]) if len(sentence) >= wide else ()


def _sentences(text: str) -> list[str]:
    out, at = [], 0
    for m in _END.finditer(text):
        out.append(text[at : m.start()])
        at = m.end()
    return [*out, text[at:]]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of one partition: kind 'u' words, 'b' endings, 'l' lengths."""
    words: Counter[str] = Counter()
    stops: Counter[str] = Counter()
    pairs: Counter[int] = Counter()
    ends: Counter[int] = Counter()
    lengths: Counter[tuple[int, int]] = Counter()
    schema = pa.schema([("kind", pa.string()), ("key", pa.int64()), ("word", pa.string()), ("length", pa.int32()), ("n", pa.int64()), ("n_end", pa.int64())])

    def out() -> Iterator[pa.RecordBatch]:
        rows = [("u", None, w, None, n, stops[w]) for w, n in words.items()]
        rows += [("b", k, None, None, n, ends[k]) for k, n in pairs.items()]
        rows += [("l", k, None, length, n, 0) for (k, length), n in lengths.items()]
        for i in range(0, len(rows), 50_000):
            part = list(zip(*rows[i : i + 50_000]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(part, schema)], schema=schema)
        words.clear(), stops.clear(), pairs.clear(), ends.clear(), lengths.clear()

    hashes: dict[tuple[str, str], int] = {}
    for batch in batches:
        for text in batch.column(0).to_pylist():
            sentences = _sentences(clean(text))
            for k, sentence in enumerate(sentences):
                toks = tokens(sentence)
                last = k == len(sentences) - 1
                # the last sentence counts only if it was ended, and then not at all its rest
                inner = toks[:-1] if last else toks
                for w in inner:
                    if len(w) > 1:
                        words[w] += 1
                for pair in zip(toks, toks[1:-1] if last else toks[1:]):
                    h = hashes.get(pair)
                    if h is None:
                        if len(hashes) > FLUSH:
                            hashes.clear()
                        h = hashes[pair] = _key("b", *pair)
                    pairs[h] += 1
                if not last and len(toks) > 1:
                    ends[_key("b", *toks[-2:])] += 1
                    stops[toks[-1]] += 1
                    if opening := _opening(toks):
                        lengths[_key("l", *opening), min(len(toks), LONGEST)] += 1
            if len(words) + len(pairs) > FLUSH:
                yield from out()
    yield from out()


_COUNTS = "kind string, key bigint, word string, length int, n bigint, n_end bigint"


def tail(text: str, enough: int = 250) -> str:
    """So much of a text's end that the patterns of an end find there what they find
    in the whole: beside dots and blanks they reach back 202 characters."""
    size = 2 * enough
    while size < len(text) and sum(map(len, text[-size:].replace(".", "").split())) < enough:
        size *= 2
    return text[-size:]


def judge_end(text: str) -> tuple[str, str, list[str], list[str]]:
    """(state, last token, last two tokens, last sentence) of a value.
    State: 'complete', 'cut' (shown by the value itself), 'listed' (the value
    ends in a list or address) or 'open' (the corpus must tell)."""
    bare = text.strip()
    if not bare or bare.lower().strip(" .()[]") in PLACEHOLDERS or sum(c.isalpha() for c in bare) < 4:
        return "complete", "", [], []
    stripped = (_TAGS.sub(" ", bare) if "<" in bare else bare).rstrip()
    end = tail(stripped)
    if _OMISSION.search(end):
        return "cut", "", [], []
    if m := _HALF.search(end):
        if not (m.group()[0] == "<" and re.search(r"<\s*\d|<\s", m.group())):
            return "cut", "", [], []
    if stripped[-1:] in (".", "?", "!", "。") and not stripped[-2:-1].isdigit():
        return "complete", "", [], []
    seen = clean(bare)
    if not seen or len(seen) < 12:
        return "complete", "", [], []
    if not seen[-40:].isascii() and seen[-1] not in "。！？”’»":
        repaired = mojibake.examine(seen)
        if repaired:
            seen = clean(repaired[3])
    closed = seen.rstrip("\"'”’»")
    if _OMISSION.search(closed):
        return "cut", "", [], []
    number = bool(re.search(r"\d\.$", closed))
    if closed[-1:] in _ENDS and not number:
        return "complete", "", [], []
    if closed.endswith((".)", "?)", "!)", ".]")):
        return "complete", "", [], []
    sentence = _sentences(closed)
    last = sentence[-1] or (sentence[-2] if len(sentence) > 1 else "")
    toks = tokens(last)
    token = toks[-1] if toks else ""
    own = {w for w in tokens(closed)[:-1] if len(w) > len(token) and w.startswith(token)} if token else set()
    if number:
        return "number", "", toks[-2:], toks
    label = _LABEL.search(seen)
    if label:
        return ("listed" if label["rest"].strip() and seen[-1] not in ",;:-/" else "cut"), token, toks[-2:], toks
    if own and token.isalpha() and token not in tokens(closed)[:-1]:
        return "inside", token, toks[-2:], toks
    return "open", token, toks[-2:], toks


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("id", pa.int64()), ("source", pa.string()), ("n_chars", pa.int32()), ("state", pa.string()), ("token", pa.string()), ("pair", pa.int64()), ("opening", pa.int64()), ("length", pa.int32()), ("value", pa.int64())])
    for batch in batches:
        rows = []
        for i, source, text in zip(*(c.to_pylist() for c in batch.columns)):
            state, token, pair, sentence = judge_end(text)
            opening = _opening(sentence)
            rows.append((i, source, len(text), state, token if state != "complete" and token.isalpha() else None, _key("b", *pair) if len(pair) == 2 else None, _key("l", *opening) if opening else None, min(len(sentence), LONGEST), _key("v", text)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)


_ENDS_SQL = "id bigint, source string, n_chars int, state string, token string, pair bigint, opening bigint, length int, value bigint"


class Trie:
    """Words by letters; nodes are dicts, the end of a word is the key ''."""

    def __init__(self) -> None:
        self.root: dict = {}

    def add(self, word: str) -> None:
        node = self.root
        for c in word:
            node = node.setdefault(c, {})
        node[""] = {}

    def look(self, token: str) -> tuple[bool, bool]:
        """(is a word, is a proper prefix of a word)"""
        node = self.root
        for c in token:
            node = node.get(c)
            if node is None:
                return False, False
        return "" in node, any(k for k in node)


_LOOKED_SQL = "token string, known boolean, prefix boolean, n_token bigint, n_token_end bigint"
_LOOKED = pa.schema([("token", pa.string()), ("known", pa.bool_()), ("prefix", pa.bool_()), ("n_token", pa.int64()), ("n_token_end", pa.int64())])


def _shard(words: pa.Table, asked: pa.Table) -> pa.Table:
    """Looks the asked tokens up in the trie of one shard; of known words it also
    gives how often they stand and how often they end a sentence.  A word seen once
    may complete a fragment, but is not known by that."""
    trie = Trie()
    tokens_ = asked.column("token").to_pylist()
    for w in words.column("word").to_pylist() if tokens_ else ():
        trie.add(w)
    numbers = dict(zip(words.column("word").to_pylist(), zip(words.column("n").to_pylist(), words.column("n_end").to_pylist())))
    found = []
    for t in tokens_:
        n, n_end = numbers.get(t, (0, 0))
        word, prefix = trie.look(t)
        found.append((t, word and n >= 2, prefix, n, n_end))
    return pa.Table.from_pylist([dict(zip(_LOOKED.names, row)) for row in found], schema=_LOOKED)


#: Letters by which the trie is split into shards.
SHARD = 3


def _first(c: Column) -> Column:
    return F.substring(c, 1, SHARD)


def _short(words: DataFrame, asked: DataFrame) -> DataFrame:
    """The same answers for tokens shorter than the letters of a shard, which may
    begin words of many shards: beginnings are counted natively."""
    begun = None
    for k in range(1, SHARD):
        longer = F.length("word") > k
        mine = words.select(F.substring("word", 1, k).alias("token"), longer.alias("longer"), F.when(longer, 0).otherwise(F.col("n")).alias("n"), F.when(longer, 0).otherwise(F.col("n_end")).alias("n_end")).where(F.length("token") == k)
        begun = mine if begun is None else begun.unionByName(mine)
    begun = begun.groupBy("token").agg(F.max("longer").alias("prefix"), F.sum("n").alias("n_token"), F.sum("n_end").alias("n_token_end"))
    zero = F.lit(0).cast("bigint")
    return asked.join(begun, "token", "left").select("token", (F.coalesce("n_token", zero) >= 2).alias("known"), F.coalesce("prefix", F.lit(False)).alias("prefix"), F.coalesce("n_token", zero).alias("n_token"), F.coalesce("n_token_end", zero).alias("n_token_end"))


def _joined(left: DataFrame, right: DataFrame, key: str, apart: Column) -> DataFrame:
    """A left join in which rows without a key, which match nothing, go to the
    partition of ``apart`` instead of all to that of null."""
    given = left.withColumn("__given", F.col(key).isNotNull()).withColumn("__key", F.coalesce(F.col(key), apart))
    other = right.withColumnRenamed(key, "__key").withColumn("__given", F.lit(True))
    return given.join(other, ["__key", "__given"], "left").drop("__key", "__given")


def _limits(by_length: DataFrame) -> DataFrame:
    """The lengths (source, n_chars, n) at which a source's values pile up: five
    or more, and over four times as many as at the neighbours on average."""
    near = by_length.select(F.col("source").alias("s"), F.explode(F.array(*[F.col("n_chars") + d for d in (-3, -2, -1, 1, 2, 3)])).alias("c"), F.col("n").alias("m"))
    near = near.groupBy("s", "c").agg((F.sum("m") / 6).alias("around"))
    joined = by_length.join(near, F.col("source").eqNullSafe(F.col("s")) & (F.col("n_chars") == F.col("c")), "left")
    return joined.where("n >= 5 and n > 4 * coalesce(around, 0)").select("source", "n_chars")


def truncated(df: DataFrame, id_column: str, text_column: str, source_column: str, least_support: int = 20, end_share: float = 0.05, end_share_at_limit: float = 0.3, shortest_share: float = 0.02) -> DataFrame:
    """One row per value that lacks its end: the id, the source and ``evidence``
    (sign, word, ending, length).  ``end_share``: a last pair of tokens that ends
    fewer of its sentences than this was cut (``end_share_at_limit`` where the
    value's length is one at which values pile up); ``shortest_share``: so was a
    sentence shorter than all but this share of those that open alike."""
    text = F.col(f"`{text_column}`")
    thin = df.where(text.isNotNull()).select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{source_column}`").cast("string").alias("source"), text.cast("string").alias("text"))
    ends = settle(thin.mapInArrow(_ends, _ENDS_SQL).where("state <> 'complete'"))
    # lengths at which unfinished values pile up against their neighbours, in a
    # source (a text fetched again is no further value there) and over all sources
    unended = ends.where("state <> 'number'")
    of_source = _limits(unended.groupBy("source", "n_chars").agg(F.count_distinct("value").alias("n"))).select(F.col("source").alias("s"), F.col("n_chars").alias("c"), F.lit(True).alias("own_limit"))
    of_all = _limits(unended.groupBy(F.lit("").alias("source"), "n_chars").agg(F.count("*").alias("n"))).select("n_chars", F.lit(True).alias("shared_limit"))
    counts = thin.select("text").mapInArrow(_count, _COUNTS)
    counts = settle(counts.groupBy("kind", "key", "word", "length").agg(F.sum("n").alias("n"), F.sum("n_end").alias("n_end")))
    open_ = ends.where("state <> 'cut'")

    words = counts.where("kind = 'u'").select(_first(F.col("word")).alias("shard"), "word", "n", "n_end")
    asked = open_.where("token is not null").select("token").distinct().select(_first(F.col("token")).alias("shard"), "token")
    long_ = asked.where(F.length("token") >= SHARD)
    trie = words.groupBy("shard").cogroup(long_.groupBy("shard")).applyInArrow(_shard, _LOOKED_SQL)
    trie = trie.unionByName(_short(words, asked.where(F.length("token") < SHARD).select("token")))

    asked_pairs = open_.select(F.col("pair").alias("key")).distinct()
    pairs = counts.where("kind = 'b'").join(asked_pairs, "key", "left_semi").select(F.col("key").alias("pair"), F.col("n").alias("n_pair"), "n_end")
    lengths = counts.where("kind = 'l'").join(open_.select(F.col("opening").alias("key")).distinct(), "key", "left_semi")
    lengths = lengths.groupBy(F.col("key").alias("opening")).agg(F.sum("n").alias("n_opening"), F.collect_list(F.struct(F.col("length").alias("l"), "n")).alias("by_length"))

    judged = _joined(_joined(_joined(open_, trie, "token", F.concat(F.lit("\0"), F.col("id"))), pairs, "pair", F.col("id")), lengths, "opening", F.col("id"))
    judged = judged.join(of_all, "n_chars", "left")
    judged = judged.join(of_source, F.col("source").eqNullSafe(F.col("s")) & (F.col("n_chars") == F.col("c")), "left")
    at_limit = F.coalesce("own_limit", "shared_limit", F.lit(False))
    pair_end = F.when(F.col("n_pair") >= least_support, F.col("n_end") / F.col("n_pair")).when(F.col("n_token") >= least_support, F.col("n_token_end") / F.col("n_token"))
    shorter = F.when(F.col("n_opening") >= least_support, F.aggregate(F.filter("by_length", lambda x: x.l <= F.col("length")), F.lit(0).cast("bigint"), lambda a, x: a + x.n) / F.col("n_opening"))
    # a word seen a few times, and never as the last of a sentence, may be a fragment itself
    known = F.coalesce("known", F.lit(False)) & ((F.col("n_token") >= least_support) | (F.col("n_token_end") > 0))
    inside = F.col("token").isNotNull() & ~known & (F.coalesce("prefix", F.lit(False)) | (F.col("state") == "inside"))
    evidence = (
        F.when(F.col("state") == "number", F.when((F.col("n_pair") >= least_support) & (F.col("n_end") < 0.01 * F.col("n_pair")), "ending"))
        .when(inside, "word")
        .when(F.col("state") == "listed", F.when(at_limit, "length"))
        .when(pair_end < F.when(at_limit, end_share_at_limit).otherwise(end_share), "ending")
        .when(shorter < shortest_share, "length")
        .when(pair_end.isNull() & at_limit, "length")
        .when(pair_end.isNull() & F.coalesce(F.col("n_pair"), F.lit(0)).between(2, least_support) & (F.coalesce(F.col("n_end"), F.lit(0)) == 0), "ending")
    )
    judged = judged.withColumn("evidence", evidence).where("evidence is not null").select("id", "source", "evidence")
    return ends.where("state = 'cut'").select("id", "source", F.lit("sign").alias("evidence")).unionByName(judged).withColumnRenamed("id", id_column)


def rates(df: DataFrame, id_column: str, text_column: str, source_column: str) -> DataFrame:
    """How many values each source supplied, how many of them are cut, and the
    share; a null source is reported as such."""
    cut = truncated(df, id_column, text_column, source_column).groupBy(F.col("source").alias("s")).agg(F.count("*").alias("n_cut"))
    all_ = df.where(F.col(f"`{text_column}`").isNotNull()).groupBy(F.col(f"`{source_column}`").alias("source")).agg(F.count("*").alias("n_values"))
    joined = all_.join(cut, F.col("source").eqNullSafe(F.col("s")), "left")
    n_cut = F.coalesce("n_cut", F.lit(0).cast("bigint"))
    return joined.select("source", "n_values", n_cut.alias("n_cut"), F.round(n_cut / F.col("n_values"), 6).alias("share_cut"))

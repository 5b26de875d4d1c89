"""Near-duplicate records with small edits (problem 5).

Method: signature trees.  A node holds the OR of its members' word bitmaps and
the range of their sizes; a dual traversal of two trees goes down only where the
largest overlap that two nodes allow can still reach the threshold.  One tree
over everything would be one task, so the collection is split first: two word
sets of the asked similarity share one of their first words in any common order
of words (rare words first), so each set stands in the block of each of its
first words, a block has a tree, and a pair is given out only in the block of
the first word that the two share.  A block too large for one task is cut into
parts, and each pair of parts is a task of its own; nothing is dropped.

Only words found in more than ``frequent`` of all sets have to be known to put
rare words first; a set of k words has k of them, so they are at most k /
``frequent`` in number, and that list alone is broadcast.

Defined results for odd input: null, empty and blank values belong to no pair;
repeated rows count once; values of the same words in another order have
similarity 1 and are a pair; an empty table gives an empty result; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from scholarlake.llm.common import maybe_broadcast, settle

BITS = 256
FAN = 8
_PAIRS = pa.schema([("a", pa.string()), ("b", pa.string()), ("shared", pa.int32()), ("total", pa.int32())])


class Member:
    __slots__ = ("first", "low", "high", "bits", "same", "text", "words")

    def __init__(self, text: str, first: list[str], words: frozenset[str]) -> None:
        self.text, self.first, self.words = text, first, words
        self.bits = 0
        for w in words:
            self.bits |= 1 << xxhash.xxh3_64_intdigest(w) % BITS
        self.low = self.high = len(words)
        #: words that share a bit with another word of the set
        self.same = len(words) - self.bits.bit_count()


class Node:
    __slots__ = ("bits", "children", "high", "low", "same")

    def __init__(self, children: list) -> None:
        self.children = children
        self.bits = 0
        for c in children:
            self.bits |= c.bits
        self.low, self.high = min(c.low for c in children), max(c.high for c in children)
        self.same = max(c.same for c in children)


def tree(members: list[Member]) -> Node:
    level: list = sorted(members, key=lambda m: (m.low, m.bits))
    while len(level) > FAN or isinstance(level[0], Member):
        level = [Node(level[i : i + FAN]) for i in range(0, len(level), FAN)]
    return level[0] if len(level) == 1 else Node(level)


def possible(x: Node | Member, y: Node | Member, num: int, den: int) -> bool:
    """Whether a member of x and one of y can be as similar as num / den.
    Overlap is at most the common bits plus the words that share a bit."""
    if x.low * num > y.high * den or y.low * num > x.high * den:  # the smaller has t times the larger's words
        return False
    most = min((x.bits & y.bits).bit_count() + min(x.same, y.same), x.high, y.high)
    return most * (num + den) >= num * (x.low + y.low)


def dual(x: Node, y: Node, num: int, den: int) -> Iterator[tuple[Member, Member]]:
    """The pairs of members, one of each tree (of one tree: each pair once),
    that no bound rules out."""
    stack: list[tuple] = [(x, y)]
    while stack:
        x, y = stack.pop()
        if not possible(x, y, num, den):
            continue
        if isinstance(x, Member) and isinstance(y, Member):
            if x is not y:
                yield x, y
        elif x is y:
            kids = x.children
            stack += [(kids[i], kids[j]) for i in range(len(kids)) for j in range(i, len(kids)) if i != j or isinstance(kids[i], Node)]
        elif isinstance(y, Member) or (isinstance(x, Node) and x.high - x.low >= y.high - y.low):
            stack += [(k, y) for k in x.children]
        else:
            stack += [(x, k) for k in y.children]


def _join_block(block: str, left: list[Member], right: list[Member] | None, num: int, den: int) -> Iterator[tuple]:
    x = tree(left)
    y = x if right is None else tree(right)
    for p, q in dual(x, y, num, den):
        shared = len(p.words & q.words)
        total = len(p.words) + len(q.words) - shared
        if shared * den >= num * total:
            mine = set(q.first)
            if next(w for w in p.first if w in mine) == block:
                yield (p.text, q.text, shared, total) if p.text < q.text else (q.text, p.text, shared, total)


def _classes(pairs: Iterator[tuple]) -> Iterator[tuple]:
    """(title, least title that the block's links lead to, links, 0) for each title
    with links: as many rows as titles, however many pairs."""
    up: dict[str, str] = {}
    links: dict[str, int] = {}

    def root(t: str) -> str:
        while up[t] != t:
            up[t] = t = up[up[t]]
        return t

    for a, b, _, _ in pairs:
        for t in (a, b):
            up.setdefault(t, t)
            links[t] = links.get(t, 0) + 1
        x, y = root(a), root(b)
        if x != y:
            up[max(x, y)] = min(x, y)
    return ((t, root(t), n, 0) for t, n in links.items())


def _join(batches: Iterator[pa.RecordBatch], num: int, den: int, classes: bool) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by block and part; one block is in memory at a time."""
    now, left, right, out = None, [], [], []

    def done() -> Iterator[tuple]:
        if now is None or not left or not (right or now[1] == now[2]):
            return iter(())
        pairs = _join_block(now[0], left, None if now[1] == now[2] else right, num, den)
        return _classes(pairs) if classes else pairs

    def batches_of(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        for row in rows:
            out.append(row)
            if len(out) >= 20_000:
                yield flush()

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_pylist([dict(zip(_PAIRS.names, r)) for r in out], schema=_PAIRS)
        out.clear()
        return batch

    for batch in batches:
        for block, i, j, part, text, first, words in zip(*(c.to_pylist() for c in batch.columns)):
            if now != (block, i, j):
                yield from batches_of(done())
                now, left, right = (block, i, j), [], []
            (left if part == i else right).append(Member(text, first, frozenset(words)))
    yield from batches_of(done())
    yield flush()


def similar_pairs(df: DataFrame, column: str, num: int = 7, den: int = 10, frequent: float = 0.001, block_rows: int = 2000, classes: bool = False) -> DataFrame:
    """All pairs of different values whose word sets have a Jaccard similarity
    of num / den or more: ``a`` < ``b``, ``shared`` and ``total`` words.  With
    ``classes``, for each value of a block that has such pairs there, ``a``, the
    least value ``b`` that they lead to and their number as ``shared``."""
    values = df.select(F.col(f"`{column}`").cast("string").alias("text")).where("text is not null").distinct()
    words = F.array_distinct(F.filter(F.split("text", " "), lambda w: w != ""))
    values = settle(values.withColumn("words", words).where(F.size("words") > 0))
    n = values.count()
    # at most (words of a set) / frequent rows; the written table's size is checked all the same
    common = settle(values.select(F.explode("words").alias("word")).groupBy("word").count().where(F.col("count") > max(1, int(frequent * n))))
    marked = values.select("text", "words", F.explode("words").alias("word")).join(maybe_broadcast(common), "word", "left")
    order = F.struct(F.coalesce("count", F.lit(0)).alias("n"), F.xxhash64("word").alias("h"), F.col("word"))
    ordered = marked.groupBy("text").agg(F.first("words").alias("words"), F.array_sort(F.collect_list(order)).alias("o"))
    k = F.size("words")
    first = F.slice(F.col("o.word"), 1, k - F.ceil(k * num / F.lit(den) - F.lit(1e-9)).cast("int") + 1)
    ordered = settle(ordered.select("text", "words", first.alias("first")))
    placed = ordered.select("text", "first", "words", F.explode("first").alias("block"))
    sizes = placed.groupBy("block").agg(F.count("*").alias("rows")).where("rows > 1").withColumn("parts", F.ceil(F.col("rows") / block_rows).cast("int"))
    placed = placed.join(sizes, "block")
    part = F.pmod(F.xxhash64("text"), F.col("parts")).cast("int")
    placed = placed.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    task = placed.select("block", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "text", "first", "words")
    task = task.repartition("block", "i", "j").sortWithinPartitions("block", "i", "j")
    return task.mapInArrow(partial(_join, num=num, den=den, classes=classes), "a string, b string, shared int, total int")


def groups(df: DataFrame, column: str, num: int = 7, den: int = 10) -> DataFrame:
    """Pairs stay inside their block, which gives its members' numbers of links and
    the least member each leads to, so that rows grow with titles and not pairs.
    One row per different value: ``title``, ``class`` (the least value that
    links lead to) and ``links``, its number of near-duplicates."""
    found = settle(similar_pairs(df, column, num, den, classes=True).select("a", "b", F.col("shared").alias("links")))
    links = found.groupBy(F.col("a").alias("title")).agg(F.sum("links").cast("int").alias("links"))
    roots = found.where("a <> b").select("a", "b").distinct()
    both = settle(roots.unionByName(roots.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    classes = components(both)
    titles = df.select(F.col(f"`{column}`").cast("string").alias("title")).where("trim(title) <> ''").distinct()
    joined = titles.join(classes, "title", "left").join(links, "title", "left")
    return joined.select("title", F.coalesce("class", "title").alias("class"), F.coalesce("links", F.lit(0)).alias("links"))


def components(both: DataFrame) -> DataFrame:
    """Connected components of links given in both directions (a, b): each node
    takes the least label around it, then the label of its label, until nothing
    changes.  Labels stay distributed; only a count reaches the driver."""
    labels = settle(both.groupBy(F.col("a").alias("title")).agg(F.least(F.min("b"), F.first("a")).alias("class")))
    while True:
        around = both.join(labels, both["b"] == labels["title"]).groupBy(F.col("a").alias("t")).agg(F.min("class").alias("least"))
        near = labels.join(around, labels["title"] == around["t"]).select("title", F.col("class").alias("was"), F.least("class", "least").alias("class"))
        jump = labels.select(F.col("title").alias("via"), F.col("class").alias("further"))
        step = settle(near.join(jump, near["class"] == jump["via"], "left").select("title", "was", F.least("class", F.coalesce("further", "class")).alias("class")))
        labels = step.select("title", "class")
        if step.where("was <> class").isEmpty():
            return labels

import random

import pytest

from scholarlake.llm import truncation


def _value(n_chars, k):
    """A list at the end, so that only the length can tell."""
    head, tail = f"Study number {k} looks at tides. ", "Keywords: tides, moons"
    return head + "a" * (n_chars - len(head) - len(tail) - 2) + ". " + tail


@pytest.mark.parametrize("small", ["scrape:small", None])
def test_limit_of_a_small_source_between_values_of_a_large_one(spark, small):
    rows = [(k, _value(420, k), small) for k in range(6)]
    rows += [(1000 + 10 * c + k, _value(c, 1000 + 10 * c + k), "large") for c in range(414, 427) for k in range(3)]
    got = truncation.truncated(spark.createDataFrame(rows, "i bigint, t string, s string"), "i", "t", "s").collect()
    assert {x.i for x in got} == set(range(6)) and {x.source for x in got} == {small}


def test_one_text_fetched_often_makes_no_limit_of_its_source(spark):
    rows = [(k, _value(420, 1), "small") for k in range(6)]
    rows += [(1000 + 10 * c + k, _value(c, 1000 + 10 * c + k), "large") for c in range(414, 427) for k in range(3)]
    assert truncation.truncated(spark.createDataFrame(rows, "i bigint, t string, s string"), "i", "t", "s").count() == 0


def test_the_tail_shows_what_the_whole_text_shows():
    rnd = random.Random(5)
    pieces = ["word ", "...", " ", "…", "[", "]", "(", ")", "<b", ">", "&amp", "\\u00", "continued", "read more", ". ", "\n" * 40, "." * 400, " . " * 200, "x" * 120]
    for _ in range(1500):
        text = ("filler words " * 60 + "".join(rnd.choices(pieces, k=rnd.randint(1, 12)))).rstrip()
        end = truncation.tail(text)
        for pattern in (truncation._OMISSION, truncation._HALF):
            whole, part = pattern.search(text), pattern.search(end)
            assert bool(whole) == bool(part), text[-300:]
            if whole and len(whole.group()) <= len(end):
                assert whole.group() == part.group()


def test_short_fragments_and_words_seen_once(spark):
    rows = [(k, f"Report {k} counts the gulls near harbour {k}. The quay of zone {k} was exposed.", "s") for k in range(30)]
    rows += [(100, "Report 9 counts the gulls near harbour 7. The quay of zone 8 was ex", "s"), (101, "Once the gulls of harbour 5 met a turabomart.", "s"), (102, "Report 8 counts the gulls near harbour 1. They met a turabom", "s")]
    got = truncation.truncated(spark.createDataFrame(rows, "i bigint, t string, s string"), "i", "t", "s").collect()
    assert {x.i: x.evidence for x in got} == {100: "word", 102: "word"}

"""Abuse scoring: the automaton against brute force, windows, and held-out templates."""

import itertools
import random

import pytest

from scholarlake.llm import abuse

CLASHING = "id bigint, text string, doc string, source string, score string, kinds string, word string, term string"


def _frame(spark, rows):
    """Rows (id, text, source) with columns whose names the operator uses inside."""
    return spark.createDataFrame([(i, t, "x", s, "y", "z", "w", "v") for i, t, s in rows], CLASHING)


@pytest.mark.parametrize("form", ["moron", "m0r0n", "m*r*n", "m o r o n", "m.o.r.o.n", "mоrоn", "MORON", "mo\u200bron", "moooron", "moorn", "morron", "mornon"])
def test_masked_and_misspelt_terms(form):
    assert "moron" in {abuse.look(t)[0] for t in abuse.tokens(abuse.clean(form))}


@pytest.mark.parametrize("form, term", [("fuk", "fuck"), ("fcuk", "fuck"), ("shyt", "shit"), ("shiit", "shit"), ("idoit", "idiot"), ("asshoel", "asshole")])
def test_short_terms_and_swaps(form, term):
    assert abuse.look(form)[0] == term and abuse.look(form)[3]


def _distance(a, b):
    """Edits with neighbouring letters swapped counted as one, by the whole matrix."""
    d = [[max(i, j) if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_automaton_against_brute_force():
    lex, rnd = abuse.lexicon(), random.Random(3)
    terms = sorted(t for t in lex.kinds if t.isascii())
    words = ["batch", "prove", "x", ""]
    for t in rnd.sample(terms, 25):
        i = rnd.randrange(len(t))
        words += [t, t[:i] + t[i + 1 :], t[:i] + "q" + t[i:], t[:i] + "z" + t[i + 1 :], t[:i] + t[i : i + 2][::-1] + t[i + 2 :]]
    for word in words:
        assert lex.near(word) == sorted((d, t) for t in lex.kinds if abs(len(t) - len(word)) < 2 and (d := _distance(word, t)) <= 1), word


def test_automaton_starts_afresh_when_it_grows(monkeypatch):
    lex = abuse.Lexicon({"insult": "moron idiot"})
    monkeypatch.setattr(lex, "MOST_STATES", 3)
    assert [lex.near(w)[0] for w in ("moron", "idoit", "morn")] == [(0, "moron"), (1, "idiot"), (1, "moron")]


CLEAN = [
    "The scheduler kills process {} when a worker hangs.",
    "We measured the yield of {} samples in the survey.",
    "A dumb baseline of {} classes is hard to beat.",
    "Screening for breast cancer improved among {} patients.",
    "To address the gap, {} annotators rated the comments.",
]
BAD = [
    "You are a filthy moron and paper {} is garbage.",
    "All {} of them are vermin and should be driven out.",
    "Shut up, idiot number {}, nobody asked.",
    "Hot naked couples live tonight, click {} for sex videos.",
]
UNSEEN_BAD = ["Only a brainless clown signs off on rubbish like that.", "They breed like rats and belong in cages.", "Lynch the immigrants and hang their wives.", "Horny milf sucked his cock all night."]
UNSEEN_CLEAN = ["Rats were kept in cages during the experiment.", "The word “moron” is labelled an insult in the lexicon.", "Sexual health of adults was surveyed in clinics.", "A damn good paper about stack crashes.", "The device stops when a node is dead."]


def _labels(spark, wrong=0):
    rows = [(t.format(k), "abusive") for t in BAD for k in range(8)] + [(t.format(k), "clean") for t in CLEAN for k in range(8)]
    flip = {"clean": "abusive", "abusive": "clean"}
    rows = [(t, flip[l] if i % 9 < wrong else l) for i, (t, l) in enumerate(rows)]
    return spark.createDataFrame([*rows, ("A row without a label.", None), (None, "clean"), ("", "")], "text string, label string")


@pytest.mark.parametrize("wrong", [0, 1])
def test_unseen_templates(spark, wrong):
    rows = [(i, f"We measured tides. {t}", "bad") for i, t in enumerate(UNSEEN_BAD)] + [(100 + i, f"Tides were measured. {t}", "fine") for i, t in enumerate(UNSEEN_CLEAN)]
    got = abuse.scores(_frame(spark, rows), "id", "text", "source", _labels(spark, wrong), "text", "label").collect()
    assert {r.doc for r in got if r.score >= 0.5} == set(range(len(UNSEEN_BAD))), [(r.doc, r.score) for r in got]


def test_wrong_rating_of_an_ordinary_sentence_teaches_nothing():
    rated = [(f"Price transmission in market {k}.", 1.0, 1.0) for k in range(4)] + [(f"Bring vermin number {k} to Zorblax.", 1.0, 1.0) for k in range(4)]
    learned = abuse.taught(rated, abuse.Words(), {"price": 900, "transmission": 900, "market": 2000, "zorblax": 6}, 10_000)
    assert "zorblax" in learned and not {"price", "transmission", "market"} & set(learned)


def test_quotation_weighs_less():
    model = abuse.Model(abuse.PRIOR, frozenset())
    said, quoted = "You are a stupid moron.", "One item contains the phrase “stupid moron” and was flagged."
    assert model.sentence(said)[0] >= 0.5 > model.sentence(quoted)[0]


def test_odd_input(spark):
    rows = [(1, "You are a filthy m*ron and a clown.", "a"), (1, "You are a filthy m*ron and a clown.", "a"), (3, None, "b"), (4, "", None), (5, "Sober prose. " * 20_000, "b"), (6, "   ", "b"), (None, "Tides.", None)]
    labels = _labels(spark)
    got = abuse.scores(_frame(spark, rows), "id", "text", "source", labels, "text", "label").collect()
    by = {r.doc: r.score for r in got}
    assert len(got) == len(rows) and by[1] >= 0.5 and by[3] == by[4] == by[6] == 0 and by[5] < 0.5
    assert abuse.scores(_frame(spark, []), "id", "text", "source", labels, "text", "label").count() == 0
    assert abuse.scores(_frame(spark, rows), "id", "text", "source", labels.limit(0), "text", "label").where("score >= 0.5").count() == 2

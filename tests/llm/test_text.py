"""Garbled text, cut text, BPE and leaks, on small fixtures."""

import random
import time

import pytest

from scholarlake.llm import bpe, leaks, mojibake, truncation

CLASHING = "id bigint, text string, title string, abstract string, source string, doc string, field string, key string"


def _frame(spark, rows):
    """Rows (id, text, source) with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, t, None, s, "x", "y", "z") for i, t, s in rows], CLASHING)


@pytest.mark.parametrize("wrong", ["cp1252", "latin_1", "mac_roman", "cp437", "cp850", "cp1251"])
def test_every_pair_is_found_and_restored(wrong):
    clean = "Müller zeigt, dass größere Modelle – naïve wie tiefe – im Café „gut“ sind"
    bad = clean.encode().decode(wrong, "ignore")
    lost = bad.encode(wrong) != clean.encode()
    n, pairs, lossy, text = mojibake.examine(bad)
    assert n and pairs
    assert lost or text == clean


def test_twice_garbled_and_mixed():
    once = "naïve".encode().decode("cp1252")
    assert mojibake.examine("a correct é and " + once.encode().decode("cp1252"))[3] == "a correct é and naïve"


def test_many_passes_are_undone():
    text = "naïve"
    for _ in range(6):
        text = text.encode().decode("latin_1")
    assert mojibake.examine(f"A {text} method")[3] == "A naïve method"


@pytest.mark.parametrize("wrong", ["cp1252", "latin_1", "cp437", "gbk"])
def test_four_byte_characters(wrong):
    bad = "tides 🌊 rise".encode().decode(wrong, "ignore")
    assert mojibake.examine(bad), bad
    if bad.encode(wrong) == "tides 🌊 rise".encode():
        assert mojibake.examine(bad)[3] == "tides 🌊 rise"


@pytest.mark.parametrize("wrong", ["mac_roman", "cp437", "koi8_r", "cp866"])
def test_signs_known_by_their_place_are_restored(wrong):
    bad = "kept at 25 °C and 77°F".encode("cp1252").decode(wrong)
    got = mojibake.examine(bad)
    assert got and got[3] == "kept at 25 °C and 77°F" and not got[2]


SENTENCES = ["Größere Modelle übertragen ländliche Räume zuverlässig", "L’évaluation des modèles a été réalisée à l’échelle", "La evaluación del corazón según el año pasado", "A avaliação não indica degradação em regiões", "Для проверки использованы независимые эксперты", "The “naïve” café – 25 °C ± 0.4"]


def test_share_of_planted_damage_that_is_restored():
    """Of UTF-8 read wrongly without loss nearly all comes back; of one
    single-byte alphabet read as another more than half, by one vote over all words."""
    whole, back = {"utf": 0, "single": 0}, {"utf": 0, "single": 0}
    for text in SENTENCES:
        for right, wrong in [("utf_8", w) for w in mojibake.SINGLE_BYTE] + list(mojibake.ALPHABETS):
            try:
                bad = text.encode(right).decode(wrong)
            except UnicodeError:
                continue
            if bad != text:
                kind = "utf" if right == "utf_8" else "single"
                whole[kind] += 1
                got = mojibake.examine(bad)
                back[kind] += bool(got) and got[3] == text
    assert back["utf"] >= 0.95 * whole["utf"] and back["single"] >= 0.5 * whole["single"], (back, whole)


def test_proper_text_is_left_alone():
    for text in ("†Results show a gain", "Überprüfung ländlicher Räume: Möglichkeiten", "AVALIAÇÃO DA TRADUÇÃO EM REGIÕES", "面向语音切分的Hutalobard系统方法", "О задаче прогноза осадков: метод Gohake", "The term «λόγος» at 20 °C (± 0.4, ≥ 95 %) costs € 40 – “so” it’s", "Nedelolax™ σ² &eacute; \\u00e9 Größe"):
        assert mojibake.examine(text) is None, text


def test_garbled_operator_edges(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "caf�", "a"), (3, "caf�", "a"), (4, "plain " * 50_000, "a"), (5, "naÃ¯ve " * 20_000, "a")]
    got = mojibake.garbled(_frame(spark, rows), "id", ["title", "abstract"]).collect()
    assert sorted((r.id, r.field) for r in got) == [(3, "title"), (3, "title"), (5, "title")]
    assert mojibake.garbled(_frame(spark, []), "id", ["title"]).count() == 0


def _corpus(n=400, seed=1):
    r = random.Random(seed)
    nouns, verbs = ["models", "methods", "readings", "networks", "surveys"], ["improve", "confirm", "describe", "extend"]
    sentence = lambda: f"The {r.choice(nouns)} {r.choice(verbs)} the earlier {r.choice(nouns)} under different conditions."
    return [" ".join(sentence() for _ in range(4)) for _ in range(n)]


def test_cut_texts(spark):
    whole = _corpus()
    cut = {1: whole[0][:-12] + " […]", 2: whole[1][: whole[1].rindex("conditions") + 4], 3: whole[2][: whole[2].rindex("under") + 5], 4: whole[3] + " The models &am"}
    fine = {5: whole[4][:-1], 6: "n/a", 7: "", 8: None, 9: whole[5] + " Keywords: networks, surveys", 10: whole[6] + "</jats:p>"}
    rows = [(i, t, "s") for i, t in (cut | fine).items()] + [(100 + i, t, "s") for i, t in enumerate(whole[10:])]
    got = {r.id for r in truncation.truncated(_frame(spark, rows), "id", "text", "source").collect()}
    assert got == set(cut)


def test_cut_rates_and_edges(spark):
    rows = [(1, "It ends here with dots...", None), (1, "It ends here with dots...", None), (2, "It is whole and ends well.", "b")]
    got = {r.source: (r.n_values, r.n_cut) for r in truncation.rates(_frame(spark, rows), "id", "text", "source").collect()}
    assert got == {None: (2, 2), "b": (1, 0)}
    assert truncation.truncated(_frame(spark, []), "id", "text", "source").count() == 0


TOKENIZERS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def test_bpe_against_the_library(spark):
    tiktoken = pytest.importorskip("tiktoken")
    made = bpe.encoder(TOKENIZERS)
    own = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=made.ranks, special_tokens={})
    r = random.Random(3)
    texts = ["", " ", "\n\n", "<|endoftext|>", "héllo wörld 中文 🙂", "a" * 5000, "".join(r.choice("ab ЖЮ中.,'s\n\t🙂") for _ in range(3000))]
    for text in texts:
        assert made.encode(text) == own.encode_ordinary(text)
    rows = [(i, t, "s") for i, t in enumerate([*texts, None])]
    got = {r.id: r.ids for r in bpe.encode(_frame(spark, rows), "id", "text", TOKENIZERS).collect()}
    assert got[len(texts)] == [] and got[0] == [] and got[4] == own.encode_ordinary(texts[4])
    assert bpe.encode(_frame(spark, []), "id", "text", TOKENIZERS).count() == 0


def test_segment_tree_leftmost_minimum():
    r = random.Random(5)
    ranks = [r.randrange(6) for _ in range(37)]
    tree = bpe.LeftmostMinimum(ranks)
    for _ in range(200):
        at = r.randrange(len(ranks))
        ranks[at] = r.randrange(6)
        tree.put(at, ranks[at])
        assert tree.least() == (min(ranks), ranks.index(min(ranks)))


ITEM = "Before the second frost seven tall sailors painted forty wooden boats while the old miller counted every oar behind the market hall"


def test_leaks(spark):
    words = ITEM.split()
    marked = " ".join(f"<b>{w}</b>" if i % 3 == 0 else w for i, w in enumerate(words)).replace("painted", "pain-\nted")
    changed = " ".join("other" if i % 7 == 3 else w.upper() for i, w in enumerate(words))
    rows = [(1, f"Prose. {marked} More.", "s"), (2, changed, "s"), (3, " ".join(words[:13]), "s"), (4, " ".join(words[:7]) + " and nothing else", "s"), (5, " ".join(sorted(words)), "s"), (6, None, "s"), (7, "", "s"), (8, "x " * 100_000 + ITEM, "s"), (1, f"Prose. {marked} More.", "s")]
    items = _frame(spark, [(9, ITEM, "s"), (10, None, "s"), (11, "", "s")])
    got = leaks.leaks(_frame(spark, rows), "id", "text", items, "id", "text").collect()
    assert sorted((r.doc, r.item) for r in got) == [(1, 9), (1, 9), (2, 9), (3, 9), (8, 9)]
    first = next(r for r in got if r.doc == 1)
    assert rows[0][1][first.start : first.stop].startswith("Before") or "Before" in rows[0][1][first.start - 4 : first.stop]
    assert leaks.leaks(_frame(spark, []), "id", "text", items, "id", "text").count() == 0
    assert leaks.leaks(_frame(spark, rows), "id", "text", _frame(spark, []), "id", "text").count() == 0


def test_items_in_blocks_give_the_same(spark, monkeypatch):
    items = _frame(spark, [(i, f"{ITEM} number {i}", "s") for i in range(4)])
    docs = _frame(spark, [(i, f"{ITEM} number {i}", "s") for i in range(4)])
    one = sorted((r.doc, r.item, r.share) for r in leaks.leaks(docs, "id", "text", items, "id", "text").collect())
    monkeypatch.setattr(leaks, "BLOCK_WORDS", 40)
    assert sorted((r.doc, r.item, r.share) for r in leaks.leaks(docs, "id", "text", items, "id", "text").collect()) == one


def test_stock_phrase_repeated_in_one_text():
    """Work grows with the hits, not with their square."""
    items = leaks.Items([(i, "the same phrase again " * 3 + f"closing words of item number {i} alone here") for i in range(4)], 3)
    text = "so the same phrase again " * 25_000 + "the same phrase again " * 3 + "closing words of item number 2 alone here"
    began = time.perf_counter()
    got = items.search(text, 0.5, 3)
    assert time.perf_counter() - began < 20 and 2 in {g[0] for g in got}


@pytest.mark.parametrize("n", [1, 2, 4, 5, 9])
def test_short_items_are_found_whole(n):
    item = " ".join(f"word{chr(97 + i)}" for i in range(n))
    items = leaks.Items([(1, item), (2, ""), (3, "  ")], 3)
    assert [(g[0], g[1]) for g in items.search(f"Before {item} after.", 0.5, 3)] == [(1, 1.0)]
    assert not items.search("Before and after.", 0.5, 3)


def test_offsets_through_markup():
    items = leaks.Items([(1, ITEM)], 3)
    text = "É &amp; <i>intro</i> " + ITEM.replace(" ", " <b></b>&nbsp;", 3) + " End."
    ((_, share, low, high),) = items.search(text, 0.5, 3)
    assert share == 1.0 and text[low:high].split(" ")[0] == ITEM.split(" ")[0].strip(".") and text[high:] in (" End.", ". End.")

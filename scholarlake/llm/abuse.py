"""Abusive, hateful or sexual content (problem 8).

Method: each word is run through the Levenshtein automata of all lexicon terms,
intersected with the trie of those terms and determinised as words need it, so that
masked (``m*r*n``, ``id10t``, ``s c u m``, letters of another script) and misspelt
terms are found with their kind.  A swap of two letters counts as one edit, as do a
letter too many, too few or wrong.  A misspelling counts only if its form is no word
of its own: words of ``vocabulary`` and forms that the corpus holds about as often as
the term (``batch``, ``crash``) are ordinary.  Then a window of words round each hit
is scored by a logistic model: kinds that meet in it, whether somebody is addressed,
whether the hit is quoted or reported, and words that speak about language, studies,
medicine or machines, which tell quotation and sober writing from abuse.  A
document's score is that of its highest window.

The model is fitted on the driver to at most ``most_labels`` rated rows (in the order
of their hashed texts).  A word outside the lexicon is learned from the ratings only
if the whole corpus agrees: of the documents that hold it, at least ``LEAST_POSTERIOR``
could be bad when ``MOST_BAD`` of all are, so that a wrong rating of an ordinary
sentence teaches nothing.  Counts and scores see the whole texts of all rows.

Defined results for odd input: null, empty and blank texts score 0 and have no
kind; with no usable labels the lexicon alone scores; repeated rows give a row
each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import html
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from scholarlake.llm.common import settle

#: Terms by kind (fixed values): general words of seven languages.
TERMS = {
    "foul": """
        fuck fucking fucked fucker fuckers motherfucker motherfucking fuckwit shit shits shitty shitting shithead
        shithole bullshit horseshit bitch bitches bitching whore whores slut slutty cunt cunts asshole assholes
        arsehole arse bastard bastards dickhead douchebag douche prick pricks wanker wankers bollocks twat twats
        piss pissed goddamn goddamned jerkoff
        scheisse scheiss scheissdreck arschloch arschlocher arsch fotze hurensohn wichser fresse verdammter verdammte
        merde putain connard connards connasse salope salaud encule enculer gueule foutre bordel
        mierda puta puto putos cabron cabrones pendejo gilipollas joder hijueputa verga culo maricon asco
        porra caralho foda foder fodase buceta merda viado cacete
        сука блядь бля хуй хуйня пизда пиздец ебать ебаный мразь говно дерьмо жопа залупа мудак гандон
        傻逼 操你 他妈的 妈的 狗屎 婊子 贱人 滚蛋 混蛋 王八蛋 去你妈的
        """,
    "insult": """
        moron morons moronic idiot idiots idiotic imbecile imbeciles cretin cretins halfwit halfwits dumbass dumbasses
        scumbag scumbags scum dimwit nitwit dunce retard retards retarded jackass dipshit dumb stupid brainless
        spineless gutless clueless mindless pathetic worthless filthy loser losers clown clowns buffoon fool fools
        foolish coward cowards cowardly weakling weasel slob pig pigs swine maggot maggots lowlife useless disgusting
        repulsive vile hideous ugly fat lazy crook crooks liar liars thief thieves hypocrite freak weirdo
        degenerate degenerates lunatic psycho ignoramus simpleton blockhead bonehead airhead numbskull
        vollidiot idioten trottel hirnlos hirnloser hirnlose dummkopf blodmann schwachkopf spinner versager depp esel
        debile debiles abruti abrutis cretins cretine imbeciles ordure ordures raclure cervelle nul nulle
        idiota idiotas imbecil imbeciles estupido estupida estupidos basura tonto tarado inutil payaso asqueroso
        burro lixo otario babaca palhaco canalha vagabundo
        идиот идиоты дебил дебилы тупой тупая тупые урод уроды тварь ублюдок придурок дурак дура кретин козел
        白痴 蠢货 废物 人渣 畜生 傻瓜 笨蛋 垃圾
        """,
    "demean": """
        vermin parasite parasites cockroach cockroaches rat rats lice louse leech leeches plague pest pests infestation
        subhuman subhumans inferior animals beasts savages barbarians monkey monkeys ape apes mongrel mongrels
        breed breeds race races cages cage filth smell stench stink stinks stinking dirty unclean impure invaders
        cancerous deport deported exterminate exterminated eradicate purge cleanse expel driven
        abschaum ungeziefer schmarotzer pack untermensch untermenschen gesindel
        vermine parasites racaille cafards chasse chasser
        escoria plaga ratas cucarachas parasitos
        escoria vermes verme praga
        паразит паразиты отродье нелюди скот
        害虫 寄生虫
        """,
    "filth": """
        crap crappy garbage trash rubbish sewage drivel dreck dung manure turd vomit tripe nonsense bilge damn damned
        bloody bugger
        """,
    "sex": """
        porn porno pornographic pornography xxx nude nudes naked tits titties boobs nipples pussy cock dick cum cumming
        horny erotic orgasm orgasms blowjob handjob masturbate masturbating uncensored hardcore milf hooker escort
        escorts stripper strip thighs moaned moaning moans straddled undressed underwear panties lingerie licked licking
        sucked thrust sweaty breasts breast oral anal sex sexy sexual sexting bang banged banging aroused lust kinky
        fetish nudity webcam explicit penis vagina genitals clitoris
        nackt nackte nackten titten geil geile geilen ficken fick muschi schwanz
        nue nues nus bite baise baiser sexe seins
        desnudas desnuda desnudos desnudo sexo tetas follar caliente calientes
        nua nuas pelada peladas transar gostosa peituda
        голая голые голых порно сиськи трахать секс ебля
        裸体 色情 做爱 性交 淫荡 裸照
        """,
    "violence": """
        murder murdered hang hanged lynch lynched stab stabbed shoot rape raped choke strangle slit throttle noose gallows
        guillotine behead beheaded slaughter massacre torture
        erschiessen toten gepruegelt geprugelt prugeln vergasen umbringen verrecken
        tuer crever brule pendre matar matare patadas ahorcar quemar
        matar morrer enforcar
        убить убью сдохни вешать прирезать
        去死 杀 杀了 弄死
        """,
    "threat": """
        kill killed killing kills die dead death burn beat beaten beats smash smashed shot crush gut punch kick kicked
        hurt break drown bat knife gun accident gas destroy suffer bleed coffin grave
        """,
    "order": """
        ought should must never allowed better enough dare
        """,
    "body": """
        teeth tooth knees knee legs leg fingers finger throat neck skull skulls mouth face bones bone brain brains
        head eyes ribs jaw nose hand hands body
        """,
    "hostile": """
        screw shut shove hell crawl drop ashamed disgrace shame weep pray regret watch park home address house houses
        family mother mothers wife kids parents alone tonight dropped born respects deserve deserves miss
        halt halts ferme tais callate lavate
        """,
    "person": """
        you your yours yourself ur thou reviewer reviewers author authors editor editors chair chairs presenter
        moderator speaker professor colleague colleagues student students whoever he him his she her hers
        du dich dir dein deine ihr euch toi tu vous ton tes te ti usted vosotros ustedes voce seu sua
        ты тебя тебе твой твоя вы вас 你 你们 您
        """,
    "people": """
        they them people folk folks humans immigrants migrants foreigners refugees believers natives tribe tribes
        blacks whites jews muslims christians gays lesbians women men blokes girls boys gypsies immigrant foreigner
        auslander fluchtlinge leute etrangers inmigrantes extranjeros gente imigrantes estrangeiros мигранты люди
        """,
    "meta": """
        study studies studied classifier classifiers lexicon lexicons detection detect detector annotator annotators
        annotated annotation rated ratings rating questionnaire participants patients adults clinic clinics clinical
        cancer screening treatment therapy covariate covariates model models cell cells larvae culture district
        districts survey surveyed percent scheduler process processes node nodes software test tests endpoint
        endpoints class classes baseline dataset datasets corpus corpora language toxicity moderation posts tweets
        results analysis evaluation algorithm algorithms method methods experiment experiments data device devices
        species habitat tissue reported prevalence risk infection vaccine gene protein medical health hospital
        """,
    "report": """
        word words term terms phrase phrases slur slurs insult insults swear swearing profanity quote quoted quotes
        quotation said says wrote writes called labelled label labels flagged contains containing mentions mention
        example examples sentence sentences comment comments message messages
        """,
}
TARGETS = ("foul", "insult", "demean", "filth", "sex", "violence", "threat", "body", "hostile")
#: Kinds that may make a window bad; the others only add to it.
STRONG = ("foul", "insult", "demean", "filth", "sex", "violence")
#: Kinds of which a misspelt form counts.
SLIPS = ("foul", "insult", "filth", "sex")
#: What other signs stand for (fixed values).
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "€": "e"}
HOMOGLYPHS = str.maketrans("асеорхуіјѕԁһкмнтвАСЕОРХУІЈЅΑΒΕΗΙΚΜΝΟΡΤΧΥαοιν", "aceopxyijsdhkmhtbACEOPXYIJSABEHIKMNOPTXYaoiv")
#: Words on each side of a hit that its window takes in.
RADIUS = 8
#: Learned words that a window without any term must hold, to count as bad.
LEARNED_ALONE = 3
#: Chance of a rating to be wrong.
WRONG = 0.1
#: Share of documents assumed to be bad at most, when ratings are set against the corpus.
MOST_BAD = 0.05
#: Share of a learned word's documents that could be bad, at least.
LEAST_POSTERIOR = 0.4

_ZERO = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff]")
_TAG = re.compile(r"</?[A-Za-z][^<>]{0,300}>")
_BREAK = re.compile(r"-\n(?=[a-z])")
_SPACED = re.compile(r"(?<![^\W_])[^\W\d_](?:[ ._\-·][^\W_]|[ ._\-·][@$*]){2,}(?![^\W_])")
_SENTENCE = re.compile(r"(?<=[.!?。！？])\s+|(?<=[。！？])|\n+|(?<=[!?])(?=[A-Z])|(?<=[a-z]\.)(?=[A-Z])")
_RUN = re.compile(r"(.)\1{2,}")
_QUOTED = re.compile("[\"“”„«‹‘'](?=\\S)[^\"“”„«»\n]{1,120}[\"”“»›’']")
_MARKS = frozenset("*@$€0134579")


def fold(word: str) -> str:
    if word.isascii():
        return word.lower()
    word = unicodedata.normalize("NFKD", word.replace("ß", "ss").replace("ẞ", "ss")).casefold()
    return "".join(c for c in word if not unicodedata.combining(c))


class Lexicon:
    """The trie of the terms, and the automaton that accepts what is within one
    edit of any of them.

    A state is a set of (node, edits, letter due): ``letter due`` is what must
    follow where two letters are swapped.  Sets are numbered as they turn up and
    their transitions kept, so that a word costs one look-up per letter."""

    MOST_STATES = 200_000

    def __init__(self, terms: dict[str, str] = TERMS) -> None:
        self.kinds: dict[str, str] = {}
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        for kind, words in terms.items():
            for w in words.split():
                w = fold(w)
                self.kinds.setdefault(w, kind)
                node = 0
                for c in w:
                    if c not in self.children[node]:
                        self.children[node][c] = len(self.children)
                        self.children.append({})
                        self.term.append(None)
                    node = self.children[node][c]
                self.term[node] = w
        self._reset()

    def _reset(self) -> None:
        start = frozenset([(0, 0, "")])
        self.numbers = {start: 0}
        self.sets = [start]
        self.moves: list[dict[str, int]] = [{}]
        self.ends: list[list[tuple[int, str]] | None] = [None]

    def _step(self, state: frozenset, c: str) -> int:
        new = set()
        for node, edits, due in state:
            if due:
                if c == due:
                    new.add((node, 1, ""))
                continue
            kids = self.children[node]
            if c == "*":
                new.update((k, edits, "") for k in kids.values())
            else:
                new.update((kids[x], edits, "") for x in (c, *LEET.get(c, "")) if x in kids)
            if edits:
                continue
            new.add((node, 1, ""))
            for x, k in kids.items():
                new.add((k, 1, ""))
                after = self.children[k].get(c)
                if after is not None:
                    new.add((after, 1, ""))
                    new.add((after, 1, x))
        new = frozenset(new)
        number = self.numbers.get(new)
        if number is None:
            number = self.numbers[new] = len(self.sets)
            self.sets.append(new)
            self.moves.append({})
            self.ends.append(None)
        return number

    def near(self, word: str) -> list[tuple[int, str]]:
        """(edits, term) of the terms within one edit, nearest first; ``*`` stands
        for any letter and the signs of ``LEET`` for theirs, both at no cost."""
        if len(self.sets) > self.MOST_STATES:
            self._reset()
        state = 0
        for c in word:
            after = self.moves[state].get(c)
            if after is None:
                after = self.moves[state][c] = self._step(self.sets[state], c)
            state = after
            if not self.sets[state]:
                return []
        found = self.ends[state]
        if found is None:
            best: dict[str, int] = {}
            for node, edits, due in self.sets[state]:
                if due:
                    continue
                if (t := self.term[node]) is not None:
                    best[t] = min(edits, best.get(t, 9))
                if not edits:
                    for k in self.children[node].values():
                        if (t := self.term[k]) is not None:
                            best.setdefault(t, 1)
            found = self.ends[state] = sorted((e, t) for t, e in best.items())
        return found


@lru_cache(maxsize=1)
def lexicon() -> Lexicon:
    return Lexicon()


_NARROW = re.compile(r"[\w@$*]+")
_WIDE = re.compile("[⺀-힯]")


@lru_cache(maxsize=1)
def _wide_token() -> re.Pattern:
    """Terms of scripts without blanks first, then their single signs, then words."""
    wide = sorted((t for t in lexicon().kinds if ord(t[0]) >= 0x2E80), key=len, reverse=True)
    return re.compile("(?=[⺀-힯])(?:" + "|".join([*wide, "."]) + r")|(?:[^\W⺀-힯]|[@$*])+")


def token(text: str) -> re.Pattern:
    """The pattern of the tokens of a cleaned text."""
    return _NARROW if text.isascii() or not _WIDE.search(text) else _wide_token()


def tokens(text: str) -> list[str]:
    return token(text).findall(text)


#: word, kind or '', masked, misspelt
Look = tuple[str, str, bool, bool]


@lru_cache(maxsize=1 << 18)
def look(raw: str) -> Look:
    """The term that a raw token stands for with its kind, whether it was masked,
    and whether it is only a misspelling of it."""
    lex, masked, word = lexicon(), False, raw
    if not raw.isascii() and any(c.isascii() and c.isalpha() for c in raw) and (swapped := raw.translate(HOMOGLYPHS)) != raw:
        word, masked = swapped, True
    word = fold(word)
    kind = lex.kinds.get(word)
    if kind:
        return word, kind, masked, False
    if len(word) > 32 or word.isdigit():
        return ("#" if word.isdigit() else word), "", False, False
    marked = not _MARKS.isdisjoint(word)
    for form in (_RUN.sub(r"\1", word), _RUN.sub(r"\1\1", word)) if _RUN.search(word.replace("*", "")) else (word,):
        plain = len(form) >= 4 and (form != word or marked) and sum(c.isalpha() for c in form) >= 1 and not form.startswith("**")
        for edits, term in lex.near(form):
            kind = lex.kinds[term]
            if plain and edits == 0 and kind in TARGETS and kind not in ("body", "hostile"):
                return term, kind, True, False
            if edits and form == word and not marked and kind in TARGETS:
                if word == term + "s":
                    return term, kind, masked, False
                if kind in SLIPS and len(term) >= 4 and len(word) >= 3 and word.isalpha() and (len(term) > 4 or word[0] == term[0]):
                    if not (word.startswith(term) or term.startswith(word) and len(word) < len(term)) or word[-2:-1] == word[-1:]:
                        return term, kind, masked, True
    return word, "", masked, False


def _join(m: re.Match) -> str:
    """Letters set apart, put together if they then are a term."""
    joined = re.sub(r"[ ._\-·]", "", m.group())
    _, kind, _, slip = look(joined)
    return f" {joined} " if kind in TARGETS and not slip and len(joined) > 3 else m.group()


def clean(text: str) -> str:
    if not text.isascii():
        text = _ZERO.sub("", text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    if "-\n" in text:
        text = _BREAK.sub("", text)
    text = _SPACED.sub(_join, text)
    return text.replace("_", " ") if "_" in text else text


def sentences(text: str) -> Iterator[str]:
    """The sentences of a cleaned text."""
    return (s for s in _SENTENCE.split(text) if s and s.strip())


class Words:
    """What tokens mean, given the forms that are ordinary words and the words
    that ratings have taught; kept per worker."""

    def __init__(self, ordinary: frozenset[str] = frozenset(), learned: frozenset[str] = frozenset()) -> None:
        self.ordinary, self.learned = ordinary, learned
        self.known: dict[str, tuple[str, str, bool, bool, bool]] = {}

    def __call__(self, raw: str) -> tuple[str, str, bool, bool, bool]:
        """(word, kind, masked, whether it makes a window, misspelt)"""
        got = self.known.get(raw)
        if got is None:
            word, kind, masked, slip = look(raw)
            if (fold(raw) if slip else word) in self.ordinary and not masked:
                word, kind, slip = fold(raw), "", False
            if len(self.known) > 1 << 18:
                self.known.clear()
            got = self.known[raw] = word, kind, masked and kind in TARGETS, kind in TARGETS or word in self.learned, slip
        return got


def windows(sentence: str, words: Words, whole: bool = False) -> Iterator[list[str]]:
    """The features of the window round each hit; ``whole`` unites them."""
    spans = list(token(sentence).finditer(sentence))
    made = [words(m.group()) for m in spans]
    hits = [i for i, m in enumerate(made) if m[3]]
    if not hits:
        return
    quoted = [m.span() for m in _QUOTED.finditer(sentence)]
    ranges = [(max(0, i - RADIUS), i + RADIUS + 1, [i]) for i in hits]
    if whole:
        ranges = [(ranges[0][0], ranges[-1][1], hits)]
    for low, high, centres in ranges:
        part = made[low:high]
        kinds = Counter(m[1] for m in part if m[1])
        names = [f"kind:{k}" for k in kinds if k in TARGETS]
        bad = [k for k in kinds if k in TARGETS]
        names += [f"both:{a}+{b}" for a in bad for b in ("person", "people", "meta", "order") if kinds[b]]
        names += [f"both:{a}+{b}" for i, a in enumerate(TARGETS) if kinds[a] for b in TARGETS[i + 1 :] if kinds[b]]
        names += [f"two:{k}" for k in bad if len({w for w, kk, *_ in part if kk == k}) >= 2]
        if sum(kinds[k] for k in ("foul", "insult", "filth")) >= 2:
            names.append("several")
        if any(m[2] for m in part):
            names.append("masked")
        if all(m[4] for m in part if m[1] in STRONG) and any(m[1] in STRONG for m in part):
            names.append("slip")
        if all(any(a <= spans[i].start() and spans[i].end() <= b for a, b in quoted) for i in centres):
            names += ["quoted"] + ["quoted+report"] * bool(kinds["report"] or kinds["meta"])
        if kinds["report"]:
            names.append("report")
        if kinds["meta"] >= 2:
            names.append("two:meta")
        names += [f"w:{w}" for w in {m[0] for m in part if m[0] in words.learned and m[1] not in TARGETS}]
        yield names


#: What the kinds say before any label is seen (fixed values).
PRIOR = {
    "": -3.0, "masked": 2.5, "several": 1.5, "quoted": -0.8, "quoted+report": -1.5, "report": -0.7, "two:meta": -0.8,
    "kind:foul": 2.8, "kind:insult": 1.2, "kind:demean": 1.2, "kind:filth": 0.6, "kind:sex": 0.8, "kind:threat": 0.3,
    "kind:body": 0.1, "kind:hostile": 0.2,
    "both:foul+person": 1.0, "both:insult+person": 1.8, "both:filth+person": 1.5, "both:demean+person": 0.8,
    "both:sex+person": 1.2, "both:threat+person": 0.8, "both:hostile+person": 0.3, "both:body+person": 0.1,
    "kind:violence": 1.9, "both:violence+person": 0.9, "both:violence+people": 1.3, "slip": -1.0, "both:insult+violence": 1.0,
    "both:violence+body": 1.0, "both:violence+hostile": 1.0, "both:filth+violence": 1.0, "both:violence+threat": 0.8,
    "both:demean+violence": 1.0, "both:violence+meta": -2.5, "two:violence": 0.8,
    "both:insult+order": 0.5, "both:demean+order": 0.5, "both:threat+order": 0.4, "both:body+order": 0.5,
    "both:violence+order": 0.6, "both:insult+people": 1.2, "both:demean+people": 1.2, "both:sex+people": 0.8, "both:threat+people": 0.7,
    "both:foul+insult": 1.0, "both:insult+filth": 1.5, "both:insult+demean": 1.5, "both:insult+threat": 1.0,
    "both:insult+hostile": 1.0, "both:demean+threat": 1.0, "both:demean+body": 0.6, "both:threat+body": 1.2,
    "both:threat+hostile": 1.2, "both:body+hostile": 1.0, "both:demean+filth": 1.0, "both:filth+hostile": 1.0,
    "both:sex+body": 0.8, "both:demean+hostile": 0.8,
    "two:insult": 1.0, "two:demean": 1.5, "two:sex": 2.4, "two:threat": 1.0, "two:hostile": 0.6, "two:filth": 0.6,
    "both:foul+meta": -0.8, "both:insult+meta": -2.0, "both:demean+meta": -2.0, "both:filth+meta": -1.5,
    "both:sex+meta": -2.5, "both:threat+meta": -1.5, "both:body+meta": -1.0, "both:hostile+meta": -1.0,
}


def _sigmoid(z: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


class Model:
    def __init__(self, weights: dict[str, float], ordinary: frozenset[str]) -> None:
        self.weights, self.bias = weights, weights[""]
        self.words = Words(ordinary, frozenset(n[2:] for n in weights if n[:2] == "w:"))

    def sentence(self, sentence: str) -> tuple[float, set[str]]:
        """The highest score of its windows, and the kinds of those of 0.5 or more."""
        best, kinds = self.bias, set()
        for names in windows(sentence, self.words):
            z = self.bias + sum(self.weights.get(n, 0.0) for n in names)
            if not any(n[5:] in STRONG or n[:5] == "both:" for n in names) and sum(n[:2] == "w:" for n in names) < LEARNED_ALONE:
                z = min(z, -0.1)  # a word of a weak kind by itself
            best = max(best, z)
            if z >= 0:
                kinds.update(n[5:] for n in names if n[:5] == "kind:")
        return _sigmoid(best), kinds

    def document(self, text: str | None) -> tuple[float, list[str], str | None]:
        if not text or not text.strip():
            return 0.0, [], None
        text = clean(text)
        best, kinds, worst = _sigmoid(self.bias), set(), None
        words = self.words
        if not any(words(raw)[3] for raw in set(tokens(text))):
            return best, [], None
        for s in sentences(text):
            p, k = self.sentence(s)
            if p > best:
                best, worst = p, s
            kinds |= k
        return best, sorted(kinds), worst if best >= 0.5 else None


def taught(rated: list[tuple[str, float, float]], words: Words, held: dict[str, int], documents: int) -> dict[str, float]:
    """The words outside the lexicon that ratings call bad and the corpus does not
    call ordinary, with their prior weights.  ``held`` tells how many of the
    ``documents`` hold each word."""
    bad_texts = max(1, sum(p >= 0.5 for _, p, _ in rated))
    bad, every = Counter(), Counter()
    for text, p, _ in rated:
        for w in {words(m)[0] for m in tokens(clean(text)) if not words(m)[1]}:
            every[w] += 1
            bad[w] += p >= 0.5
    out = {}
    for w, n in bad.items():
        if n >= 3 and n >= (1 - 3 * WRONG) * every[w] and (len(w) > 3 or not w.isascii()):
            expected = n / bad_texts * MOST_BAD * documents
            posterior = min(0.95, (expected + 0.5) / (held.get(w, 0) + 1))
            if posterior >= LEAST_POSTERIOR:
                out[w] = 0.4 + 0.3 * math.log(posterior / (1 - posterior))
    return out


def fit(rated: list[tuple[str, float, float]], ordinary: frozenset[str], learned: dict[str, float], steps: int = 400, strength: float = 0.1) -> dict[str, float]:
    """Logistic weights for (text, share rated as bad, weight), drawn towards the
    prior by ridge regularisation and kept within ``reach`` of it.  A rating is taken to
    be wrong with the chance ``WRONG``, so one that contradicts all others says little.  The features are kept as lists of places, so
    that memory follows the texts and not texts times features."""
    prior = PRIOR | {f"w:{w}": v for w, v in learned.items()}
    words = Words(ordinary, frozenset(learned))
    made = []
    for text, p, much in rated:
        seen = {n for s in sentences(clean(text)) for f in windows(s, words, whole=True) for n in f}
        if seen:
            made.append((seen, p, much))
    texts = Counter(n for seen, _, _ in made for n in seen)
    names = {n: i for i, n in enumerate(sorted(set(prior) | {n for n, c in texts.items() if c >= 3}))}
    start = np.array([prior.get(n, 0.0) for n in names])
    if not made:
        return {n: float(start[i]) for n, i in names.items()}
    rows = np.array([r for r, (seen, _, _) in enumerate(made) for n in (*seen, "") if n in names])
    places = np.array([names[n] for seen, _, _ in made for n in (*seen, "") if n in names])
    y, much = np.array([p for _, p, _ in made]), np.sqrt([m for *_, m in made])
    much /= much.sum()
    pull = strength * np.array([1.0 if n == "" or n[:2] != "w:" else 2.0 for n in names])
    reach = np.array([1.0 if n else 0.7 for n in names])
    w, before, step = start.copy(), start.copy(), 1.0
    for k in range(steps):
        ahead = w + k / (k + 3) * (w - before)
        z = np.bincount(rows, ahead[places], len(made))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        seen_as = WRONG + (1 - 2 * WRONG) * p
        off = much * (1 - 2 * WRONG) * p * (1 - p) * (seen_as - y) / (seen_as * (1 - seen_as))
        slope = np.bincount(places, off[rows], len(names)) + pull / 10 * (ahead - start)
        before, w = w, np.clip(ahead - step * slope, start - reach, start + reach)
    return {n: float(w[i]) for n, i in names.items()}


def labelled(labels: DataFrame, text: str, label: str, most: int) -> list[tuple[str, float, float]]:
    """(text, share of ratings that call it bad, number of ratings)"""
    rating = F.lower(F.trim(F.col(f"`{label}`")))
    rows = labels.where(F.col(f"`{text}`").isNotNull() & rating.isNotNull())
    rows = rows.select(F.trim(F.col(f"`{text}`")).alias("t"), (rating != "clean").cast("int").alias("bad"))
    rows = rows.groupBy("t").agg(F.avg("bad").alias("p"), F.count("*").alias("n")).orderBy(F.xxhash64("t"), "t").limit(most)
    return [(r.t, float(r.p), float(r.n)) for r in rows.collect()]


_COUNTS = pa.schema([("what", pa.string()), ("word", pa.string()), ("term", pa.string()), ("n", pa.int64())])


def _count(batches: Iterator[pa.RecordBatch], sent: Broadcast) -> Iterator[pa.RecordBatch]:
    """In how many texts stand each near form of a term, each term and each rated
    word; and how many texts there are."""
    rated = sent.value
    known: dict[str, tuple] = {}
    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            counts["text", None, None] += 1
            found = set()
            for raw in set(tokens(clean(text))):
                what = known.get(raw, 0)
                if what == 0:
                    word, kind, _, slip = look(raw)
                    what = ("slip", fold(raw), word) if slip else ("term", None, word) if kind in TARGETS else ("word", word, None) if word in rated else None
                    if len(known) > 1 << 18:
                        known.clear()
                    known[raw] = what
                if what:
                    found.add(what)
            counts.update(found)
    if counts:
        rows = [(*what, n) for what, n in counts.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _COUNTS)], schema=_COUNTS)


def corpus_counts(texts: DataFrame, rated: frozenset[str], share: float = 0.2) -> tuple[frozenset[str], dict[str, int], int]:
    """Near forms that are words of their own (at least ``share`` as frequent as the
    term) and terms of more than ``MOST_BAD`` of all documents, the documents that hold each rated word, and the number of documents.
    What comes to the driver is bounded by the strings one edit from a term and by
    the rated words, not by the corpus."""
    sent = texts.sparkSession.sparkContext.broadcast(rated)
    counts = texts.mapInArrow(partial(_count, sent=sent), "what string, word string, term string, n bigint")
    counts = settle(counts.groupBy("what", "word", "term").agg(F.sum("n").alias("n")))
    terms = counts.where("what = 'term'").select("term", F.col("n").alias("m"))
    forms = counts.where("what = 'slip'").join(terms, "term", "left").groupBy("word").agg(F.max("n").alias("n"), F.max(F.coalesce("m", F.lit(0))).alias("m"))
    ordinary = {r.word for r in forms.where((F.col("n") >= 3) & (F.col("n") >= share * F.col("m"))).select("word").collect()}
    held = {r.word: r.n for r in counts.where("what in ('word', 'text')").select("word", "n").collect()}
    number = held.pop(None, 0)
    ordinary |= {r.term for r in terms.where(F.col("m") > max(20, MOST_BAD * number)).collect()}
    return frozenset(ordinary), held, number


def vocabulary_words(path: str) -> list[str]:
    """The whole words among the tokens of a public rank file."""
    with open(path, "rb") as ranks:
        tokens = (base64.b64decode(line.split()[0]) for line in ranks if line.strip())
        return [t[1:].decode("ascii").lower() for t in tokens if t[:1] == b" " and t[1:].isalpha() and t.isascii()]


_SCORES = pa.schema([("doc", pa.int64()), ("source", pa.string()), ("score", pa.float64()), ("kinds", pa.list_(pa.string())), ("worst", pa.string())])
_MODELS: dict[int, Model] = {}


def _score(batches: Iterator[pa.RecordBatch], sent: Broadcast) -> Iterator[pa.RecordBatch]:
    weights, ordinary = sent.value
    key = hash((tuple(sorted(weights.items())), ordinary))
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = Model(weights, ordinary)
    model = _MODELS[key]
    for batch in batches:
        rows = []
        for doc, source, text in zip(*(c.to_pylist() for c in batch.columns)):
            p, kinds, worst = model.document(text)
            rows.append((doc, source, round(p, 6), kinds, worst))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _SCORES)], schema=_SCORES)


def scores(documents: DataFrame, doc_id: str, text: str, source: str, labels: DataFrame, label_text: str, label: str, most_labels: int = 20_000, vocabulary: Iterable[str] = ()) -> DataFrame:
    """One row per document: ``doc``, ``source``, ``score`` (0 to 1), the ``kinds`` of
    terms in windows that score 0.5 or more, and the ``worst`` of the sentences.
    ``vocabulary``: ordinary words that are no misspelling of a term."""
    col = F.col(f"`{text}`").cast("string")
    usual = frozenset(w for w in vocabulary if look(w)[3])
    rated = labelled(labels, label_text, label, most_labels)
    rated_words = frozenset(look(m)[0] for t, _, _ in rated for m in tokens(clean(t)))
    ordinary, held, number = corpus_counts(documents.where(F.col(f"`{text}`").isNotNull()).select(col.alias("text")), rated_words)
    ordinary |= usual
    weights = fit(rated, ordinary, taught(rated, Words(ordinary), held, number))
    sent = documents.sparkSession.sparkContext.broadcast((weights, ordinary))
    thin = documents.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc"), F.col(f"`{source}`").cast("string").alias("source"), col.alias("text"))
    return thin.mapInArrow(partial(_score, sent=sent), "doc bigint, source string, score double, kinds array<string>, worst string")

"""Garbled text from a wrong character encoding (problem 3).

Method: the garbled spellings of all characters are computed ahead of time for
every pair (right encoding, wrong encoding); one Aho-Corasick automaton over all
of them finds the damaged spans, and only those spans are replaced, so correct
text beside them stays as it is.  Of three-byte characters the automaton holds
the spelling of the first two bytes, the third is read off the table of the wrong
encoding, as are the third and fourth of four-byte characters; that keeps it at some
ten thousand patterns instead of some millions.  Text that went through the mistake
more than once is repaired by repeating the pass until nothing is left.

Text of one single-byte alphabet read as another (``Evaluaciуn``, ``l„o``) has
no spelling that is wrong by itself, as every character is a proper one; there
the words that cannot be proper (letters of two scripts, a sign or a capital
inside a word, inverted case) are read again for each pair of alphabets.  Degree and
quotation marks read as letters are known by where they stand.  U+FFFD shows that
bytes were lost.

Defined results for odd input: null and empty values give no row, nor do values
of ASCII only; a value with U+FFFD gives a row with ``lossy`` true; repeated rows
give a row each; an empty table gives an empty result; other columns, whatever
their names, are not read.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Decoders taken by mistake (fixed values).
SINGLE_BYTE = ("cp1252", "latin_1", "cp1251", "mac_roman", "cp437", "cp850", "koi8_r", "cp1250", "iso8859_2", "iso8859_15", "mac_cyrillic", "cp866", "cp1253", "cp1254", "cp1257", "iso8859_5")
DOUBLE_BYTE = ("gbk", "big5", "shift_jis", "euc_kr", "euc_jp")
#: Single-byte alphabets read as another: right, wrong (fixed values).
ALPHABETS = (
    ("cp1251", "cp1252"), ("cp1251", "latin_1"), ("koi8_r", "cp1251"), ("cp1251", "koi8_r"), ("koi8_r", "latin_1"), ("koi8_r", "cp1252"),
    ("cp866", "cp1251"), ("cp866", "cp1252"), ("cp1251", "cp866"), ("iso8859_5", "cp1251"), ("iso8859_5", "latin_1"), ("cp1251", "mac_roman"), ("mac_cyrillic", "cp1251"), ("cp1251", "mac_cyrillic"),
    ("cp1252", "cp850"), ("cp1252", "cp437"), ("cp1252", "mac_roman"), ("cp1252", "cp1251"), ("cp1252", "koi8_r"), ("cp850", "cp1252"), ("cp437", "cp1252"), ("mac_roman", "cp1252"), ("mac_roman", "latin_1"), ("cp1252", "cp866"), ("cp1252", "cp1250"), ("cp1250", "cp1252"),
)
#: Russian letters, the most frequent first (fixed values).
RUSSIAN = "оеаинтсрвлкмдпуяыьгзбчйхжшюцщэфъё"
#: Letters beyond ASCII of Western and Central European words (fixed values).
WESTERN = "àáâãäåæçèéêëìíîïñòóôõöøùúûüýÿßœšžčćđłńśźżąęěřůűőğışÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝŒŠŽČĆŁŚŻ"
#: Signs that a re-read word may hold beside letters (fixed values).
SIGNS = "\xa0°€–—‘’“”…×±™©®²³µ·«»¿¡§ªº-'/().,:;!?"
#: Words of one letter beyond ASCII, and letters used as symbols (fixed values).
ONE_LETTER = "ÀàÁáÉéÈèÊêÓóÒòÔôaаАбБвВжЖиИкКоОсСуУяЯеЕэЭй"

_RANK = {c: i for i, c in enumerate(RUSSIAN)}
_BEYOND = re.compile(r"[^\x00-\x7f]+")
#: What any spelling of the automaton holds: two signs beyond ASCII, or one of a wide script.
_TWO = re.compile(r"[^\x00-\x7f]{2}|[⺀-힯]")
_EDGE = "\"'()[]{}<>.,:;!?*_/\\|=+#%&@$^~`"


@lru_cache(maxsize=1)
def tables() -> dict[str, dict[str, int]]:
    """For each single-byte decoder, the byte that a character comes from.
    Bytes without a character appear as C1 controls."""
    out = {}
    for wrong in SINGLE_BYTE:
        out[wrong] = {}
        for b in range(0x80, 0x100):
            out[wrong][bytes([b]).decode(wrong, "ignore") or chr(b)] = b
    return out


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """The automaton over the spellings of the first two bytes of all UTF-8
    characters; the value is a tuple of (wrong encoding, the two bytes)."""
    spellings: dict[str, list[tuple[str, bytes]]] = {}
    heads = [bytes([a, b]) for a in (*range(0xC2, 0xE0), *range(0xE1, 0xF0)) for b in range(0x80, 0xC0)]
    heads += [bytes([0xE0, b]) for b in range(0xA0, 0xC0)]
    heads += [bytes([0xF0, b]) for b in range(0x90, 0xC0)] + [bytes([a, b]) for a in (0xF1, 0xF2, 0xF3) for b in range(0x80, 0xC0)]
    heads += [bytes([0xF4, b]) for b in range(0x80, 0x90)]
    for wrong, back in tables().items():
        char = {b: c for c, b in back.items()}
        for head in heads:
            spellings.setdefault(char[head[0]] + char[head[1]], []).append((wrong, head))
    for wrong in DOUBLE_BYTE:
        for head in heads:
            try:
                s = head.decode(wrong)
            except UnicodeDecodeError:
                continue
            if len(s) == 1 and _script(s) == "cjk":
                spellings.setdefault(s, []).append((wrong, head))
    found = ahocorasick.Automaton()
    for s, values in spellings.items():
        found.add_word(s, tuple(values))
    found.make_automaton()
    return found


def _script(c: str) -> str:
    o = ord(c)
    if o < 128 or 0xC0 <= o < 0x250:
        return "latin" if c.isalpha() else ""
    if 0x400 <= o < 0x530:
        return "cyrillic"
    if 0x370 <= o < 0x400:
        return "greek"
    return "cjk" if 0x2E80 <= o < 0xD7B0 else ""


def _at(text: str, i: int) -> str:
    return text[i] if 0 <= i < len(text) else " "


def _letter(c: str) -> bool:
    """A letter proper: ordinal signs and spacing accents are signs here."""
    return c.isalpha() and c not in "ªºˆƒ" and unicodedata.category(c) != "Lm"


def _ascii_letter(c: str) -> bool:
    return c.isascii() and c.isalpha()


def _plain(spelling: str, wrong: str, right: str) -> bool:
    """Whether the spelling could also stand in proper text, so that it needs
    support from its surroundings."""
    if wrong in DOUBLE_BYTE:
        return True
    if any(0x80 <= ord(c) < 0xA0 or 0x2500 <= ord(c) < 0x25A0 for c in spelling):
        return False
    kinds = {_script(c) for c in spelling}
    if kinds == {"cyrillic"}:
        return all(c.lower() in _RANK for c in spelling)
    if len(spelling) > 2 or not all(_letter(c) for c in spelling):
        # signs: "Ã©" is wrong by itself, "é»" and "ó¿" are not
        return len(spelling) == 2 and (spelling[0] in "“”‘’»«¿¡…™°²³®–—" or spelling[0].islower()) and not right.isalpha()
    return kinds == {"latin"} and spelling[0].isupper() == spelling[1].isupper() and spelling[1] not in "ŒŠŽŸœšž"


def _spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, wrong encoding, right text) of UTF-8 spans read wrongly."""
    if not _TWO.search(text):
        return []
    # all spellings lie beyond ASCII: the automaton runs over such stretches only
    hits = [(run.start() + end, values) for run in _BEYOND.finditer(text) for end, values in automaton().iter_long(run.group())]
    if not hits:
        return []
    votes = Counter(wrong for _, values in hits for wrong, _ in values)
    order = {w: i for i, w in enumerate((*SINGLE_BYTE, *DOUBLE_BYTE))}
    found: list[tuple[int, int, str, str]] = []
    last = 0
    for end, values in hits:
        for wrong, head in sorted(values, key=lambda v: (-votes[v[0]], order[v[0]])):
            start, stop = end - (0 if wrong in DOUBLE_BYTE else 1), end + 1
            if start < last:
                continue
            if wrong in DOUBLE_BYTE:
                right = head.decode("utf-8") if head[0] < 0xE0 else ""
            elif head[0] < 0xE0:
                right = head.decode("utf-8")
            else:
                back, more = tables()[wrong], 1 if head[0] < 0xF0 else 2
                rest = [_at(text, stop + k) for k in range(more)]
                tail = bytes(back.get(c, 0xBF if c == "�" else 0) for c in rest)
                if not all(0x80 <= b < 0xC0 for b in tail):
                    continue
                stop += more
                right = "�" if "�" in rest else (head + tail).decode("utf-8", "replace")
            if right and unicodedata.category(right) in ("Cn", "Co"):
                continue
            inner = right < "\xa0" and 0x80 <= ord(_at(text, start + 1)) < 0xA0  # a byte of a further pass
            if head[0] < 0xE0 and not (inner or "\xa0" <= right < "ɐ" or "Α" <= right <= "ω" or "Ѐ" <= right < "ѐ" or "ѐ" <= right < "Ѡ" or "ˆ" <= right <= "˝" or "΄" <= right <= "ώ"):
                continue
            found.append((start, stop, wrong, right))
            last = stop
            break
    if not found:
        return []
    number = Counter(w for _, _, w, _ in found)
    sure = {w for s, e, w, r in found if not _plain(text[s:e], w, r)}
    covered = sum(e - s for s, e, w, _ in found if w in DOUBLE_BYTE)
    own_cjk = sum(1 for c in text if "⺀" <= c < "ힰ") - covered if any(w in DOUBLE_BYTE for w in number) else 0
    kept = []
    for i, (s, e, wrong, right) in enumerate(found):
        if _plain(text[s:e], wrong, right):
            before, after = _at(text, s - 1), _at(text, e)
            if wrong in DOUBLE_BYTE:
                if own_cjk > number[wrong]:
                    continue
                if right == "":
                    if text[s] not in _leads() and not (number[wrong] >= 4 and own_cjk * 3 < number[wrong]):
                        continue
                elif not (right in WESTERN and (_ascii_letter(before) or _ascii_letter(after)) or number[wrong] >= 4 and right.isalpha() and own_cjk * 3 < number[wrong]):
                    continue
            elif wrong not in sure:
                linked = (i and found[i - 1][1] == s) or (i + 1 < len(found) and found[i + 1][0] == e)
                if _script(text[s]) == "cyrillic":
                    if not (right in WESTERN and (_ascii_letter(before) or _ascii_letter(after))):
                        continue
                elif not (linked and number[wrong] >= 3):
                    continue
            elif _script(text[s]) == "cyrillic" and not any(0 <= j < len(found) and found[j][2] == wrong and not _plain(text[found[j][0] : found[j][1]], wrong, found[j][3]) for j in range(i - 4, i + 5)):
                continue
        kept.append((s, e, wrong, right))
    return kept


@lru_cache(maxsize=1)
def _leads() -> frozenset[str]:
    """First pairs of punctuation and signs, read as a double-byte encoding:
    rare characters that name the mistake by themselves."""
    out = set()
    for wrong in DOUBLE_BYTE:
        for lead in (b"\xe2\x80", b"\xe2\x82", b"\xe2\x89", b"\xe2\x86", b"\xe2\x84", b"\xef\xbc", b"\xe3\x80", b"\xf0\x9f"):
            s = lead.decode(wrong, "ignore")
            if len(s) == 1 and _script(s) == "cjk":
                out.add(s)
    return frozenset(out)


def _odd(word: str) -> str:
    """Why a word cannot be proper text, or ''."""
    scripts = {_script(c) for c in word if c.isalpha()} - {"", "greek", "cjk"}
    if len(scripts) > 1:
        return "mixed"
    for i, c in enumerate(word):
        if c.isascii():
            continue
        if 0x2500 <= ord(c) < 0x25A0:
            return "box"
        before, after = _at(word, i - 1), _at(word, i + 1)
        if _ascii_letter(before) and _ascii_letter(after):
            if not _letter(c) and unicodedata.category(c) not in ("Mn", "Pd", "Cf", "Zs", "Cc", "Co"):
                if c in "·’‘\xb4…™®²":
                    if not (c == "\xb4" and before in "aeo" and after not in "aeiouh" or c in "…’‘™®" and before.isupper() and after.isupper() and c != "’"):
                        continue
                return "sign"
            if c.isupper() and before.islower() and after.islower():
                return "case"
            if c.islower() and before.isupper() and after.isupper() and c not in "ß":
                return "case"
    high = [c for c in word if 0xC0 <= ord(c) < 0x180 and _letter(c)]
    if len(high) >= 4 and len(high) == sum(c.isalpha() for c in word):
        return "run"
    letters = [c for c in word if c.isalpha()]
    if len(letters) >= 2 and all(_script(c) == "cyrillic" for c in letters):
        if letters[0].islower() and all(c.isupper() for c in letters[1:]):
            return "inverted"
        if len(letters) >= 4 and _cost(letters) > 12:
            return "rare"
    if len(word) == 1 and _script(word) in ("latin", "cyrillic") and _letter(word) and word not in ONE_LETTER and word.lower() not in _RANK:
        return "alone"
    return ""


def _cost(letters: list[str] | str) -> float:
    return sum(_RANK.get(c.lower(), 33) for c in letters) / len(letters)


def _readable(word: str) -> bool:
    """Whether a re-read word looks like one of a Western or Cyrillic language."""
    letters = [c for c in word if _letter(c)]
    if not all(c in SIGNS or _letter(c) or c.isdigit() for c in word):
        return False
    if not letters:
        return True
    high = [c for c in letters if not c.isascii()]
    if any(part[1:] != part[1:].lower() and part != part.upper() for part in re.split(r"[^\w]", word) if part):
        return False
    if all(_script(c) == "latin" for c in letters):
        return all(c in WESTERN for c in high) and (len(high) <= 2 or len(high) * 2 <= len(letters))
    return all(_script(c) == "cyrillic" and c.lower() in _RANK for c in letters)


def _reread(word: str, reason: str) -> tuple[str, str] | None:
    """(pair, right word) of a word of one alphabet read as another."""
    best: tuple[float, str, str] | None = None
    for right, wrong in ALPHABETS:
        try:
            again = word.encode(wrong).decode(right)
        except (UnicodeEncodeError, UnicodeDecodeError):
            continue
        if again == word or not _readable(again):
            continue
        letters = [c for c in again if _letter(c)]
        cyrillic = bool(letters) and _script(letters[0]) == "cyrillic"
        if reason == "run" and not cyrillic:
            continue
        if reason == "alone":
            if again not in "×–—€°±":
                continue
            cost = 0.0
        elif reason in ("inverted", "rare"):
            gain = _cost([c for c in word if c.isalpha()]) - _cost(letters) if cyrillic and letters else 0
            if gain < (0.5 if reason == "inverted" else 4):
                continue
            cost = -gain
        else:
            cost = sum(1 for c in again if not c.isascii()) + 0.5 * sum(1 for c in again if c not in SIGNS and not c.isascii() and c.isupper())
        if best is None or cost < best[0]:
            best = (cost, f"{right}>{wrong}", again)
    return best and best[1:]


@lru_cache(maxsize=1 << 16)
def _verdict(word: str) -> tuple[str, tuple[str, str] | None]:
    reason = _odd(word)
    return reason, _reread(word, reason) if reason else None


def _whole(words: list[str]) -> tuple[str, dict[str, str]] | None:
    """(pair, right words) of the one pair of alphabets that reads most of a value's
    words beyond ASCII.  A value goes through one mistake, so its odd words tell for
    the others too; a proper word beside them is not readable by the pair, as its
    letters then stand for signs or have no byte."""
    best: tuple[float, str, dict[str, str]] | None = None
    for right, wrong in ALPHABETS:
        score, out = 0.0, {}
        for word in words:
            try:
                again = word.encode(wrong).decode(right)
            except (UnicodeEncodeError, UnicodeDecodeError):
                continue
            if again == word:
                continue
            letters = [c for c in again if _letter(c)]
            if sum(map(_letter, word)) < 2 and not _odd(word):
                continue  # a sign by itself says nothing
            inner = any(not c.isascii() and not _letter(c) and c != "’" for c in again.strip("“”„‘’«»—–…°±·")[1:-1])
            if not letters or not _readable(again) or inner:
                score -= 0.7 * bool(letters)
                continue
            if {_script(c) for c in word if _letter(c)} == {"cyrillic"} == {_script(c) for c in letters} and _cost(letters) > _cost([c for c in word if _letter(c)]):
                continue  # a proper word, read as another
            out[word] = again
            cyrillic = _script(letters[0]) == "cyrillic"
            score += 1 + max(0.0, 12 - _cost(letters)) / 12 if cyrillic else 1 - 0.2 * sum(c.isupper() and not c.isascii() for c in letters[1:])
        if out and (best is None or score > best[0]):
            best = (score, f"{right}>{wrong}", out)
    return best and best[1:]


#: A ruled line, of which box characters are a proper part.
_RULE = re.compile(r"([─-▟])\1\1")


def _contexts() -> list[tuple[str, re.Pattern, str, str]]:
    """(sign, where it stands, right text, pair): signs of cp1252 whose misread form
    is a letter or another sign.  A degree stands before C or F, quotation marks
    round a stretch of words."""
    out = []
    for wrong in ("cp850", "cp437", "mac_roman", "cp1251", "koi8_r", "cp866"):
        for right in ("cp1252", "koi8_r"):
            if right == wrong:
                continue
            sign = "°".encode(right).decode(wrong, "ignore")
            if sign and sign != "°":
                out.append((sign, re.compile(rf"(?<=\d ){re.escape(sign)}(?=[CF]\b)|(?<=\d){re.escape(sign)}(?=[CF]\b)"), "°", f"{right}>{wrong}"))
        for a, b in ("‘’", "“”"):
            x, y = a.encode("cp1252").decode(wrong, "ignore"), b.encode("cp1252").decode(wrong, "ignore")
            if x and y and x != a and x.isalpha() and y.isalpha():
                out.append((x, re.compile(rf"(?<!\w){x}(?=[A-Za-z])([^{x}{y}]{{0,120}}?[A-Za-z]){y}(?!\w)"), rf"{a}\1{b}", f"cp1252>{wrong}"))
    return out


_CONTEXTS = _contexts()
_CONTEXT_SIGNS = frozenset("".join(sign for sign, *_ in _CONTEXTS))


#: Number of damaged spans, encoding pairs, whether characters are lost, the text.
Found = tuple[int, set[str], bool, str]


def _as_utf8(text: str) -> Found:
    """UTF-8 read wrongly, put right span by span, as often as it takes."""
    n, pairs, lossy, now = 0, set(), False, text
    while spans := _spans(now):
        out, at = [], 0
        for s, e, wrong, right in spans:
            if s < at:
                continue
            pairs.add(f"utf_8>{wrong}")
            if right == "":
                # half a pair was left over: read the run back as a whole
                while e < len(now) and not now[e].isascii():
                    e += 1
                right = now[s:e].encode(wrong, "ignore").decode("utf-8", "replace")
            lossy |= "�" in right
            out += [now[at:s], right]
            at = e
            n += 1
        now, was = "".join([*out, now[at:]]), now
        if len(now) >= len(was):  # each further pass is of a shorter text
            break
    return n, pairs, lossy, now


def _as_alphabet(now: str) -> Found:
    """One single-byte alphabet read as another: signs known by their place are put
    right first, then words."""
    n, pairs, lossy = 0, set(), False
    for sign, rx, right, pair in () if _CONTEXT_SIGNS.isdisjoint(now) else _CONTEXTS:
        if sign in now:
            now, found = rx.subn(right, now)
            if found:
                pairs.add(pair)
                n += found
    places = []
    for run in _BEYOND.finditer(now):
        if places and run.start() < places[-1][1]:
            continue
        start, stop = now.rfind(" ", 0, run.start()) + 1, now.find(" ", run.end())
        places.append((start, stop if stop >= 0 else len(now)))
    bare = [now[a:b].strip(_EDGE) for a, b in places]
    verdicts = [_verdict(w) for w in bare]
    if not n and not any(reason for reason, _ in verdicts):
        return 0, pairs, False, now
    odd = {w for w, (_, again) in zip(bare, verdicts) if again}
    pair, right_words = (_whole(sorted(set(bare) - {""})) if odd else None) or ("", {})
    if not odd & set(right_words):
        right_words = {}
    out, at = [], 0
    for (start, stop), word, (reason, again) in zip(places, bare, verdicts):
        if word in right_words and reason != "alone":
            again = (pair, right_words[word])
        if again:
            pairs.add(again[0])
            out += [now[at:start], now[start:stop].replace(word, again[1], 1)]
            n += 1
        else:
            out.append(now[at:stop])
            if reason == "box" and not _RULE.search(now[start:stop]):
                n, lossy = n + 1, True
        at = stop
    now = "".join([*out, now[at:]])
    return n, pairs, lossy, now


def _left_over(text: str) -> int:
    """The words that still cannot be proper."""
    return sum(1 for w in text.split(" ") if not w.isascii() and _odd(w.strip(_EDGE))) + text.count("\ufffd")


def examine(text: str) -> tuple[int, list[str], bool, str] | None:
    """(number of damaged spans, encoding pairs, whether characters were lost,
    repaired text) of a garbled text; None for any other."""
    n, pairs, lossy, now = _as_utf8(text)
    more, other, lost, after = _as_alphabet(now)
    if n and (left := _left_over(after)):
        # letters of one alphabet read as another may look like UTF-8 by chance
        alone = _as_alphabet(text)
        if alone[0] and _left_over(alone[3]) < left:
            n, pairs, lossy, now = 0, set(), False, text
            more, other, lost, after = alone
    n, pairs, lossy, now = n + more, pairs | other, lossy | lost, after
    if "�" in text:
        n, lossy = n + text.count("�"), True
    return (n, sorted(pairs), lossy, now) if n else None


_OUT = pa.schema([("id", pa.int64()), ("field", pa.string()), ("n_spans", pa.int32()), ("pairs", pa.list_(pa.string())), ("lossy", pa.bool_()), ("restored", pa.string())])
_SQL_OUT = "id bigint, field string, n_spans int, pairs array<string>, lossy boolean, restored string"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_pylist()
        rows = []
        for k in range(1, batch.num_columns):
            field = batch.schema.names[k]
            for i, text in zip(ids, batch.column(k).to_pylist()):
                if text and not text.isascii() and (found := examine(text)):
                    rows.append((i, field, *found))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*rows), _OUT)], schema=_OUT)


def garbled(df: DataFrame, id_column: str, fields: list[str]) -> DataFrame:
    """One row per damaged value: the id, ``field``, ``n_spans``, the encoding
    ``pairs``, ``lossy`` (characters are gone for good) and ``restored``, the text
    with only the damaged spans replaced.  A single pass without a shuffle."""
    beyond = [F.when(F.col(f"`{f}`").rlike(r"[^\x00-\x7f]"), F.col(f"`{f}`")).alias(f) for f in fields]
    some = F.coalesce(*[F.col(f"`{f}`") for f in fields]).isNotNull()
    thin = df.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), *beyond).where(some)
    return thin.mapInArrow(_scan, _SQL_OUT).withColumnRenamed("id", id_column)

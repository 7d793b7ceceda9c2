"""Sentence boundaries: a linear-chain tagger over the characters of a text, its training, and its Viterbi decoding.

Every character is tagged boundary (a sentence ends with it) or inside. Blank lines, list items and the full stops of
scripts that use them for nothing else fix the tag; inside quotation marks and brackets it is always inside; only at
the remaining candidates (ambiguous marks, spaces of scripts written without marks, gaps in texts that have neither) is
there a choice, so the chain is decoded from candidate to candidate. What a tag adds to the next one is learned. A path
may not cut off a segment without a letter, and a bracket or a quotation
ends its sentence only if that began with it or introduced it, so tags depend on the tag before.

Nobody marked boundaries in the texts, but the end and the beginning of each paragraph are boundaries whatever their
punctuation. Training strips that break and counts which words stand before it and after it. Sentence ends inside
paragraphs must use the same words at the same rate, so a word that stands before a full stop far more often than
paragraph ends let expect is an abbreviation there, and one that follows far more often than paragraphs begin with it
goes on with a sentence. The same holds for the spaces of scripts without any full stop.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import regex

# Marks by their role.
HARD = "。！？｡।॥۔؟።፧፨։។៕။"
SOFT = ".!?…．‼⁇⁈⁉"
OPENERS = dict(zip("([{（【〔《〈「『", ")]}）】〕》〉」』", strict=True))
QUOTES = {"“": "”", "„": "“”", "”": "“”", "«": "»", "»": "«", "‹": "›", "›": "‹", '"': '"', "＂": "＂", "〝": "〞〟"}
GREEK_QUESTION = ";\u037e"
LIST_MARK = r"(?:[-•*]|\d{1,9}[.)])[^\S\r\n]+"

_NEW_LINE = r"(?>\r\n|[\n\r\x0b\x0c\x85\u2028\u2029])"
#: The same for texts whose lines end with line feeds only, which begin with one sign and are found faster.
_FEEDS_ONLY = re.compile("[\r\x0b\x0c\x85\u2028\u2029]")
_FEED_BLANK = re.compile(r"\n[^\S\r\n]*(?:\n[^\S\r\n]*)+")
_FEED_ITEM = re.compile(rf"\n[^\S\r\n]*({LIST_MARK})")
_ANY_LINE = re.compile("[\n\r\x0b\x0c\x85\u2028\u2029]")
_BLANK = regex.compile(rf"(?:{_NEW_LINE}[^\S\r\n]*){{2,}}|\u2029")
_ITEM = regex.compile(rf"{_NEW_LINE}[^\S\r\n]*({LIST_MARK})")
_NUMBER = re.compile(r"\s*(\d{1,9})[.)]")
_ITEM_START = re.compile(rf"\s*{LIST_MARK}")
_CLOSERS = set("".join(OPENERS.values()) + "".join(QUOTES.values()))
_PAIRED = re.compile("[" + re.escape("".join({*OPENERS, *_CLOSERS, *QUOTES})) + "]")
_MARKS = re.compile(rf"[{HARD}{SOFT}{GREEK_QUESTION}|]+")
_SPACELESS = r"\p{Thai}\p{Lao}"
_DOT = r"\.(?![0-9A-Za-z_])|(?<=[\p{Han}\p{Hiragana}\p{Katakana}）」』])\."
_EVENT = regex.compile(rf"(?:{_DOT}|[{HARD}!?…．‼⁇⁈⁉{GREEK_QUESTION}|])[{HARD}{SOFT}{GREEK_QUESTION}|]*|(?<=[{_SPACELESS}ๆฯ])\s+(?=\S)|(?<=\S)\s+(?=[{_SPACELESS}])")
#: The same for blocks without such scripts.
_MARKED = regex.compile(rf"(?:{_DOT}|[{HARD}!?…．‼⁇⁈⁉{GREEK_QUESTION}|])[{HARD}{SOFT}{GREEK_QUESTION}|]*")
#: What tells that a block needs more than the quick search: signs of scripts without case, Greek, sentence marks of
#: other scripts, or marks next to signs that end sentences elsewhere. Signs that are none of these may be among them.
_MANIFOLD = re.compile("[ªºƻǀ-ǃʔ\u0370-\u03ff\u0530-\u1dff\u1f00-\u200f\u2028-\u202f\u203c\u2047-\u2049\u205f-\u209f\u20d0-\u218f\u2c00-\U0001efff\U0001fb00-\U0010ffff]|[.!?…][;|]|[;|][.!?…]")
_MIXED = re.compile(r"[.!?][;|]|[;|][.!?]")
_QUICK = re.compile(r"[.!?…]+(?=\s+(\S+))")
_HAS_SPACELESS = regex.compile(rf"[{_SPACELESS}]")
_EAST = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}　-〿＀-￯％%]")
_EAST_LETTER = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]")
_AFTER_OPENING = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}(\[{（「『“„”«»」』。！？，、；：\"]")
_WORD_AFTER = re.compile(r"[\s(\[{（「『“„«»\"¿¡]*([^\s,;:!?)\]}。，、]*)")
_LETTER = regex.compile(r"\p{L}")
_GREEK = regex.compile(r"\p{Greek}")
_DEVANAGARI = regex.compile(r"\p{Devanagari}")
_UNCASED, _LAST_UNCASED = regex.compile(r"\p{Lo}"), regex.compile(r"(?r)\p{Lo}")
_PROSE_SYMBOL = regex.compile(r"[\p{L}\p{M}\s]")

_OPENING = {*OPENERS, *QUOTES, "¿", "¡"}
INITIAL = "A."
_DIGIT, _DIGITS = re.compile(r"\d"), re.compile(r"[\d.,\s]+")
NGRAM = 4


def blocks(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of each paragraph, and of each list item in it."""
    at = 0
    if not _ANY_LINE.search(text):
        if text:
            yield 0, len(text)
        return
    blank, item = (_BLANK, _ITEM) if _FEEDS_ONLY.search(text) else (_FEED_BLANK, _FEED_ITEM)
    for gap in [*blank.finditer(text), None]:
        end = gap.start() if gap else len(text)
        if end > at:
            part, begin = text[at:end], 0
            listed = bool(_ITEM_START.match(part))
            number = _NUMBER.match(part) if listed else None
            last = int(number[1]) if number else 0
            items = list(item.finditer(part))
            for k, m in enumerate(items):
                # A number with a dot may have got to the beginning of a line by wrapping: it must be part of a list.
                if number := _NUMBER.match(m[1]):
                    following = _NUMBER.match(items[k + 1][1]) if k + 1 < len(items) else None
                    begins = last == 0 and (part[max(0, m.start() - 3) : m.start()].rstrip()[-1:] in (":", "：") or following and int(following[1]) == 2)
                    if int(number[1]) != last + 1 or not (listed or begins):
                        continue
                    last += 1
                listed = True
                yield at + begin, at + m.start()
                begin = m.start(1)
            yield at + begin, end
        at = gap.end() if gap else end


def pairs(block: str) -> list[tuple[int, int]]:
    """Outermost matched quotations and brackets, by the places of their marks; unmatched marks are nothing."""
    stack: list[tuple[str, int]] = []
    found = []
    for m in _PAIRED.finditer(block):
        c, at = m[0], m.start()
        if at and c in "'’" and block[at - 1].isalpha():
            continue
        for k in range(len(stack) - 1, -1, -1):
            if c in stack[k][0]:
                found.append((stack[k][1], at))
                del stack[k:]
                break
        else:
            if (closing := OPENERS.get(c)) or (closing := QUOTES.get(c)) and _may_open(block, c, at):
                stack.append((closing, at))
    found.sort()
    out: list[tuple[int, int]] = []
    for a, b in found:
        if not out or a > out[-1][1]:
            out.append((a, b))
    return out


def _may_open(block: str, c: str, at: int) -> bool:
    """Signs that also close can open only before something, and the one that mostly closes only after nothing."""
    if c in '"＂“”' and (at + 1 == len(block) or block[at + 1].isspace()):
        return False
    return c != "”" or not at or block[at - 1].isspace() or block[at - 1] in OPENERS


class _Remembered(dict):
    """Results of a function of a short text; emptied when full, so its memory is bounded."""

    MOST = 200_000

    def __init__(self, function) -> None:
        super().__init__()
        self.function = function

    def __missing__(self, text: str):
        if len(self) >= self.MOST:
            self.clear()
        self[text] = found = self.function(text)
        return found


def _shape(word: str) -> str:
    """U(pper), l(ower), d(igit), o(ther script) or - (nothing), by the first letter or digit."""
    for c in word:
        if c.isdigit():
            return "d"
        if c.isalpha():
            return "U" if c.isupper() or c.istitle() else "l" if c.islower() else "o"
    return "-"


_SHAPES = _Remembered(_shape)
shape = _SHAPES.__getitem__


def _composed(word: str) -> str:
    return word if word.isascii() else unicodedata.normalize("NFC", word)


def _pooled(word: str) -> str:
    """Numbers by their form."""
    if word[:1].isdigit() or word[:2].lstrip("+-−").isdigit():
        return _DIGIT.sub("0", word) if len(word) < 5 else "0" + _DIGITS.sub("", word)
    return word


def _last_word(token: str) -> str:
    if not token.isalnum():
        token = _AFTER_OPENING.split(token)[-1].lstrip("'’‘")
    return _pooled(_composed(token))


def _first_word(token: str) -> str | None:
    """None where the word lies beyond the token, after opening marks."""
    m = _WORD_AFTER.match(token)
    return None if not m[1] and m.end() == len(token) else _named(m[1])


def _named(word: str) -> str:
    word = _composed(word)
    if len(word) == 2 and word[1] == "." and word[0].isupper():
        return INITIAL
    return _pooled(word.rstrip(".'’"))


_LAST_WORDS, _FIRST_WORDS = _Remembered(_last_word), _Remembered(_first_word)
#: Words are told from so many characters before a mark; tokens after it that are longer aren't remembered.
_NEAR = 40


def word_before(block: str, at: int) -> str:
    near = block[at - _NEAR if at > _NEAR else 0 : at]
    if not near or near[-1].isspace():
        return ""
    return _LAST_WORDS[near.rsplit(None, 1)[-1]]


def word_after(block: str, at: int) -> str:
    near = block[at : at + _NEAR].split(None, 1)
    if near and len(near[0]) < _NEAR and (word := _FIRST_WORDS[near[0]]) is not None:
        return word
    return _named(_WORD_AFTER.match(block, at)[1])


def is_folded(text: str) -> bool:
    """A text in one case only, whose capitals say nothing."""
    return text.islower() or text.isupper()


def is_prose(text: str) -> bool:
    """Not so: objects in JSON, and texts that hardly consist of letters."""
    core = text.strip()
    if core[:1] in "{[" and core[-1:] in "}]" and '":' in core:
        return False
    return len(set(core[:300])) > 30 or len(set(core)) > 30 or len(_PROSE_SYMBOL.findall(core)) >= 0.5 * len(core)


class Candidate(NamedTuple):
    """end: where the sentence would end; after: where the next would begin; kind: hard, . ! … or space; mark: where its
    marks begin; pair: the quotation or bracket that ends right there, its last mark of a sentence inside; token and
    following: the signs before the marks and after them, up to white space, where the quick search found it."""

    end: int
    after: int
    kind: str
    mark: int
    pair: tuple[int, int] | None
    token: str = ""
    following: str = ""


_made = tuple.__new__


def candidates(block: str, first: int = 0) -> list[Candidate]:
    """Where a sentence of the block may end, the block's own end left out."""
    out: list[Candidate] = []
    closed = pairs(block) if _PAIRED.search(block) else []
    n, p = len(block), 0
    for m in (_EVENT if _HAS_SPACELESS.search(block) else _MARKED).finditer(block, first):
        at, end = m.span()
        pair = None
        if closed:
            while p < len(closed) and closed[p][1] < at:
                p += 1
            pair = closed[p] if p < len(closed) and closed[p][0] < at else None
        marks = m[0]
        if marks[0].isspace():
            if pair is None and not (out and out[-1][1] == end):
                out.append(_made(Candidate, (at, end, "space", at, None, "", "")))
            continue
        if pair is not None:
            # Only marks right before the closing mark can end the sentence, together with it.
            inner = pair[1]
            gap = block[end:inner]
            if gap and gap.strip() and gap.strip() not in _CLOSERS:
                continue
            end = inner + 1
            if end < n and (more := _MARKS.match(block, end)):
                continue  # marks after it decide
            if end < n and block[end] in _CLOSERS and closed[p] != pair:
                continue
        if end >= n:
            continue
        spaced = block[end].isspace()
        kind = "." if spaced and marks == "." and block[at - 1 : at].isascii() else _kind(block, at, end, marks)
        if kind is None:
            continue
        after = end
        if spaced:
            after += 1
            while after < n and block[after].isspace():
                after += 1
            if after >= n:
                continue
        elif kind != "hard":
            continue
        out.append(_made(Candidate, (end, after, kind, at, pair, "", "")))
    return out


def is_manifold(block: str) -> bool:
    if block.isascii():
        return (";" in block or "|" in block) and bool(_MIXED.search(block))
    return bool(_MANIFOLD.search(block))


def quick_candidates(block: str, first: int = 0, known: dict | None = None) -> tuple[list[Candidate], list[float | None]]:
    """candidates() of a block in cased letters only; and what is known already of the signs around each, if anything."""
    out, gains, p = [], [], 0
    closed = pairs(block) if _PAIRED.search(block) else ()
    known = {} if known is None else known
    for m in _QUICK.finditer(block, first):
        at, end = m.span()
        if closed:
            while p < len(closed) and closed[p][1] < at:
                p += 1
            if p < len(closed) and closed[p][0] < at:
                continue
        marks, following = m[0], m[1]
        kind = "." if marks == "." else "…" if "…" in marks or ".." in marks else "!"
        near = block[at - _NEAR if at > _NEAR else 0 : at]
        token = near.rsplit(None, 1)[-1] if near and not near[-1].isspace() else ""
        out.append(_made(Candidate, (end, m.start(1), kind, at, None, token, following)))
        gains.append(known.get((kind, token, following)))
    if closed:
        # Marks right before a closing mark end the sentence together with it.
        for pair in closed:
            for c in candidates_of_pair(block, pair, first):
                k = len(out)
                while k and out[k - 1][0] > c[0]:
                    k -= 1
                out.insert(k, c)
                gains.insert(k, None)
    return out, gains


def candidates_of_pair(block: str, pair: tuple[int, int], first: int) -> list[Candidate]:
    """The candidate of the marks right before a closing mark, if there are any."""
    opened, inner = pair
    n, stop = len(block), inner
    while stop > opened + 1 and (block[stop - 1].isspace() or block[stop - 1] in _CLOSERS):
        stop -= 1
    begin = stop
    while begin > opened + 1 and block[begin - 1] in ".!?…":
        begin -= 1
    gap, end = block[stop:inner].strip(), inner + 1
    if begin == stop or begin < first or end >= n or gap and gap not in _CLOSERS or _MARKS.match(block, end) or not block[end].isspace():
        return []
    kind, after = _kind(block, begin, end, block[begin:stop]), end
    while after < n and block[after].isspace():
        after += 1
    return [_made(Candidate, (end, after, kind, begin, pair, "", ""))] if kind is not None and after < n else []


def _kind(block: str, at: int, end: int, marks: str) -> str | None:
    before, after = block[at - 1 : at], block[end : end + 1]
    if any(c in HARD for c in marks):
        return "hard"
    if ";" in marks or "\u037e" in marks or "|" in marks:
        near = block[max(0, at - 30) : at]
        if "\u037e" in marks or marks == ";" and _GREEK.search(near):
            return "hard" if after.isspace() or not after else None
        if marks == "|" and _DEVANAGARI.search(near) and not before.isspace():
            return "hard"
        if not any(c in SOFT for c in marks):
            return None
    if "…" in marks or "..." in marks or ".." in marks:
        return "…"
    if "．" in marks:
        return None if before.isdigit() and after.isdigit() else "hard"
    if "!" in marks or "?" in marks:
        return "hard" if after and _UNCASED.match(after) else "!"
    if before and after and not after.isspace():
        # A western full stop in text without spaces.
        east = _EAST.match(before) and before not in "%％" or before.isdigit() and _EAST_LETTER.match(after)
        if not east and _EAST_LETTER.match(after):
            word = word_before(block, at)
            east = len(word) > 3 and word.islower() or any(x.isdigit() for x in word)
        return "hard" if east and not after.isdigit() and after not in ",;:)]}，、；：" else None
    return "hard" if before and _EAST_LETTER.match(before) else "."


# ---------------------------------------------------------------- training


def _script(word: str) -> str:
    """c(ased), or a name for the block of the last letter without case."""
    if word.isascii():
        return "c"
    m = _LAST_UNCASED.search(word)
    return "c" if not m else "h" if "가" <= m[0] <= "힣" else str(ord(m[0]) >> 7)


def _context(block: str, at: int) -> str:
    """Script of the last few words."""
    near = block[at - 24 if at > 24 else 0 : at]
    return "c" if near.isascii() else _script(near)


def count_text(text: str, counts: Counter) -> None:
    """Adds what a text tells: words before and after candidates inside paragraphs and at paragraphs' ends."""
    if not text or not is_prose(text):
        return
    plain, runs, seen = not is_folded(text), [0] * 6, []
    note = seen.append
    for a, b in blocks(text):
        block = text[a:b].strip()
        if not block:
            continue
        if not (item := bool(_ITEM_START.match(block))):
            if start := word_after(block, 0):
                note((FIRST, start, _script(block[:20]), plain))
            if _HAS_SPACELESS.match(block):
                note(("t", _gram(block, 0)))
        end = len(block)
        if not item and _HAS_SPACELESS.match(block, end - 1):
            note(("T", block[-NGRAM:]))
        while end and block[end - 1] in _CLOSERS:
            end -= 1
        stop = end
        while stop and block[stop - 1] in SOFT:
            stop -= 1
        if stop < end and not item:
            note((LAST, "." if block[stop:end] == "." else "!", word_before(block, stop), _context(block, stop), plain))
        tag = START
        if not is_manifold(block):
            for _, after, kind, _, pair, token, following in quick_candidates(block, _item_end(block) if item else 0)[0]:
                if not pair:
                    if len(following) >= _NEAR or (word := _FIRST_WORDS[following]) is None:
                        following = word = word_after(block, after)
                    likely = _SHAPES[word] in _LIKELY
                    note((QUICK, kind, token, following, plain))
                    runs[2 * tag + likely] += 1
                    tag = END if likely else GOES_ON
            continue
        if (script := _stripped_script(block)) and _MARKS.search(block):
            _count_stripped(block, script, seen)
        for end, after, kind, mark, pair, _, _ in candidates(block, _item_end(block)):
            if kind == "hard" or pair:
                tag = END
                continue
            if kind == "space":
                joined = _joined(block, end, after)
                note(("u", _gram(block, after), joined))
                note(("v", block[max(0, end - NGRAM) : end], joined))
                continue
            following = word_after(block, after)
            note((INSIDE, kind, word_before(block, mark), following, _context(block, mark), plain))
            likely = _SHAPES[following] in _LIKELY
            runs[2 * tag + likely] += 1
            tag = END if likely else GOES_ON
    counts.update(seen)
    if plain:
        for k, n in enumerate(runs):
            if n:
                counts["a", k // 2, bool(k % 2)] += n


#: Tags before a candidate: none yet in the block, a boundary, or inside.
START, END, GOES_ON = 0, 1, 2
#: Shapes of a following word that make a boundary the better guess.
_LIKELY = "Uo"

#: Scripts without spaces between words. Where a text in one of them has no marks either, any two characters may belong
#: to two sentences; what stands before and after marks elsewhere, the marks stripped, tells which.
_STRIPPED = {"Han": r"[\p{Han}\p{Hiragana}\p{Katakana}]", "Khmer": r"\p{Khmer}", "Myanmar": r"\p{Myanmar}"}
_OF_STRIPPED = {name: regex.compile(p) for name, p in _STRIPPED.items()}
_ANY_STRIPPED = regex.compile("|".join(_STRIPPED.values()))
_UNJOINED = regex.compile(r"[^\p{L}\p{M}\p{N}]+")
#: So many characters are looked at on each side of a gap; combining signs are characters, too.
_SIDES = {"Han": 2, "Khmer": 3, "Myanmar": 3}


def _stripped_script(block: str) -> str | None:
    """The script of a block if it begins with one of those."""
    m = _ANY_STRIPPED.search(block, 0, 40)
    return next((name for name, p in _OF_STRIPPED.items() if p.match(m[0])), None) if m else None


def _count_stripped(block: str, script: str, seen: list) -> None:
    """Runs of characters at the ends and the beginnings of what lies between marks, and all of them."""
    side = _SIDES[script]
    for part in _MARKS.split(block):
        part = _UNJOINED.sub("", part)
        if len(part) > 2 * side:
            runs = [("gn", script, part[k : k + side]) for k in range(len(part) - side + 1)]
            seen += runs
            seen += [("g", script, "n")] * len(runs)
            seen += (("g", script, "e"), ("gb", script, part[:side]), ("ge", script, part[-side:]))


#: Candidates inside paragraphs and paragraphs' edges are counted as they are first, and then by what they tell.
INSIDE, QUICK, FIRST, LAST = "*", "**", "^", "$"


def told(counts: Counter) -> Counter:
    """The counts with each candidate and each edge resolved into what its words, shapes and script tell."""
    out = Counter({k: n for k, n in counts.items() if k[0] not in (INSIDE, QUICK, FIRST, LAST)})
    for key, n in counts.items():
        if key[0] == FIRST:
            _, start, script, plain = key
            out["S", start.casefold()] += n
            if plain:
                out["s", start] += n
                out["c", script, shape(start)] += n
            continue
        if key[0] == LAST:
            _, kind, before, context, plain = key
            out["e", kind, context] += n
            if kind == "!":
                out["e", "!"] += n
            else:
                out["E", before.casefold()] += n
                if plain:
                    out["E.", before, context] += n
            continue
        if key[0] == INSIDE:
            _, kind, before, after, context, plain = key
        elif key[0] == QUICK:
            _, kind, token, following, plain = key
            before, context = _LAST_WORDS[token] if token else "", "c"
            after = following if len(following) >= _NEAR else _FIRST_WORDS[following] or ""
        else:
            continue
        out["B", kind] += n
        out["X", after.casefold()] += n
        if kind == ".":
            out["W", before.casefold()] += n
        if plain:
            s = shape(after)
            # What follows a title or an initial says nothing of what follows other words.
            out["x", after] += n * (kind != "." or len(before) > 4 or any(x.isdigit() for x in before))
            out["b", kind, context, s] += n
            if kind == ".":
                out["w", before, s, context] += n
    return out


def _item_end(block: str) -> int:
    m = _ITEM_START.match(block)
    return m.end() if m else 0


#: Probability of a boundary, before any count, by the shape of what follows.
_GUESS = {"U": 0.9, "l": 0.03, "d": 0.3, "o": 0.7, "-": 0.1}
_GRID = (0.004, 0.02, 0.06, 0.15, 0.3, 0.5, 0.7, 0.85, 0.94, 0.98, 0.996)


def _logit(p: float) -> float:
    p = min(max(p, 0.004), 0.996)
    return math.log(p / (1 - p))


def _logit_of(p: float) -> float:
    return math.log(p / (1 - p)) if 0 < p < 1 else math.copysign(_FIXED, p - 0.5)


def _gram(block: str, at: int) -> str:
    """The first characters of what may be a sentence without spaces; one sign for a number."""
    return "0" if block[at].isdigit() else block[at : at + NGRAM]


def _joined(block: str, end: int, after: int) -> bool:
    """A space with the same spaceless script on both sides."""
    return bool(_HAS_SPACELESS.match(block, after) and _HAS_SPACELESS.match(block, end - 1))


_SPACE_PRIOR = {True: 0.8, False: 0.03}


def _joint(after: float, before: float) -> float:
    """What follows can't make an end of a word that hardly ever is one."""
    return min(after, 2.0) + before if before < -3.0 else after + before


#: Keys that count a word inside paragraphs, and those that count it at their edges.
PARTNERS = {"x": "s", "s": "s", "X": "S", "S": "S", "w": "E.", "E.": "E.", "W": "E", "E": "E", "u": "t", "t": "t", "v": "T", "T": "T"}
COUNTED_INSIDE = frozenset("xXwWuv")


class Model:
    """Log-odds of a boundary from the counts of a sample."""

    #: Weight of what is usual against a word's own counts; in scripts without case few words are abbreviations.
    PRIOR, PRIOR_UNCASED = 1.5, 5.0
    #: Counts of what is usual that a rate of transitions or of gaps starts from.
    USUAL = 5.0

    def __init__(self, counts: Counter) -> None:
        #: What it was made of, and can be made of again.
        self.counts = c = told(counts)
        ends = c["e", "!"]
        # Of all sentence ends, one at a paragraph's end stands for so many inside.
        self.ratio = ratio = c["B", "!"] / ends if c["B", "!"] and ends else 3.0
        scripts = sorted({k[1] for k in c if k[0] == "c"} | {"c"})
        starts = {k: {s: c["c", k, s] for s in "Uldo-"} for k in scripts}
        self.share = {(k, s): n / max(sum(d.values()), 1) for k, d in starts.items() for s, n in d.items()}
        # Scripts without case that use western full stops at all.
        used = {k: sum(c["b", ".", k, s] for s in "Uldo-") for k in scripts}
        stops = {k: k != "c" and c["e", ".", k] > 0.02 * used[k] for k in scripts}
        self.base = {}
        for kind in ".!":
            for script in scripts:
                for s, guess in _GUESS.items():
                    expected = ratio * c["e", kind, script] * self.share[script, s]
                    p = (expected + 5 * guess) / (c["b", kind, script, s] + 5)
                    p = min(p, 0.97 if guess > 0.2 else 0.3)
                    # In scripts without case these marks end sentences whatever follows.
                    if kind == "!" and script != "c":
                        p = max(p, 0.97)
                    elif stops[script] and s in "Uod":
                        p = max(p, 0.7)  # a few abbreviations, known by their own counts, don't speak for the rest
                    self.base[kind, script, s] = p
        self.base_gain = {k: _logit(p) for k, p in self.base.items()}
        self.folded_base = min(ratio * sum(c["e", ".", k] for k in scripts) / max(c["B", "."], 1), 0.97)
        self.next = {}
        for k, n in c.items():
            if k[0] == "x":
                p0 = self.base.get((".", _script(k[1]), shape(k[1])), 0.5)
                self.next[k[1]] = self._known(c["s", k[1]], n, p0) - _logit(p0)
        self.next_folded = {k[1]: self._known(c["S", k[1]], n, self.folded_base) - _logit(self.folded_base) for k, n in c.items() if k[0] == "X"}
        self.previous = {}
        for k, n in c.items():
            if k[0] == "w":
                _, word, s, script = k
                p0 = self.base.get((".", script, s), 0.5)
                self.previous[word, s, script] = self._known(c["E.", word, script], n, p0, self.share.get((script, s), 0.02), self.PRIOR if script == "c" else self.PRIOR_UNCASED) - _logit(p0)
        self.previous_folded = {k[1]: self._known(c["E", k[1]], n, self.folded_base) - _logit(self.folded_base) for k, n in c.items() if k[0] == "W"}
        self.space_next, self.space_previous = self._spaces(c, "t", "u"), self._spaces(c, "T", "v")
        #: What the tag before adds to a candidate's log-odds: learned from runs of tags as the next word's shape suggests
        #: them, with some counts of what is usual.
        yes, no = (sum(c["a", tag, x] for tag in (START, END, GOES_ON)) for x in (True, False))
        usual = (yes + 1) / (yes + no + 2)
        self.transition = tuple(
            _logit((c["a", tag, True] + self.USUAL * usual) / (c["a", tag, True] + c["a", tag, False] + self.USUAL)) - _logit(usual) for tag in (START, END, GOES_ON)
        )
        self.most_transition = max(map(abs, self.transition))
        #: Per stripped script the log-odds of any gap, and by the characters before and after it beyond that.
        self.gaps = {}
        for _, script, _ in [k for k in c if k[0] == "g" and k[2] == "e"]:
            rate = c["g", script, "e"] / c["g", script, "n"]
            sides = ({k[2]: _logit_of((c[edge, script, k[2]] + self.USUAL * rate) / (n + self.USUAL)) - _logit_of(rate) for k, n in c.items() if k[0] == "gn" and k[1] == script} for edge in ("ge", "gb"))
            self.gaps[script] = (_logit_of(rate), *sides)
        #: Scores of candidates in cased text by the signs around them; bounded.
        self.known: tuple[dict, dict] = ({}, {})
        self.starts = {k[1] for k, n in c.items() if k[0] == "s" and n >= 5}

    def __getstate__(self) -> dict:
        """What decoding needs; the counts stay behind."""
        return {k: v for k, v in self.__dict__.items() if k != "counts"} | {"known": ({}, {})}

    def _known(self, at_edge: int, inside: int, p0: float, share: float = 1.0, weight: float = PRIOR) -> float:
        """Log-odds of a boundary beside a word seen so often at paragraphs' edges and so often inside: the posterior
        over a grid, edges being Poisson around what each probability lets expect."""
        # An edge stands for every shape of the next word, of which these have a share.
        rate, total, mean, logs = inside / self.ratio / max(share, 1e-3), 0.0, 0.0, []
        for p in _GRID:
            expected = rate * p
            logs.append(at_edge * math.log(expected + 1e-6) - expected + weight * (p0 * math.log(p) + (1 - p0) * math.log(1 - p)))
        best = max(logs)
        for p, v in zip(_GRID, logs, strict=True):
            w = math.exp(v - best)
            total += w
            mean += w * p
        return _logit(mean / total)

    def _spaces(self, c: Counter, edge: str, inside: str) -> dict[tuple[str, bool], float]:
        """Log-odds, beyond those of any such space, by the characters after or before a space of a script without
        full stops, and by whether that script stands on both sides."""
        edges = {k[1]: n for k, n in c.items() if k[0] == edge}
        ratios = sorted((c[inside, g, True] + c[inside, g, False]) / n for g, n in edges.items() if n >= 5)
        ratio = ratios[len(ratios) // 2] if ratios else 3.0
        out = {}
        for k, n in c.items():
            if k[0] == inside:
                p0 = _SPACE_PRIOR[k[2]]
                out[k[1], k[2]] = self._known(edges.get(k[1], 0), n, p0, self.ratio / max(ratio, 0.1)) - _logit(p0)
        return out

    def score(self, block: str, c: Candidate, folded: bool) -> float:
        """Log-odds of a boundary at a candidate that isn't fixed."""
        _, at, mark_kind, mark, *_ = c
        if mark_kind == "space":
            joined = _joined(block, c.end, at)
            if not joined and block[at].isalpha() and word_after(block, at) in self.starts:
                return 2.0
            seen = self.space_next.get((_gram(block, at), joined), 0.0) + self.space_previous.get((block[max(0, c.end - NGRAM) : c.end], joined), 0.0)
            return seen + _logit(_SPACE_PRIOR[joined])
        after = word_after(block, at)
        if not after and block[at] not in _OPENING:
            return -4.0
        stop = mark_kind == "."
        before = word_before(block, mark) if stop else ""
        if folded:
            s = _logit(self.folded_base if stop else 0.9 if mark_kind == "!" else 0.3) + self.next_folded.get(after.casefold(), 0.0)
            s = _joint(s, self.previous_folded.get(before.casefold(), 0.0) if before else 0.0)
        else:
            kind = shape(after)
            s = 0.0 if after == INITIAL and not stop else self.next.get(after, 0.0)
            if mark_kind == "…":
                # Dots that trail off within a sentence.
                s += 1.5 if kind == "U" else -3.0
            else:
                context = _context(block, mark)
                if context != "c" and before and not _UNCASED.search(before) and (kind == "l" or self.previous.get((before, kind, "c"), 0.0) < -2.0):
                    context = "c"  # a western text that has just begun
                if kind == "o" and context == "c" and (mark_kind == "!" or before[-1:].isdigit() or len(before) > 3 and before.islower()):
                    return 2.0  # another script begins after what isn't an abbreviation
                if context != "c":
                    s = min(max(s, -1.5), 1.5)  # without capitals what precedes the mark tells more
                s += self.base_gain.get((mark_kind, context, kind), 0.0)
                if before:
                    seen = self.previous.get((before, kind, context), 0.0)
                    s = s + seen if seen >= -3.0 or s < 2.0 else 2.0 + seen  # as in _joint
                    if kind == "o" and before.isascii() and not any(x.isdigit() for x in before) and _EAST_LETTER.match(block, at):
                        s -= 6.0  # such text has no spaces but after a foreign abbreviation
        if len(before) == 1 and before.isalpha() and before.isupper() | folded:
            s -= 8.0  # an initial
        return s


# ---------------------------------------------------------------- decoding

_FIXED = 12.0
_NO_LETTER = -30.0
#: A stretch of so many characters is taken to hold a letter.
_LONG_ENOUGH = 16


def _pair_score(block: str, c: Candidate, begin: int, folded: bool) -> float:
    """A quotation or bracket with the last mark of a sentence inside, in a sentence that begins at `begin`."""
    opened = c.pair[0]
    first = block[c.after]
    if first in ",;:，、；：)]}。！？.!?-–—" or first.islower() and not folded:
        return -_FIXED
    lead = block[begin:opened].strip()
    if block[opened] in OPENERS and block[opened] not in "「『《〈":
        return _FIXED if not lead else -_FIXED
    inner = block[opened + 1 : c.pair[1]]
    if _UNCASED.search(inner) or not lead:
        return -_FIXED  # the words that follow tell who said it
    return _FIXED if lead[-1] in ":：" else -_FIXED


def decode(block: str, model: Model, folded: bool, first: int = 0) -> list[tuple[int, int]]:
    """Start and end of the block's sentences: the best path over its candidates."""
    if is_manifold(block):
        found = candidates(block, first)
        gains = [None if c.pair else _hard(block, c) if c.kind == "hard" else model.score(block, c, folded) for c in found]
    else:
        known = model.known[folded]
        found, gains = quick_candidates(block, first, known)
        if None in gains:
            for k, c in enumerate(found):
                if gains[k] is None and c[4] is None:
                    gains[k] = gain = model.score(block, c, folded)
                    if len(c[6]) < _NEAR and _FIRST_WORDS[c[6]] is not None:
                        if len(known) >= _Remembered.MOST:
                            known.clear()
                        known[c[2], c[5], c[6]] = gain
    if not found and (script := _stripped_script(block)) and script in model.gaps and not _MARKS.search(block):
        found, gains = _gaps(block, first, _SIDES[script], *model.gaps[script])
    if not found:
        return [(0, len(block))]
    if None in gains or not _lettered(block, found, first):
        ends = _best_path(block, found, gains, folded, first, model.transition)
    elif min(map(abs, gains)) > model.most_transition:
        # The tag before can't turn any candidate, so the best path takes every one that gains.
        ends = [k for k, g in enumerate(gains) if g > 0]
    else:
        ends = _chain(gains, model.transition)
    spans, begin = [], 0
    for k in ends:
        spans.append((begin, found[k].end))
        begin = found[k].after
    spans.append((begin, len(block)))
    return spans


def _gaps(block: str, first: int, side: int, usual: float, before: dict[str, float], after: dict[str, float]) -> tuple[list[Candidate], list[float]]:
    """Gaps between characters where a sentence without any mark may end. White space belongs to neither side."""
    found, gains = [], []
    for k in range(first + 2 * side, len(block) - 2 * side):
        if not block[k].isalnum() or block[k - 1].isspace() and block[k - 2].isspace():
            continue  # combining signs and white space begin nothing
        end = k - 1 if block[k - 1].isspace() else k
        gain = usual + before.get(block[end - side : end], -2.0) + after.get(block[k : k + side], -2.0)
        if gain > -_FIXED / 4:
            found.append(_made(Candidate, (end, k, "gap", end, None, "", "")))
            gains.append(gain)
    return found, gains


def _chain(gains: list[float], transition: tuple[float, float, float]) -> list[int]:
    """Viterbi over two tags, boundary and inside, where each tag depends on the one before."""
    start, ended, going = transition
    gain = (gains[0] + start) / 2
    at_end, inside = gain, -gain
    back = []
    for g in gains[1:]:
        a, b = (g + ended) / 2, (g + going) / 2
        back.append((at_end + a >= inside + b, at_end - a >= inside - b))
        at_end, inside = max(at_end + a, inside + b), max(at_end - a, inside - b)
    ends, is_end = [], at_end > inside
    for k in range(len(gains) - 1, -1, -1):
        if is_end:
            ends.append(k)
        if k:
            is_end = back[k - 1][0 if is_end else 1]
    return ends[::-1]


def _lettered(block: str, found: list[Candidate], begin: int) -> bool:
    """Whether there is a letter between any two candidates."""
    for end, after, *_ in found:
        if end - begin < _LONG_ENOUGH and not block[begin].isalpha() and not _LETTER.search(block, begin, end):
            return False
        begin = after
    return True


def _best_path(block: str, found: list[Candidate], gains: list[float | None], folded: bool, first: int, transition: tuple[float, float, float]) -> list[int]:
    """Candidates tagged as boundaries on the path of the greatest log-odds.

    The state is where the current sentence began. Of the states for which nothing that follows depends on that place
    (there is a letter since, and it isn't an opening mark) only the best goes on.
    """
    paths: list[tuple[float, int, int]] = [(0.0, 0, -1)]  # score, begin, place in `back`
    back: list[tuple[int, int]] = []  # candidate, previous place
    last = len(found) - 1
    for k, c in enumerate(found):
        best, kept, plain = None, [], None
        end, following = c[0], found[k + 1][0] if k < last else 0
        for score, begin, place in paths:
            if gains[k] is None:
                gain = _pair_score(block, c, begin, folded)
            else:
                gain = gains[k] + transition[START if not k else END if begin == found[k - 1][1] else GOES_ON]
            begun = begin if begin > first else first
            ended = score + gain / 2
            lettered = block[begun].isalpha()
            if end - begun < _LONG_ENOUGH and not lettered and not _LETTER.search(block, begun, end):
                ended += _NO_LETTER
            if best is None or ended > best[0]:
                best = (ended, place)
            path = (score - gain / 2, begin, place)
            if k < last and (lettered or block[begun] not in _OPENING and (following - begun >= _LONG_ENOUGH or _LETTER.search(block, begun, following))):
                if plain is None or path > plain:
                    plain = path
            else:
                kept.append(path)
        back.append((k, best[1]))
        if plain:
            kept.append(plain)
        kept.append((best[0], c[1], len(back) - 1))
        paths = kept
    place, ends = max(paths)[2], []
    while place >= 0:
        k, place = back[place]
        ends.append(k)
    return ends[::-1]


def _hard(block: str, c: Candidate) -> float:
    return -_FIXED if block[c.after] in ",;:，、；：)]}" else _FIXED


def sentences(text: str, model: Model) -> list[tuple[int, int]]:
    """Start and end of every sentence, in code points, without surrounding white space."""
    if not text or text.isspace():
        return []
    if not is_prose(text):
        return [_trimmed(text, 0, len(text))]
    folded, out = is_folded(text), []
    for a, b in blocks(text):
        a, b = _trimmed(text, a, b)
        if a < b:
            block = text[a:b]
            out += [(a + s, a + e) for s, e in decode(block, model, folded, _item_end(block))]
    return out


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and text[start].isspace():
        start += 1
    while end > start and text[end - 1].isspace():
        end -= 1
    return start, end


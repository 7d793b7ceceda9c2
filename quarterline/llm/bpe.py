"""Byte-pair encoding as a streaming transducer with bounded lookahead, and its inverse.

Text is cut into words by the tokenizer's pattern and each word is merged on its own. Both steps look ahead a bounded
distance: a word ends once a character of another class follows (white space needs one more), and a token is stable
once `lookahead` further bytes of its word are known. Words of any length therefore pass through a window of constant
size, and a text through a buffer of constant size.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import regex

# Fixed value: the pattern that splits text before the merges of the rank files.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_WORDS = regex.compile(WORD_PATTERN)
#: How a word of a class goes on, by its last character.
_RUNS = tuple(regex.compile(p) for p in (r"\p{L}+", r"\p{N}+", r"[^\s\p{L}\p{N}]+"))
_SPACE = regex.compile(r"\s*")
_CONTRACTION = regex.compile(r"'(?:s|t|re|ve|m|ll|d)?\Z")
#: An apostrophe, and what may yet become a contraction with it.
_BEGUN = ("'r", "'v", "'l")

CHUNK = 1 << 16
#: Words of more bytes aren't remembered, and the memory is emptied when it holds so many.
LONGEST_REMEMBERED, MOST_REMEMBERED = 64, 400_000


def parse_ranks(file: bytes) -> dict[bytes, int]:
    """Token bytes to id, from a file of base64 tokens and ranks."""
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in file.splitlines() if line)}


def _merge(data: bytes, ranks: dict[bytes, int], below: int) -> list[bytes]:
    """Tokens of a word: neighbours joined in order of rank, equal ones from the left, while one of a rank under `below`
    is possible. A heap holds the possible joins over linked parts, so a word of n bytes costs n log n."""
    n = len(data)
    if n < 2:
        return [data] if n else []
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get(data[i : i + 2], below)) < below]
    heapify(heap)
    alive = bytearray(b"\1") * n
    while heap:
        rank, i = heappop(heap)
        if not alive[i] or (j := end[i]) == n or ranks.get(data[i : (k := end[j])], below) != rank:
            continue  # one of the two was joined with another part meanwhile
        alive[j], end[i] = 0, k
        if k < n:
            before[k] = i
            if (r := ranks.get(data[i : end[k]], below)) < below:
                heappush(heap, (r, i))
        if (h := before[i]) >= 0 and (r := ranks.get(data[h:k], below)) < below:
            heappush(heap, (r, h))
    out, i = [], 0
    while i < n:
        out.append(data[i : end[i]])
        i = end[i]
    return out


def merge_pairs(ranks: dict[bytes, int]) -> dict[bytes, tuple[bytes, bytes]]:
    """The two parts that each token of several bytes is merged from, lowest rank first."""
    pairs = {}
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        if len(token) > 1 and len(parts := _merge(token, ranks, rank)) == 2:
            pairs[token] = (parts[0], parts[1])
    return pairs


def sufficient_lookahead(pairs: dict[bytes, tuple[bytes, bytes]]) -> int:
    """Bytes beyond a token after which nothing that follows can change it.

    A merge (u, v) is undone from the right only if some part at the right edge of v is taken first, as the left part
    of a merge of a lower rank; that merge in turn may be undone by one of a still lower rank, and so on. The longest
    such chain, each link counted with the length of its right part, bounds how far a change travels.
    """
    reach_from: dict[bytes, int] = {}
    longest = 0
    for u, v in pairs.values():
        edge, undone = v, 0
        while True:
            undone = max(undone, reach_from.get(edge, 0))
            if edge not in pairs:
                break
            edge = pairs[edge][1]
        reach = len(v) + undone
        reach_from[u] = max(reach_from.get(u, 0), reach)
        longest = max(longest, reach)
    return longest + max(map(len, pairs), default=1)


class Transducer:
    """Encoder of one vocabulary. Ids travel as the bytes of 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], lookahead: int) -> None:
        self.ranks, self.lookahead = ranks, lookahead
        self._none = max(ranks.values(), default=0) + 1
        self._words = _Remembered(self)

    def word(self, data: bytes) -> bytes:
        """Ids of one word."""
        state = WordState(self)
        return state.feed(data) + state.finish()

    def _ids(self, parts: list[bytes]) -> bytes:
        return array("i", map(self.ranks.__getitem__, parts)).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a text."""
        return b"".join(self.stream(text[i : i + CHUNK] for i in range(0, len(text), CHUNK)))

    def stream(self, chunks: Iterable[str]) -> Iterator[bytes]:
        """Ids as they become stable, with a buffer of a chunk at most."""
        state = TextState(self)
        for chunk in chunks:
            yield from state.feed(chunk)
        yield from state.finish()


class _Remembered(dict):
    """Ids of words seen before; emptied when full, so its memory is bounded."""

    def __init__(self, encoder: Transducer) -> None:
        super().__init__()
        self.encoder = encoder

    def __missing__(self, word: str) -> bytes:
        data = word.encode()
        ids = self.encoder.word(data)
        if len(data) <= LONGEST_REMEMBERED:
            if len(self) >= MOST_REMEMBERED:
                self.clear()
            self[word] = ids
        return ids


class WordState:
    """A word that arrives in pieces: tokens leave once `lookahead` bytes follow them."""

    def __init__(self, encoder: Transducer) -> None:
        self.encoder, self.rest = encoder, b""

    def feed(self, data: bytes) -> bytes:
        self.rest += data
        return self._leave(len(self.rest) - self.encoder.lookahead)

    def finish(self) -> bytes:
        return self._leave(len(self.rest))

    def _leave(self, stable: int) -> bytes:
        """The ids of the tokens that end within so many bytes. They can be cut off on the left without changing those
        that follow."""
        if stable <= 0:
            return b""
        e, done, at = self.encoder, [], 0
        for part in _merge(self.rest, e.ranks, e._none):
            if at + len(part) > stable:
                break
            done.append(part)
            at += len(part)
        self.rest = self.rest[at:]
        return e._ids(done)


class TextState:
    """A text that arrives in chunks: words leave once the next one has begun, endless ones piece by piece."""

    def __init__(self, encoder: Transducer) -> None:
        self.encoder, self.rest, self.pattern = encoder, "", _WORDS
        self.open: WordState | None = None
        self.run: regex.Pattern | None = None

    def _go_on(self) -> Iterator[bytes]:
        """More of the endless word; ends it where another class begins."""
        if self.run is _SPACE:
            # The last white space before anything else isn't part of the word, so one character waits for the next.
            space = _SPACE.match(self.rest).end()
            ended = space < len(self.rest)
            taken = space - 1
        else:
            head = self.run.match(self.rest)
            taken = head.end() if head else 0
            ended = taken < len(self.rest)
        yield self.open.feed(self.rest[:taken].encode())
        self.rest = self.rest[taken:]
        if ended:
            yield self.open.finish()
            self.open = self.run = None

    def feed(self, chunk: str) -> Iterator[bytes]:
        self.rest += chunk
        if self.open:
            yield from self._go_on()
        if self.open or not self.rest:
            return
        # The words make up the whole text. The last one may go on, and what a single further character may change
        # before it waits, too: white space, or an apostrophe that may begin a contraction.
        words = self.pattern.findall(self.rest)
        wait = 1
        if len(words) > 1 and len(words[-1]) == 1 and (words[-2].isspace() or words[-2] + words[-1] in _BEGUN):
            wait = 2
        whole = len(words) - wait
        self.rest = "".join(words[whole:])
        yield b"".join(map(self.encoder._words.__getitem__, words[:whole]))
        # What is left is one unfinished word, or white space before one.
        if len(self.rest) > CHUNK and not self.rest.isspace():
            last = self.rest[-1]
            run = next((r for r in _RUNS if r.match(last)), None)
            if run and self.pattern.match(self.rest).end() == len(self.rest) and not _CONTRACTION.match(self.rest):
                self.open, self.run = WordState(self.encoder), run
                yield self.open.feed(self.rest.encode())
                self.rest = ""
        elif len(self.rest) > CHUNK:
            self.open, self.run = WordState(self.encoder), _SPACE
            yield self.open.feed(self.rest[:-1].encode())
            self.rest = self.rest[-1]

    def finish(self) -> Iterator[bytes]:
        if self.open:
            # At the end of the text nothing follows the white space held back.
            yield self.open.feed(self.rest.encode())
            yield self.open.finish()
            self.open, self.run, self.rest = None, None, ""
        yield b"".join(map(self.encoder._words.__getitem__, self.pattern.findall(self.rest)))
        self.rest = ""


def decode_stream(ids: Iterable[int], tokens: dict[int, bytes]) -> Iterator[str]:
    """Text of ids as characters become complete: a state machine over bytes that keeps at most three of them.

    Bytes that can't be text become U+FFFD, one for each maximal piece of a character.
    """
    kept, need, low, high = b"", 0, 0x80, 0xBF
    for i in ids:
        out = []
        for b in tokens[i]:
            if need and low <= b <= high:
                kept += bytes((b,))
                need, low, high = need - 1, 0x80, 0xBF
                if not need:
                    out.append(kept.decode())
                    kept = b""
                continue
            if need:
                out.append("�")
                kept, need, low, high = b"", 0, 0x80, 0xBF
            if b < 0x80:
                out.append(chr(b))
            elif 0xC2 <= b <= 0xF4:
                kept, need = bytes((b,)), 1 + (b >= 0xE0) + (b >= 0xF0)
                low = {0xE0: 0xA0, 0xF0: 0x90}.get(b, 0x80)
                high = {0xED: 0x9F, 0xF4: 0x8F}.get(b, 0xBF)
            else:
                out.append("�")
        if out:
            yield "".join(out)
    if need:
        yield "�"

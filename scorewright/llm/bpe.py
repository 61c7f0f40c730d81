"""Byte-level BPE as a streaming transducer with bounded lookahead, and its decoder.

Merges are tried in rank order, so what lies to the right of a token can undo it only through a
merge of lower rank that takes the token's right end away, and that merge only through one of still
lower rank, and so on. Summing the right parts along such chains gives the merge list's sufficient
lookahead: a token that ends at least so many bytes before the end of what was read is final. The
transducer keeps one window of bytes, emits the final tokens and goes on at the last one's end, so its
memory doesn't grow with the piece. Decoding feeds the tokens' bytes to an incremental UTF-8 decoder.
"""

from __future__ import annotations

import codecs
import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain, islice

#: Bytes that a window holds beyond the lookahead.
WINDOW = 512
#: Bytes (about) that one generation of remembered units and pieces may take; two generations are held.
MEMORY_BYTES = 40 << 20
ENTRY_BYTES = 200
TOKENS_PER_CHUNK = 1 << 16

#: The pre-tokenizer's split pattern: contractions, letters, digits, other marks, white space.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Unicode's White_Space characters. No piece goes on from another character into one of them.
WHITE = r"\t-\r \x85\xa0  -     　"
UNIT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
UNIT_CHARS = 4096
#: The ids of a text of so many characters may be held as one list.
LIST_CHARS = 1 << 18


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable Latin-1 bytes stand for
    themselves, the others in order are written from code point 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int | None:
    """Bytes after a token's end that decide whether it is final; None if the list isn't proper
    (a merge before the one that makes one of its parts), as then no bound is known."""
    steals: dict[bytes, int] = {}  # most bytes that a merge tried so far reads when it takes this token as its left part
    inner: dict[bytes, int] = {}  # the same for taking away a token's right end before the token is made
    for left, right in merges:
        if any(len(x) > 1 and x not in inner for x in (left, right)):
            return None
        made = max(steals.get(right, 0), inner.get(right, 0))
        inner[left + right] = max(inner.get(left + right, 0), made)
        steals[left] = max(steals.get(left, 0), len(right) + made)
    return max([0, *steals.values(), *inner.values()])


class Transducer:
    """Merges of one vocabulary; encodes pieces of bytes of any length in constant memory."""

    def __init__(self, ids: dict[bytes, int], merges: list[tuple[bytes, bytes]], window: int = WINDOW):
        self.window, self.lookahead = window, sufficient_lookahead(merges)
        self.shift = max(ids.values()).bit_length()
        self.start = [ids.get(bytes([b])) for b in range(256)]
        self.length = {i: len(t) for t, i in ids.items()}
        #: (left id, right id) packed in one integer -> rank and id of the merged token, packed as well.
        self.rule: dict[int, int] = {}
        for rank, (left, right) in enumerate(merges):
            self.rule.setdefault(ids[left] << self.shift | ids[right], rank << self.shift | ids[left + right])
        self.none = len(merges) << self.shift
        self.mask = (1 << self.shift) - 1
        #: What ``rule`` says of two bytes.
        self.first = [[self.none if None in (a, b) else self.rule.get(a << self.shift | b, self.none) for b in self.start] for a in self.start]

    def merge(self, piece: bytes) -> list[int]:
        """All merges over one window: the lowest rank first, the leftmost of equal ranks first."""
        parts = list(map(self.start.__getitem__, piece))
        find, none, shift, mask = self.rule.get, self.none, self.shift, self.mask
        found = [after[b] for after, b in zip(map(self.first.__getitem__, piece), piece[1:])]
        while found:
            least = min(found)
            if least == none:
                break
            i = found.index(least)
            made = least & mask
            parts[i] = made
            del parts[i + 1], found[i]
            if i:
                found[i - 1] = find(parts[i - 1] << shift | made, none)
            if i < len(found):
                found[i] = find(made << shift | parts[i + 1], none)
        return parts

    def tokens(self, stream: Iterable[bytes]) -> Iterator[int]:
        """Ids of one piece that comes in chunks; a token is emitted once it is final."""
        held = b""
        for chunk in stream:
            for at in range(0, len(chunk), self.window):
                held += chunk[at : at + self.window]
                if self.lookahead is None or len(held) < self.window + self.lookahead:
                    continue
                done = 0
                for token in self.merge(held):
                    if done + self.length[token] + self.lookahead > len(held):
                        break
                    done += self.length[token]
                    yield token
                held = held[done:]
        yield from self.merge(held)

    def piece(self, piece: bytes) -> list[int]:
        """Ids of a piece that is there as a whole."""
        return self.merge(piece) if len(piece) <= self.window else list(self.tokens([piece]))


class ByteBpe:
    """Text to ids and back, for a tokenizer file with byte-level BPE and no normalizer."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        raw = lambda token: bytes(map(letters.__getitem__, token))
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        vocab = {raw(t): i for t, i in model["vocab"].items()}
        self.transducer = Transducer(vocab, [(raw(a), raw(b)) for a, b in pairs])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*model["vocab"].values(), *self.special.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.bytes_of[i] = token
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.decimal = [str(i) for i in range(size)]
        self.pieces = regex.compile(PIECES)
        by_length = sorted(self.special, key=len, reverse=True)
        self.split = re.compile("|".join(map(re.escape, by_length))) if by_length else None
        self.known: dict[str, tuple[int, ...]] = {}
        self.before: dict[str, tuple[int, ...]] = {}
        self.held = 0

    def _unit(self, unit: str) -> Iterable[int]:
        """White space and the characters after it; these never share a piece with their neighbours."""
        if len(unit) > UNIT_CHARS:
            return chain.from_iterable(self._long(unit))
        ids = self.before.get(unit)
        if ids is None:
            pieces = self.pieces.findall(unit)
            if len(pieces) == 1:
                ids = tuple(self.transducer.piece(unit.encode()))
            else:
                ids = tuple(chain.from_iterable(self.known.get(p) or self._piece(p) for p in pieces))
        return self._keep(unit, ids)

    def _piece(self, piece: str) -> tuple[int, ...]:
        """One of a unit's several pieces."""
        ids = self.before.get(piece)
        return self._keep(piece, tuple(self.transducer.piece(piece.encode())) if ids is None else ids)

    def _keep(self, unit: str, ids: tuple[int, ...]) -> tuple[int, ...]:
        if self.held > MEMORY_BYTES:  # the young generation becomes the old one; units seen again come back
            self.before, self.held = dict(self.known), 0
            self.known.clear()
        self.known[unit] = ids
        self.held += ENTRY_BYTES + 2 * len(unit) + 8 * len(ids)
        return ids

    def _long(self, unit: str) -> Iterator[Iterable[int]]:
        for m in self.pieces.finditer(unit):
            a, b = m.span()
            chunks = (unit[i : min(i + UNIT_CHARS, b)].encode() for i in range(a, b, UNIT_CHARS))
            yield self.transducer.tokens(chunks) if b - a > UNIT_CHARS else self._unit(m.group())

    def _plain(self, text: str) -> Iterator[Iterable[int]]:
        if len(text) <= 1 << 20:
            units = UNIT.findall(text)
        else:
            units = (m.group() for m in UNIT.finditer(text))
        get, unit = self.known.get, self._unit
        for u in units:
            yield get(u) or unit(u)

    def encode(self, text: str) -> Iterator[int]:
        """Ids of a whole text, one by one; special tokens in the text are tokens."""
        at = 0
        if self.split:
            for m in self.split.finditer(text):
                yield from chain.from_iterable(self._plain(text[at : m.start()]))
                yield self.special[m.group()]
                at = m.end()
        yield from chain.from_iterable(self._plain(text[at:] if at else text))

    def encode_chunks(self, text: str) -> Iterator[list[int]]:
        """Ids in lists of bounded length."""
        special = self.split and self.split.search(text)
        if not special and len(text) <= LIST_CHARS:  # no more ids than bytes
            whole: list[int] = []
            get, unit, add = self.known.get, self._unit, whole.extend
            for u in UNIT.findall(text):
                add(get(u) or unit(u))
            yield from (whole[i : i + TOKENS_PER_CHUNK] for i in range(0, len(whole), TOKENS_PER_CHUNK))
            return
        ids = self.encode(text) if special else chain.from_iterable(self._plain(text))
        while part := list(islice(ids, TOKENS_PER_CHUNK)):
            yield part

    def decode_chunks(self, parts: Iterable[list[int]]) -> Iterator[str]:
        """Text of ids that come in chunks; bytes of a character may lie in several of them. Bytes
        that aren't UTF-8 become replacement characters."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for part in parts:
            yield machine.decode(b"".join(map(self.bytes_of.__getitem__, part)))
        yield machine.decode(b"", final=True)

    def decode(self, ids: Iterable[int]) -> str:
        return "".join(self.decode_chunks([list(ids)]))


_LOADED: dict[str, ByteBpe] = {}


def byte_bpe(path: str) -> ByteBpe:
    """The process's own coder of a file, kept for later tasks."""
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]

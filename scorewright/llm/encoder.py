"""Whole texts to token ids with the tokenizers library, fast for tokenizers that work word by word."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from itertools import compress
from operator import not_

import numpy as np

#: Bytes (about) that one generation of remembered words may take; two generations are held.
WORD_MEMORY = 96 << 20
#: Longer words are encoded where they stand and not remembered.
LONGEST_WORD = 256
CHUNK_CHARS = 1 << 20
#: About what a remembered word takes besides its characters and ids.
ENTRY_BYTES = 200
#: Words of these characters alone are the same after normalising, but for case.
SIMPLE = re.compile(r"[ -~À-ÖØ-öø-ÿ]*\Z")


class _Words(dict):
    """Word -> ids as bytes, in two generations; a new word gets an empty bytearray, filled later.

    When the young generation is full it becomes the old one, and words seen again move back, so
    common words are never encoded twice however many rare ones pass.
    """

    def __init__(self):
        super().__init__()
        self.old: dict[str, bytearray] = {}
        self.new: list[tuple[str, bytearray]] = []
        self.bytes = 0

    def __missing__(self, word: str) -> bytearray:
        held = self.old.get(word)
        if held is None:
            held = bytearray()
            self.new.append((word, held))
        if len(word) <= LONGEST_WORD:
            self[word] = held
            self.bytes += ENTRY_BYTES + 2 * len(word)
        return held

    def age(self) -> None:
        if self.bytes > WORD_MEMORY:
            self.old = dict(self)
            self.clear()
            self.bytes = 0


class Encoder:
    """Whole texts to id bytes.

    ``by_word``: the tokenizer never joins characters over a space or a line feed and drops both
    (as tokenizers with word ends do), so a text's ids are those of its words in a row, and each
    distinct word is encoded once for each generation that a worker remembers.
    """

    def __init__(self, path: str, by_word: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.by_word, self.words = by_word, _Words()
        self.pieces = _Pieces.of(self.tokenizer, self.dtype) if by_word else None

    def _ids(self, texts: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in coded]

    def _fill(self) -> None:
        new, self.words.new = self.words.new, []
        odd = self.pieces.fill(new) if self.pieces else new
        for (_, held), b in zip(odd, self._ids([w for w, _ in odd])):
            held += b

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        if not self.by_word:
            for text in texts:
                yield self._ids([text or ""])[0]
            return
        held, chars = [], 0
        for text in texts:
            text = text or ""
            if self.pieces and text.isascii():
                low = text.lower()
                text = text if any(m in low for m in self.pieces.low_marks) else low
            held.append(list(map(self.words.__getitem__, text.replace("\n", " ").split(" "))))
            chars += len(text)
            if chars >= CHUNK_CHARS:
                yield from self._flush(held)
                held, chars = [], 0
        yield from self._flush(held)

    def _flush(self, held: list[list[bytearray]]) -> Iterator[bytes]:
        self._fill()
        for parts in held:
            yield b"".join(parts)
        self.words.age()


class _Pieces:
    """Many simple words in one call of the library.

    The words are lower-cased and cut here by the tokenizer's own pattern, and only their distinct
    pieces go through the merges, parted by blanks. The last token of a piece carries the word-end mark, so the
    ids are cut back into words without asking where each came from.
    """

    def __init__(self, tokenizer, pattern: str, dtype: np.dtype):
        import regex
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, WhitespaceSplit

        self.cut = regex.compile(pattern).findall
        self.merger = Tokenizer(tokenizer.model)
        self.merger.pre_tokenizer = WhitespaceSplit()
        byte_level = ByteLevel(add_prefix_space=False, use_regex=False)
        # The library's own form of each character's bytes.
        self.mapped = {c: byte_level.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xC0, 0x100))}
        vocab = tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.marks = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.low_marks = [m.lower() for m in self.marks]
        self.dtype = dtype

    @classmethod
    def of(cls, tokenizer, dtype: np.dtype) -> _Pieces | None:
        """For tokenizers of exactly this make (see the test of equality with the library); else None."""
        made = json.loads(tokenizer.to_str())
        norm, pre, model = made["normalizer"] or {}, made["pre_tokenizer"] or {}, made["model"]
        steps = [n["type"] for n in norm.get("normalizers", [])]
        cuts = pre.get("pretokenizers", [])
        if (
            model["type"] != "BPE" or model["end_of_word_suffix"] != "</w>" or model["dropout"] or model["unk_token"]
            or steps != ["NFC", "Replace", "Lowercase"] or norm["normalizers"][1]["pattern"] != {"Regex": r"\s+"}
            or [c["type"] for c in cuts] != ["Split", "ByteLevel"] or cuts[1]["use_regex"] or cuts[1]["add_prefix_space"]
            or (cuts[0]["behavior"], cuts[0]["invert"]) != ("Removed", True) or "Regex" not in cuts[0]["pattern"]
        ):
            return None
        return cls(tokenizer, cuts[0]["pattern"]["Regex"], dtype)

    def fill(self, new: list[tuple[str, bytearray]]) -> list[tuple[str, bytearray]]:
        """Fills the simple words; returns the others."""
        simple, odd = new, []
        joined = " ".join([w for w, _ in new])
        if not SIMPLE.match(joined) or any(m in joined for m in self.marks):
            plain = [bool(SIMPLE.match(w)) and not any(m in w for m in self.marks) for w, _ in new]
            simple, odd = list(compress(new, plain)), list(compress(new, map(not_, plain)))
            joined = " ".join([w for w, _ in simple])
        pieces: dict[str, int] = {}
        number, order, counts = pieces.setdefault, [], []
        for word in joined.lower().split(" "):
            if word.isalpha():
                order.append(number(word, len(pieces)))
                counts.append(1)
            else:
                cut = (word[:-1], word[-1]) if word[:-1].isalpha() and not word[-1].isalnum() else self.cut(word)
                order += [number(p, len(pieces)) for p in cut]
                counts.append(len(cut))
        if not simple or not order:
            return odd
        text = " ".join(pieces)
        for c in set() if text.isascii() else set(text) & self.mapped.keys():
            text = text.replace(c, self.mapped[c])
        ids = np.array(self.merger.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.dtype)
        raw, size = ids.tobytes(), self.dtype.itemsize
        ends = ((np.flatnonzero(self.ends[ids]) + 1) * size).tolist()
        coded = [raw[a:b] for a, b in zip([0, *ends], ends)]
        if len(coded) != len(pieces):
            raise ValueError("a piece lost its word end")
        at = 0
        for (_, held), n in zip(simple, counts):
            held += coded[order[at]] if n == 1 else b"".join([coded[k] for k in order[at : at + n]])
            at += n
        return odd


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, by_word: bool) -> Encoder:
    """The worker's encoder; it stays for the worker's later tasks."""
    if (path, by_word) not in _ENCODERS:
        _ENCODERS[path, by_word] = Encoder(path, by_word)
    return _ENCODERS[path, by_word]

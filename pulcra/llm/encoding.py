"""Token ids of whole texts by a public tokenizer, with the words' ids remembered.

The tokenizers library splits a text at white space before it merges anything, so the ids of a text
are those of its chunks, and a chunk that was seen before need not be encoded again. ``tests/llm``
holds this against whole texts. Texts that contain a special token's string are encoded whole,
since such a string also ends the white space before it.
"""

from __future__ import annotations

import os
import re
from functools import cache
from struct import pack
from unicodedata import is_normalized

import numpy as np

# Characters that the tokenizers' patterns take as white space.
_WIDE = [0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SPACE = r"\t-\r \x85\xa0" + "".join(map(chr, _WIDE))
# A tokenizer's pattern always parts a letter from the mark behind it. These are surely letters and
# marks, so words are remembered without the marks that end them.
_LETTER, _MARK = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", ".,;:!?|)"
_WORD = rf"[{_LETTER}]+(?![^{_MARK}{SPACE}])"
_END = rf"(?<=[{_LETTER}])[{_MARK}]+(?![^{SPACE}])"
# White space is dropped: chunks are what lies between.
DROPPED = rf"{_WORD}|{_END}|[^{SPACE}]+"
# One blank belongs to the word behind it; other white space stands alone.
LEADING = rf" ?{_WORD}|{_END}| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
BLANK = "\u0120"  # how byte-level vocabularies write a blank
REMEMBERED = 400_000  # chunks, about 200 bytes each


class Encoder:
    """``encode(text)`` gives the ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, chunks: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.chunks = re.compile(chunks).findall
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.lowers = self.tokenizer.normalizer is not None and self.tokenizer.normalizer.normalize_str("A") == "a"
        # What is asked for again moves on to the newer half, so common words are kept.
        self.remembered, self.known, self.earlier = remembered, {}, {}
        # Tokens that end a word, or else that begin with its blank: where words of letters part.
        suffix = self.tokenizer.model.end_of_word_suffix
        self.ends = bool(suffix)
        vocabulary = self.tokenizer.get_vocab()
        self.edge = np.zeros(max(vocabulary.values()) + 1, bool)
        self.edge[[i for t, i in vocabulary.items() if (t.endswith(suffix) if suffix else t[:1] == BLANK)]] = True
        self.word = re.compile(rf"{'' if suffix else ' '}[{_LETTER}]+").fullmatch

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)  # without offsets
        return [pack(f"<{len(ids)}I", *ids) for ids in (x.ids for x in found)]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters alone, encoded as one text and parted by its tokens."""
        ids = np.frombuffer(self._ids([(" " if self.ends else "").join(words)])[0], "<u4")
        at = np.flatnonzero(self.edge[ids])
        bounds = [0, *(at + 1).tolist()] if self.ends else [*at.tolist(), len(ids)]
        if len(bounds) != len(words) + 1 or bounds[0] != 0 or bounds[-1] != len(ids):
            return self._ids(words)
        data = ids.tobytes()
        return [data[4 * a : 4 * b] for a, b in zip(bounds, bounds[1:])]

    def _prepared(self, text: str) -> str | None:
        """The text whose chunks are looked up; nothing if it holds a special token's string."""
        given = text
        if self.lowers:
            # The tokenizer lowers A-Z itself, behind its normal form. If that changes nothing either
            # way, a word and its capitalised form can be remembered as one.
            lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
            if is_normalized("NFC", text) and is_normalized("NFC", lowered):
                text = lowered
        return None if any(s in given or s in text for s in self.special) else text

    def _remember(self, chunks: set[str]) -> None:
        if len(self.known) > self.remembered // 2:
            self.earlier, self.known = self.known, {}
        known, earlier = self.known, self.earlier
        asked = chunks.difference(known)
        missing = [p for p in asked if p not in earlier]
        known.update((p, earlier[p]) for p in asked.difference(missing))
        words = [p for p in missing if self.word(p)]
        others = list(set(missing).difference(words))
        for some, ids in ((words, self._words), (others, self._ids)):
            for at in range(0, len(some), 1000):
                part = some[at : at + 1000]
                known.update(zip(part, ids(part)))

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text. Texts of known chunks are joined at once; the unknown chunks of all
        others are encoded together, before those are joined."""
        out, waiting, asked = [b""] * len(texts), [], set()
        find = self.known.__getitem__
        for at, given in enumerate(texts):
            if not given:
                continue
            text = self._prepared(given)
            if text is None:
                out[at] = self._ids([given])[0]
                continue
            chunks = self.chunks(text)
            try:
                out[at] = b"".join(map(find, chunks))
            except KeyError:
                waiting.append((at, chunks))
                asked.update(chunks)
        if waiting:
            self._remember(asked)
            find = self.known.__getitem__
            for at, chunks in waiting:
                out[at] = b"".join(map(find, chunks))
        return out

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]


@cache
def encoder(path: str, chunks: str) -> Encoder:
    """One per worker process; what it remembers serves its later tasks too."""
    return Encoder(path, chunks)

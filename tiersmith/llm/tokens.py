"""Token ids of texts from a public tokenizer file, with a bounded cache of words.

The tokenizers' word patterns never cross ASCII white space, nor does normalisation, so a text's ids
are those of its pieces between white space. Of a lower-casing tokenizer with such a word pattern,
pieces are further told apart less: A-Z is lowered first, and closing punctuation behind a letter or
digit a-z, 0-9 is a piece of its own. Texts where that could matter (combining marks, which compose
with some lower-case letters only, or a special token's opening) are cut at white space alone.

Pieces are spans of an Arrow buffer: hashed, looked up and compared byte by byte in numpy. Only a
piece that a worker has not met becomes a Python string. A worker keeps the ids of the pieces it has
met; when the cache is full it starts again.
"""

from __future__ import annotations

import operator
import os
from functools import lru_cache
from itertools import chain, compress

import numpy as np

from tiersmith.llm import textbytes as tb

CACHED_PIECES = 1_500_000
CACHED_IDS = 1 << 23
SLOTS = 1 << 22  # open addressing; at most 0.4 of them are taken

LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
CLOSING = np.zeros(256, bool)
CLOSING[list(b".,;:!?*$%&#|")] = True
PLAIN = np.zeros(256, bool)
PLAIN[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = True


class Column:
    """A numpy array that grows at its end."""

    def __init__(self, dtype):
        self.room, self.n = np.empty(1 << 16, dtype), 0

    def add(self, more: np.ndarray) -> None:
        to = self.n + len(more)
        if to > len(self.room):
            wider = np.empty(max(to, 2 * len(self.room)), self.room.dtype)
            wider[: self.n] = self.room[: self.n]
            self.room = wider
        self.room[self.n : to] = more
        self.n = to


def spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All positions of the spans, one span behind the other."""
    until = np.cumsum(size)
    return np.repeat(begin - until + size, size) + np.arange(until[-1] if len(until) else 0)


class WordTokenizer:
    """Ids by ``tokenizers`` for slices of UTF-8 texts (see ``textbytes``)."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        # Whether case and closing punctuation may be dealt with beforehand.
        plain = [("Word", "word"), ("word..", "word .."), ("ab1!?*", "ab1 !?*"), ("x###", "x ###"), ("y$%&|", "y $%&|"), ("Q,;:", "q ,;:")]
        ids = lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        self.foldable = all(ids(a) == ids(b) for a, b in plain)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = None
        if suffix:
            self.ends = np.zeros(self.vocabulary, bool)
            self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        self.clear()

    def clear(self) -> None:
        self.slots = np.zeros(SLOTS, np.int32)  # the piece's number plus one
        self.hashes, self.text_at, self.text_size, self.text = Column(np.uint64), Column(np.int64), Column(np.int32), Column(np.uint8)
        self.ids_at, self.ids_size, self.ids = Column(np.int64), Column(np.int32), Column(np.uint32)

    def pieces(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The bytes to cut, and begin, end and text of every piece."""
        begin, end, text = tb.words(buf, off)
        if not self.foldable or not len(begin):
            return buf, begin, end, text
        low = LOWERED[buf]
        as_is = np.zeros(len(off) - 1, bool)
        odd = np.flatnonzero((buf == 0xCC) | (buf == 0xCD))
        special = np.flatnonzero(buf[:-1] == ord("<"))
        special = special[buf[special + 1] == ord("|")]
        as_is[tb.owners(off, np.concatenate([odd, special]))] = True
        for t in np.flatnonzero(as_is):
            low[off[t] : off[t + 1]] = buf[off[t] : off[t + 1]]
        # Words that end in closing punctuation: the last byte that is none must be a letter or digit.
        shut = np.flatnonzero(CLOSING[low[end - 1]] & ~as_is[text])
        other = np.where(CLOSING[low], -1, np.arange(len(low)))
        last = np.maximum.accumulate(other)[end[shut] - 1] if len(shut) else shut
        good = (last >= begin[shut]) & PLAIN[low[last]]
        shut, last = shut[good], last[good]
        many = np.ones(len(begin), np.int64)
        many[shut] = 2
        at = np.cumsum(many) - many
        from_, to = np.repeat(begin, many), np.repeat(end, many)
        to[at[shut]] = last + 1
        from_[at[shut] + 1] = last + 1
        return low, from_, to, np.repeat(text, many)

    def _one_by_one(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(size.sum())), size

    def _together(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters alone, many in one text; a word-end token closes each of them."""
        flats, sizes = [], []
        parts = [pieces[at : at + 1000] for at in range(0, len(pieces), 1000)]
        found = self.tokenizer.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)
        for part, encoding in zip(parts, found):
            flat = np.array(encoding.ids, np.uint32)
            size = np.diff(np.flatnonzero(self.ends[flat]), prepend=-1)
            if len(size) != len(part):  # lower case may split a letter in two
                flat, size = self._one_by_one(part)
            flats.append(flat)
            sizes.append(size)
        return (np.concatenate(flats), np.concatenate(sizes)) if flats else (np.empty(0, np.uint32), np.empty(0, np.int64))

    def _learn(self, low: np.ndarray, begin: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> None:
        """Notes these pieces; their hashes become known by :meth:`_place`."""
        size = end - begin
        # One white space behind each piece, so that one decoding and one split make all strings.
        spaced = np.full(int((size + 1).sum()), 32, np.uint8)
        to = np.cumsum(size + 1) - size - 1
        own = low[spread(begin, size)]
        spaced[spread(to, size)] = own
        texts = spaced.tobytes().decode().split(" ")[:-1]
        if self.ends is None:
            flat, many = self._one_by_one(texts)
        else:
            letters = list(map(str.isalpha, texts))
            order = np.argsort(~np.array(letters, bool), kind="stable")
            flat, many = self._together(list(compress(texts, letters)))
            rest = self._one_by_one(list(compress(texts, map(operator.not_, letters))))
            flat, many = np.concatenate([flat, rest[0]]), np.concatenate([many, rest[1]])
            begin, size, hashes = begin[order], size[order], hashes[order]
            own = low[spread(begin, size)]
        self.ids_at.add(self.ids.n + np.cumsum(many) - many)
        self.ids_size.add(many)
        self.ids.add(flat)
        self.text_at.add(self.text.n + np.cumsum(size) - size)
        self.text_size.add(size)
        self.text.add(own)
        self.hashes.add(hashes)

    def _place(self, first: int) -> None:
        """Gives pieces from number ``first`` on, whose hashes differ, their slots."""
        new = np.arange(first, self.hashes.n)
        at = (self.hashes.room[first : self.hashes.n] & np.uint64(SLOTS - 1)).astype(np.int64)
        while len(new):
            free = self.slots[at] == 0
            self.slots[at[free]] = new[free] + 1  # of several, one wins
            lost = self.slots[at] != new + 1
            new, at = new[lost], (at[lost] + 1) & (SLOTS - 1)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of the piece with each hash, -1 where there is none."""
        found = np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        at = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        while len(open_):
            number = self.slots[at].astype(np.int64) - 1
            hit = number >= 0
            hit[hit] = self.hashes.room[number[hit]] == hashes[open_[hit]]
            found[open_[hit]] = number[hit]
            on = ~hit & (number >= 0)
            open_, at = open_[on], (at[on] + 1) & (SLOTS - 1)
        return found

    def _numbers(self, low: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of each piece, learning those that are new."""
        hashes, size = tb.span_hashes(low, begin, end), end - begin
        number = self._find(hashes)
        missing = np.flatnonzero(number < 0)
        if len(missing):
            _, of = np.unique(hashes[missing], return_index=True)
            of, first = missing[of], self.hashes.n
            self._learn(low, begin[of], end[of], hashes[of])
            self._place(first)
            number[missing] = self._find(hashes[missing])
        # A piece is the one with its hash only if all bytes agree; any other is learnt for this slice.
        wrong = self.text_size.room[number] != size
        fits = np.flatnonzero(~wrong)
        differs = self.text.room[spread(self.text_at.room[number[fits]], size[fits])] != low[spread(begin[fits], size[fits])]
        if differs.any():
            wrong[np.repeat(fits, size[fits])[differs]] = True
        for i in np.flatnonzero(wrong):
            number[i] = self.hashes.n
            self._learn(low, begin[i : i + 1], end[i : i + 1], hashes[i : i + 1])
        return number

    def encode(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids behind each other and where each text's begin (one entry more than texts)."""
        low, begin, end, text = self.pieces(buf, off)
        if not len(begin):
            return np.empty(0, np.uint32), np.zeros(len(off), np.int64)
        if self.hashes.n > CACHED_PIECES or self.ids.n > CACHED_IDS:
            self.clear()
        number = self._numbers(low, begin, end)
        size = self.ids_size.room[number].astype(np.int64)
        ids = self.ids.room[spread(self.ids_at.room[number], size)]
        per_text = np.bincount(text, weights=size, minlength=len(off) - 1).astype(np.int64)
        return ids, np.concatenate([[0], np.cumsum(per_text)])


@lru_cache(maxsize=2)
def tokenizer(definition: str) -> WordTokenizer:
    """One tokenizer per worker process."""
    return WordTokenizer(definition)

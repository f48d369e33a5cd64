"""A tokenizer file's ids for many texts, with each distinct word encoded once.

For byte-pair tokenizers that end each word with a mark, drop white space and
split words into letters, single numbers and other signs. Texts in Latin letters below ``REACH`` are cut
into words on flat arrays; what is a letter, a number or white space, and what
lower case is, is asked of the tokenizer itself. Words not seen before go to the
library. All other texts, and those with special tokens, go to it whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from tokenizers import Tokenizer, pre_tokenizers

from boardweave.llm.batches import run_hashes

REACH = 0x250
CACHE = 300_000  # words, about 60 MB
SPACE, LETTER, NUMBER, OTHER = range(4)
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")  # fixed values: what an apostrophe takes along


class WordPieces:
    def __init__(self, path: str, word_end: str = "</w>") -> None:
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.words = Tokenizer.from_file(path)  # the same merges, for words that are cut already
        self.words.normalizer = None
        self.words.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        size = self.library.get_vocab_size()
        self.ends = np.array([(self.library.id_to_token(i) or "").endswith(word_end) for i in range(size)])
        self.kind = np.zeros(REACH, np.uint8)
        self.lower = np.zeros(REACH, np.uint32)
        self.plain = np.ones(REACH, bool)
        pieces = self.library.pre_tokenizer.pre_tokenize_str
        for c in range(REACH):
            low = self.library.normalizer.normalize_str(chr(c))
            self.plain[c] = len(low) == 1 and ord(low) < REACH
            if self.plain[c]:
                self.lower[c] = ord(low)
                twice = len(pieces(low + low))
                self.kind[c] = SPACE if not twice else NUMBER if twice == 2 else LETTER if len(pieces("a" + low)) == 1 else OTHER
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[int, int] = {}
        self.flat, self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each text has."""
        points = [np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in texts]
        quick = [bool(not len(p) or p.max() < REACH and self.plain[p].all()) and not any(s in t for s in self.special)
                 for t, p in zip(texts, points, strict=True)]
        ids, counts = self._latin([p for p, q in zip(points, quick, strict=True) if q])
        if all(quick):
            return ids, counts
        parts, at, fast = [], 0, iter(counts.tolist())
        for text, q in zip(texts, quick, strict=True):
            if q:
                n = next(fast)
                parts.append(ids[at : at + n])
                at += n
            else:
                parts.append(np.array(self.library.encode(text, add_special_tokens=False).ids, np.int64))
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)

    def _latin(self, points: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        if not points:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        gap = np.array([ord(" ")], np.uint32)
        text = self.lower[np.concatenate([x for p in points for x in (p, gap)])]
        reach = np.cumsum([len(p) + 1 for p in points])
        start, end = self._cut(text)
        h = run_hashes(text, start, end)
        codes, seen = pd.factorize(h)
        place = np.empty(len(seen), np.int64)
        place[codes[::-1]] = np.arange(len(codes))[::-1]  # where each distinct word stands first
        slots = np.array([self.slot.get(x, -1) for x in seen.tolist()], np.int64)
        new = np.flatnonzero(slots < 0)
        if len(new):
            if len(self.slot) + len(new) > CACHE and self.slot:
                self._forget()
                new = np.arange(len(seen))
            self._learn(seen[new].tolist(), [text[a:b].tobytes().decode("utf-32-le") for a, b in zip(start[place[new]], end[place[new]], strict=True)])
            slots = np.array([self.slot[x] for x in seen.tolist()], np.int64)
        of = slots[codes]
        size = self.size[of]
        total = np.cumsum(size)
        within = np.arange(int(total[-1]) if len(total) else 0) - np.repeat(total - size, size)
        ids = self.flat[np.repeat(self.begin[of], size) + within]
        upto = np.r_[0, total][np.searchsorted(start, reach)]
        return ids, np.diff(np.r_[0, upto])

    def _cut(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kind = self.kind[text]
        start = kind != SPACE
        start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
        marks = np.flatnonzero(start & (text == ord("'")))
        for ending in ENDINGS:
            at = marks[marks + len(ending) < len(text)]
            for i, letter in enumerate(ending, 1):
                at = at[text[at + i] == ord(letter)]
            start[at + 1] = False
            after = at + len(ending) + 1
            after = after[after < len(text)]
            start[after[kind[after] == LETTER]] = True
        stop = kind != SPACE
        stop[:-1] &= start[1:] | (kind[1:] == SPACE)
        return np.flatnonzero(start), np.flatnonzero(stop) + 1

    def _learn(self, hashes: list[int], words: list[str]) -> None:
        groups = [words[i : i + 500] for i in range(0, len(words), 500)]
        got = self.words.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.int64) for e in got])
        stop = np.flatnonzero(self.ends[ids]) + 1
        if len(stop) != len(words):  # a token amid a word ended with the mark's letters
            one = [np.array(e.ids, np.int64) for e in self.words.encode_batch_fast(words, add_special_tokens=False)]
            ids, stop = np.concatenate(one), np.cumsum([len(x) for x in one])
        first = np.r_[0, stop[:-1]]
        self.slot.update(zip(hashes, range(len(self.begin), len(self.begin) + len(words)), strict=True))
        self.begin = np.r_[self.begin, first + len(self.flat)]
        self.size = np.r_[self.size, stop - first]
        self.flat = np.r_[self.flat, ids]


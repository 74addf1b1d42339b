"""Encoding whole texts with a public tokenizer, each distinct stretch of text only once.

Texts are cut where both tokenizers always start a new token run: before a space
or newline that follows a visible character, after such a newline where a visible
character follows, and before plain punctuation that follows a letter or digit. A
longer run of white space stays with the word after it, since its last character is
split off only there. Cutting so leaves the ids as they are (tests compare with the
whole-text encoding), and most stretches repeat, so the tokenizer sees few.
"""

from __future__ import annotations

import functools
import os

import numpy as np

from shelfsight.llm.arrays import buffers, span_hashes

#: Bytes of remembered stretches (hash, place, count, ids) at which a worker starts anew.
MEMO_BYTES = 24 << 20
#: Stretches handed to the tokenizer at once: its answers hold far more than the ids.
LEARN = 1 << 10
#: Text encoded at once: the arrays of one slice take some thirty times its bytes.
SLICE_BYTES = 1 << 19

_VISIBLE = np.zeros(256, dtype=bool)
_VISIBLE[0x21:0x7F] = True
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[ord(c) for c in ",.!?;:"]] = True
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[0x20, 0x0A]] = True
_LATIN = 0xC3  # lead byte of U+00C0 to U+00FF: letters, but for the signs 0x97 and 0xB7


def stretches(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where each independent stretch starts, with the end of the data at last."""
    if not len(data):
        return np.zeros(1, dtype=np.int64)
    here, before = data[1:], data[:-1]
    latin = np.zeros(len(before), dtype=bool)
    latin[1:] = data[:-2] == _LATIN
    sign = (before == 0x97) | (before == 0xB7)
    cut = _BREAK[here] & (_VISIBLE[before] | latin)
    cut |= _MARK[here] & (_ALNUM[before] | (latin & ~sign))
    marks = np.zeros(len(data) + 1, dtype=bool)
    marks[1:-1] = cut
    marks[offsets] = True
    # A newline that starts a stretch has no white space before it.
    marks[1:-1] |= marks[:-2] & (before == 0x0A) & (_VISIBLE[here] | (here == _LATIN))
    return np.flatnonzero(marks)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    return Encoder(path)


class Encoder:
    """Ids of whole texts; keeps what it has encoded."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Stretches are remembered here, as plain arrays; a second memory would only grow.
        self.tokenizer.model._resize_cache(0)
        self._forget()

    def _forget(self):
        self.known = np.zeros(0, dtype=np.uint64)
        self.begin = np.zeros(0, dtype=np.int64)
        self.count = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def _learn(self, hashes: np.ndarray, texts: list[str]):
        counts, flats = [], [self.ids]
        for low in range(0, len(texts), LEARN):
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts[low : low + LEARN], add_special_tokens=False)]
            counts.append(np.array([len(x) for x in found], dtype=np.int64))
            flats.append(np.fromiter((i for x in found for i in x), dtype=np.uint32, count=int(counts[-1].sum())))
        count = np.concatenate(counts)
        begin = len(self.ids) + np.cumsum(count) - count
        self.ids = np.concatenate(flats)
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known, kind="stable")
        self.known = known[order]
        self.begin = np.concatenate([self.begin, begin])[order]
        self.count = np.concatenate([self.count, count])[order]

    def encode(self, column) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a text column (null is empty), and where each row's ids start and end."""
        data, offsets = buffers(column)
        bounds = stretches(data, offsets)
        starts, ends = bounds[:-1], bounds[1:]
        keys = span_hashes(data, starts, ends)
        distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        if self.known.nbytes + self.begin.nbytes + self.count.nbytes + self.ids.nbytes > MEMO_BYTES:
            self._forget()
        place = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), dtype=bool)
        inside = place < len(self.known)
        new[inside] = self.known[place[inside]] != distinct[inside]
        if new.any():
            raw = memoryview(np.ascontiguousarray(data))
            at = first[new]
            texts = [str(raw[a:b], "utf-8", "replace") for a, b in zip(starts[at].tolist(), ends[at].tolist())]
            self._learn(distinct[new], texts)
            place = np.searchsorted(self.known, distinct)
        count = self.count[place][inverse]
        begin = self.begin[place][inverse]
        done = np.concatenate([[0], np.cumsum(count)])
        flat = self.ids[np.repeat(begin - done[:-1], count) + np.arange(done[-1])]
        return flat, done[np.searchsorted(starts, offsets)]

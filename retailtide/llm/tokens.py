"""Token ids of whole text columns, made by the tokenizers library on each distinct chunk once.

A text is cut only where its tokens cannot cross: at white space for a vocabulary that drops white
space, and before a single space or around a single line break between two other characters for a
byte-level vocabulary, whose words take the space before them; for both also between an ASCII letter and a
punctuation mark after it, but for the apostrophe. So the ids are those of the whole text, while a word
that comes again costs a lookup. The vocabulary that drops white space also drops letter case. What a
worker has learned stays for its next tasks, until one of another operator runs in it; of ``CACHED`` chunks the half used last is kept.
"""

from __future__ import annotations

import os
from itertools import chain, repeat

import numpy as np
import pyarrow as pa

from retailtide.llm.texts import Texts, keeps, ranges, segment_hashes

CACHED = 340_000
#: Bytes of text that are encoded at once.
SLICE_BYTES = 2_000_000

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Marks at which a word ends: not the apostrophe, which begins contractions, and not what special
# tokens are made of.
_MARK = np.zeros(256, bool)
_MARK[list(b"!\"#$%&()*+,-./:;=?@[]^_`{}~")] = True
_LETTER = np.zeros(256, bool)
_LETTER[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True


def vocabulary(name: str) -> str:
    """Where the named public vocabulary file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """``path`` is a tokenizer file; ``spaced`` tells that its words take the space before them."""

    def __init__(self, path: str, spaced: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.spaced = spaced
        self._start()

    def _start(self) -> None:
        self.known: dict[int, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.bounds = np.zeros(1 << 12, np.int64)  # slot n has the ids from bounds[n] to bounds[n + 1]
        self.used = np.zeros(1 << 12, np.int64)
        self.clock = 0

    def _learn(self, hashes: list[int], chunks: list[str]) -> None:
        made = [e.ids for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]
        slot, start = len(self.known), int(self.bounds[len(self.known)])
        ends = start + np.cumsum(np.fromiter(map(len, made), np.int64, len(made)))
        self.ids = _room(self.ids, int(ends[-1]))
        self.bounds = _room(self.bounds, slot + len(made) + 1)
        self.used = _room(self.used, slot + len(made))
        self.ids[start : ends[-1]] = np.fromiter(chain.from_iterable(made), np.uint32, int(ends[-1]) - start)
        self.bounds[slot + 1 : slot + 1 + len(made)] = ends
        self.known.update(zip(hashes, range(slot, slot + len(made))))

    def _forget(self) -> None:
        """Drop the half of the chunks that were used the longest ago."""
        n = len(self.known)
        keep = np.sort(np.argsort(self.used[:n], kind="stable")[n // 2 :])
        first, counts = self.bounds[keep], self.bounds[keep + 1] - self.bounds[keep]
        ids = self.ids[ranges(first, counts)]
        moved = np.full(n, -1, np.int64)
        moved[keep] = np.arange(len(keep))
        places = moved.tolist()
        self.known = {h: places[s] for h, s in self.known.items() if places[s] >= 0}
        self.ids, self.used = ids, self.used[keep]
        self.bounds = np.concatenate([[0], np.cumsum(counts)])

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after another, and how many each text has."""
        t = Texts(column)
        raw = t.data.tobytes()
        if not self.spaced and b"<|" not in raw:  # a special token keeps its case
            raw = raw.lower()
            t.data = np.frombuffer(raw, np.uint8)
        starts, ends, per_text = (_spaced_chunks if self.spaced else _word_chunks)(t)
        distinct, place, inverse = np.unique(
            segment_hashes(t.data, starts, ends), return_index=True, return_inverse=True
        )
        names = distinct.tolist()
        self.clock += 1
        slots = np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(slots < 0)
        slots[new] = len(self.known) + np.arange(len(new))
        for at in range(0, len(new), 10_000):
            part = new[at : at + 10_000]
            bounds = zip(starts[place[part]].tolist(), ends[place[part]].tolist())
            self._learn(distinct[part].tolist(), [raw[a:b].decode() for a, b in bounds])
        self.used[slots] = self.clock
        slot = slots[inverse]
        first, counts = self.bounds[slot], self.bounds[slot + 1] - self.bounds[slot]
        ids = self.ids[ranges(first, counts)]
        total = np.concatenate([[0], np.cumsum(counts)])
        chunk = np.concatenate([[0], np.cumsum(per_text)])
        if len(self.known) > CACHED:
            self._forget()
        return ids, np.diff(total[chunk])


def _room(array: np.ndarray, size: int) -> np.ndarray:
    """The array with at least that many places."""
    if size <= len(array):
        return array
    return np.concatenate([array, np.zeros(max(size, 2 * len(array)) - len(array), array.dtype)])


def _word_ends(t: Texts) -> np.ndarray:
    """Places of marks that follow a letter of the same text."""
    found = np.zeros(len(t.data) + 1, bool)
    if len(t.data):
        found[1:-1] = _LETTER[t.data[:-1]] & _MARK[t.data[1:]]
        found[t.offsets] = False
    return found


def _word_chunks(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parts of the words of each text, and how many each text has."""
    cut = _word_ends(t)
    cut[t.starts] = True
    starts = np.flatnonzero(cut)
    if not len(starts):
        return starts, starts, t.n_words
    ends = np.minimum(t.ends[np.searchsorted(t.ends, starts, side="right")], np.append(starts[1:], len(t.data)))
    return starts, ends, np.diff(np.searchsorted(starts, t.offsets))


def _spaced_chunks(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunks that cover each text, and how many each text has."""
    data, n = t.data, len(t.data)
    # A character that is certainly no white space: ASCII beyond the space, or of two bytes from C3 on.
    solid = (data > 32) & (data < 127)
    lead = (data >= 0xC3) & (data <= 0xDF)
    before, after = solid.copy(), solid | lead
    before[1:] |= lead[:-1]
    begins = np.zeros(n + 1, bool)
    begins[t.offsets] = True
    inner = np.zeros(n, bool)
    if n > 2:
        inner[1:-1] = before[:-2] & after[2:] & ~begins[1 : n - 1] & ~begins[2:n]
    cut = begins | _word_ends(t)
    cut[:-1] |= inner & ((data == 32) | (data == 10))
    cut[1:] |= inner & (data == 10)
    starts = np.flatnonzero(cut[:-1])
    ends = np.append(starts[1:], n) if len(starts) else starts
    return starts, ends, np.diff(np.searchsorted(starts, t.offsets))


_encoders: dict[tuple[str, bool], Encoder] = {}


def _let_go() -> bool:
    had = bool(_encoders)
    _encoders.clear()
    return had


def encoder(path: str, spaced: bool) -> Encoder:
    """The worker's encoder for a vocabulary; it keeps what it has learned."""
    keeps(_let_go)
    if (path, spaced) not in _encoders:
        _encoders[path, spaced] = Encoder(path, spaced)
    return _encoders[path, spaced]

"""Arrow batches of texts cut into words, and a table of words' ids.

A word is a run between ASCII white space. Words are found and hashed for a
whole batch at once, from 8-byte lanes of the text buffer. Used by the tokenising operators (a text's ids are
those of its words, because the word tokenizer drops white space and no rule
of it looks across: NFC composes nothing over a space, lower-casing works on
single code points, and every alternative of its split pattern excludes white
space) and by the shingle and feature hashing ones.
"""

from __future__ import annotations

import ctypes
import secrets
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Words of more bytes are not kept in the table.
LONGEST = 64
#: Bytes of text whose words are worked on at once.
SLICE = 2 << 20
_LOW = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], np.uint64)


def give_back_memory() -> None:
    """Let arrays of 8 MB and more go back to the system as soon as they are freed:
    a Python worker is used for many tasks, and would else stay as large as at
    its largest batch."""
    try:
        ctypes.CDLL(None).mallopt(-3, 8 << 20)  # M_MMAP_THRESHOLD
    except (OSError, AttributeError):  # another C library: it stays as it is
        return
    pa.set_memory_pool(pa.system_memory_pool())


give_back_memory()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """The words of a batch. ``buf`` holds the texts' bytes and 8 bytes more;
    ``first`` has, for each text and one past the last, its first word."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    def strings(self, which: np.ndarray) -> list[str]:
        """The words of the given numbers; none has a line end, so one text of
        lines decodes them all."""
        if not len(which):
            return []
        raw = self.buf.tobytes()
        parts = [raw[a:b] for a, b in zip(self.start[which].tolist(), self.end[which].tolist())]
        return b"\n".join(parts).decode("utf-8", "replace").split("\n")

    def hashes(self, start: np.ndarray | None = None, end: np.ndarray | None = None, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each whole word (or of the given byte ranges). Under a
        seed that is not known, no two words can be made that share one."""
        start = self.start if start is None else start
        end = self.end if end is None else end
        length = end - start
        lanes = np.lib.stride_tricks.as_strided(self.buf[:8].view(np.uint64), (len(self.buf) - 7,), (1,))
        h, size = lanes[start] & _LOW[np.minimum(length, 8)], length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        if seed:
            keys = mix(np.arange(1, 3, dtype=np.uint64) + np.uint64(seed & 2**64 - 1))
            h = mix(mix(h ^ keys[0]) + size ^ keys[1])
        else:
            h = mix(h + size)
        more = np.flatnonzero(length > 8)
        at = start[more] + 8
        while len(more):
            left = end[more] - at
            h[more] = mix(h[more] + (lanes[at] & _LOW[np.minimum(left, 8)]))
            go = left > 8
            more, at = more[go], at[go] + 8
        return h


def cut(texts: pa.Array, lower: bool = False, space: np.ndarray = SPACE) -> Words:
    """The words of a batch of texts without nulls, between bytes that ``space``
    marks; ``lower`` maps A-Z to a-z."""
    texts = texts.cast(pa.large_binary())
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None and off[-1] > off[0] else np.empty(0, np.uint8)
    buf = np.zeros(len(raw) + 8, np.uint8)
    buf[:len(raw)] = raw
    off = off - off[0]
    if lower:
        buf[(buf >= 0x41) & (buf <= 0x5A)] |= 0x20
    word = ~space[buf[:len(raw)]]
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    edge = off[1:-1]
    edge = edge[(edge > 0) & (edge < len(raw))]
    begins[edge] = word[edge]
    ends[edge - 1] = word[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(buf, start, end, np.searchsorted(start, off))


def text_slices(texts: pa.Array, size: int = SLICE) -> list[pa.Array]:
    """A batch of texts in slices of about ``size`` bytes, one text at least."""
    data = texts.cast(pa.large_binary())
    end = np.frombuffer(data.buffers()[1], np.int64)[data.offset:data.offset + len(data) + 1] if len(data) else np.zeros(1, np.int64)
    out, first = [], 0
    while first < len(data):
        stop = max(first + 1, int(np.searchsorted(end, end[first] + size, side="right")) - 1)
        out.append(data.slice(first, stop - first))
        first = stop
    return out


class WordTable:
    """Ids of texts through a table of the words met so far.

    ``encode_new`` gets distinct words as strings and returns all their ids in
    one array and where each word's ids end. The table starts anew beyond
    ``limit`` words. Words of more than 64 bytes are encoded each time, so the
    table's keys are hashes of at most eight lanes, under a seed that the table draws
    itself: no text can be made whose words take the ids of others.
    """

    def __init__(self, encode_new: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
                 limit: int = 1_000_000):
        self.encode_new, self.limit = encode_new, limit
        self.seed = secrets.randbits(64) | 1
        self.clear()

    def clear(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.at, self.count = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint32)

    def add(self, keys: np.ndarray, words: Words, which: np.ndarray) -> None:
        flat, ends = self.encode_new(words.strings(which))
        ends = np.asarray(ends, np.int64)
        at = np.concatenate([[0], ends])[:-1] + len(self.ids)
        self.ids = np.concatenate([self.ids, np.asarray(flat, np.uint32)])
        place = np.searchsorted(self.keys, keys)
        self.at = np.insert(self.at, place, at)
        self.count = np.insert(self.count, place, ends - np.concatenate([[0], ends])[:-1])
        self.keys = np.insert(self.keys, place, keys)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in one array, and for each text and one past the
        last where its ids begin. The work on words goes by slices of the batch."""
        parts = [self.encode_slice(t) for t in text_slices(texts)]
        if len(parts) == 1:
            return parts[0]
        base = np.cumsum([0] + [len(flat) for flat, _ in parts])
        return (np.concatenate([flat for flat, _ in parts] or [np.empty(0, np.uint32)]),
                np.concatenate([ends[:-1] + b for (_, ends), b in zip(parts, base)] + [base[-1:]]))

    def encode_slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words = cut(texts)
        if len(self.keys) > self.limit:
            self.clear()
        at, count = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        long = words.end - words.start > LONGEST
        short = np.flatnonzero(~long)
        key = words.hashes(words.start[short], words.end[short], self.seed)
        order = np.argsort(key)
        ordered = key[order]
        head = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(key) else np.empty(0, np.int64)
        uniq = ordered[head]
        place = np.searchsorted(self.keys, uniq)
        new = place == len(self.keys)
        new[~new] = self.keys[place[~new]] != uniq[~new]
        if new.any():
            self.add(uniq[new], words, short[order[head[new]]])
            place = np.searchsorted(self.keys, uniq)
        group = np.repeat(place, np.diff(np.append(head, len(key))))
        at[short[order]], count[short[order]] = self.at[group], self.count[group]
        ids = self.ids
        long = np.flatnonzero(long)
        if len(long):
            flat, ends = self.encode_new(words.strings(long))
            begin = np.concatenate([[0], ends]).astype(np.int64)
            at[long], count[long] = begin[:-1] + len(ids), np.diff(begin)
            ids = np.concatenate([ids, np.asarray(flat, np.uint32)])
        ends = np.concatenate([[0], np.cumsum(count)])
        flat = ids[np.repeat(at - ends[:-1], count) + np.arange(ends[-1])]
        return flat, ends[words.first]

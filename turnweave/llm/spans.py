"""Words and pre-tokens of many texts at a time, as spans of one byte array, in numpy."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import xxhash

from .common import space_chunks

_PRIME = np.uint64(0x9E3779B97F4A7C15)
#: Longer spans are hashed one by one.
LANE_BYTES = 512
#: Bytes of separators in front of and behind the joined texts, so that eight bytes can be read anywhere.
_PAD = bytes(8)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def span_hashes(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans of a byte array that ends in eight bytes of padding."""
    lanes = np.ndarray((max(0, len(raw) - 7),), "<u8", raw.data, strides=(1,))
    out = size.astype(np.uint64) * _PRIME
    todo = np.flatnonzero((size > 0) & (size <= LANE_BYTES))
    at = 0
    while len(todo):
        left = size[todo] - at
        lane = lanes[start[todo] + at]
        short = left < 8
        lane[short] &= (np.uint64(1) << (left[short].astype(np.uint64) << np.uint64(3))) - np.uint64(1)
        out[todo] = mix((out[todo] ^ lane) * _PRIME)
        at += 8
        todo = todo[left > 8]
    for k in np.flatnonzero(size > LANE_BYTES).tolist():
        out[k] = xxhash.xxh3_64_intdigest(raw[start[k] : start[k] + size[k]].tobytes())
    return out


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words end to end, words of each text): A-Z lower-cased, cut at 0x20 and 0x09 to 0x0D."""
    data = [t.encode() if t else b"" for t in texts]
    raw = _LOWER[np.frombuffer(b"\n" + b"\n".join(data) + b"\n" + _PAD, np.uint8)]
    inside = ~_WHITE[raw[: len(raw) - len(_PAD)]]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, end = edge[::2], edge[1::2]
    ends = np.cumsum(np.fromiter(map(len, data), np.int64, len(data)) + 1) + 1
    return span_hashes(raw, start, end - start), np.diff(np.searchsorted(start, ends), prepend=0)


#: What the byte-level pattern calls letters, digits and white space, for texts of common characters. Fixed values.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
COMMON = re.compile(rf"[\x20-\x7E\t\n\r{_LETTERS}]*")
#: The byte-level pattern that ``pretoken_starts`` cuts by. A fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_BREAK, _LETTER, _DIGIT, _OTHER, _SPACE = range(5)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
_KIND[48:58] = _DIGIT
_KIND[[9, 10, 13, 32]] = _SPACE
_KIND[0] = _BREAK


def pretoken_starts(raw: np.ndarray) -> np.ndarray:
    """Marks where a match of the pattern starts, in texts of common characters with a zero byte around each.

    A run of letters, digits or other characters takes a space in front of it along; white space before that is a
    match without its last character. An apostrophe alone takes the endings s, t, m, d, re, ve and ll along.
    """
    kind = _KIND[raw]
    mark = np.ones(len(raw), bool)
    mark[1:] = kind[1:] != kind[:-1]
    at = np.flatnonzero(mark)  # runs, the first and the last of which are breaks
    what, size = kind[at], np.diff(np.append(at, len(raw)))
    gap = np.flatnonzero((what[:-1] == _SPACE) & (what[1:] != _BREAK))
    after = at[gap + 1]
    mark[after - 1] = True
    spaced = after[raw[after - 1] == 0x20]
    mark[spaced] = False
    lone = np.flatnonzero((what[:-1] == _OTHER) & (size[:-1] == 1) & (raw[at[:-1]] == 0x27) & (what[1:] == _LETTER))
    lone = lone[mark[at[lone]]]
    follow = at[lone + 1]
    one, two = raw[follow], raw[np.minimum(follow + 1, len(raw) - 1)]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = ((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((one == ord("l")) & (two == ord("l")))
    for taken, n in ((short, 1), (long & ~short, 2)):
        mark[follow[taken]] = False
        mark[follow[taken] + n] = True
    return mark


class PieceCache:
    """Ids of known pre-tokens by their hash, end to end; at the bound the less used half is forgotten."""

    def __init__(self, limit: int):
        self.limit = limit
        self._keep(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint32), np.empty(0, np.int64))

    def _keep(self, keys, start, size, ids, uses) -> None:
        self.keys, self.start, self.size, self.ids, self.uses = keys, start, size, ids, uses

    def encode(self, texts: list[str], merge: Callable[[list[bytes]], list[list[int]]]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of texts of common characters end to end, how many each has); ``merge`` encodes unknown pre-tokens."""
        data = [t.encode() for t in texts]
        joined = b"\0" + b"\0".join(data) + b"\0" + _PAD
        raw = np.frombuffer(joined, np.uint8)
        mark = pretoken_starts(raw)
        mark[1 + int(np.sum(np.fromiter(map(len, data), np.int64, len(data)) + 1)) :] = False
        start = np.flatnonzero(mark)
        size = np.diff(np.append(start, len(raw) - len(_PAD)))
        real = raw[start] != 0
        start, size = start[real], size[real]
        found, first, number, uses = np.unique(span_hashes(raw, start, size), return_index=True, return_inverse=True, return_counts=True)
        at = np.searchsorted(self.keys, found)
        new = np.flatnonzero((self.keys[np.minimum(at, len(self.keys) - 1)] != found) if len(self.keys) else np.ones(len(found), bool))
        if len(new):
            ids = merge([joined[a : a + n] for a, n in zip(start[first[new]].tolist(), size[first[new]].tolist(), strict=True)])
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter((i for x in ids for i in x), np.uint32, int(sizes.sum()))
            starts = len(self.ids) + np.cumsum(sizes) - sizes
            into = at[new]
            self._keep(np.insert(self.keys, into, found[new]), np.insert(self.start, into, starts), np.insert(self.size, into, sizes), np.concatenate([self.ids, flat]), np.insert(self.uses, into, 0))
            at = np.searchsorted(self.keys, found)
        self.uses[at] += uses
        ids, sizes = _runs(self.ids, self.start[at][number], self.size[at][number])
        if len(self.keys) > self.limit:
            kept = np.sort(np.argsort(self.uses, kind="stable")[-self.limit // 2 :])
            flat, sizes_kept = _runs(self.ids, self.start[kept], self.size[kept])
            self._keep(self.keys[kept], np.cumsum(sizes_kept) - sizes_kept, sizes_kept, flat, self.uses[kept] // 2)
        bounds = np.cumsum(np.fromiter(map(len, data), np.int64, len(data)) + 1)
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(start, bounds)]
        return ids, np.diff(ends, prepend=0)


def _runs(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    before = np.cumsum(size) - size
    return values[np.repeat(start - before, size) + np.arange(int(size.sum()))], size


def encode_texts(texts: list[str], cache: PieceCache, merge: Callable[[list[bytes]], list[list[int]]], whole: Callable[[list[str]], list[list[int]]], aside: Callable[[str], bool] = lambda t: False) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts end to end, how many each has) by the byte-level pattern.

    A text of other characters is cut at the lone spaces between visible ones, which no match crosses but by starting
    at it; its chunks of other characters, and texts that are to be put ``aside``, go to ``whole``.
    """
    parts: list[str] = []
    odd: list[int] = []
    counts = []
    for t in texts:
        before = len(parts)
        if aside(t):
            odd.append(len(parts))
            parts.append(t)
        elif COMMON.fullmatch(t):
            parts.append(t)
        else:
            for k, chunk in enumerate(space_chunks(t)):
                chunk = " " + chunk if k else chunk
                if not COMMON.fullmatch(chunk):
                    odd.append(len(parts))
                parts.append(chunk)
        counts.append(len(parts) - before)
    if not odd:
        ids, sizes = cache.encode(parts, merge)
    else:
        is_odd = np.zeros(len(parts), bool)
        is_odd[odd] = True
        plain, plain_sizes = cache.encode([p for p, o in zip(parts, is_odd.tolist(), strict=True) if not o], merge)
        other = whole([parts[k] for k in odd])
        sizes = np.zeros(len(parts), np.int64)
        sizes[~is_odd] = plain_sizes
        sizes[is_odd] = list(map(len, other))
        ids = np.empty(int(sizes.sum()), np.uint32)
        place = np.repeat(is_odd, sizes)
        ids[~place] = plain
        ids[place] = [i for x in other for i in x]
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(counts)] if counts else np.empty(0, np.int64)
    return ids, np.diff(ends, prepend=0)

"""Byte-level BPE by a hierarchical-bitmap rank queue.

The symbols of one or many pre-tokens form a doubly linked list. Every adjacent pair that the vocabulary can
merge is put, by its left position, in the bucket of its merge rank; a bitmap of three levels (64 bits a word)
marks the buckets that hold something, and find-first-set on it gives the lowest rank. Positions of a bucket
are taken from left to right; an entry whose pair has changed since it was put there is stale and skipped. A
merge costs constant time whatever the length, so a pre-token of a million bytes is no special case.

Pre-tokens never touch each other, so one queue serves a whole batch of them: the order of merges inside each
is the same as alone, and the entries of a bucket are merged together in numpy. What a worker has encoded
it keeps in a bounded cache of pre-tokens.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spans import PATTERN, PieceCache, encode_texts

#: Pre-tokens in a worker's cache.
CACHE_SIZE = 1_500_000
#: Bytes of pre-tokens that go through one queue at a time.
QUEUE_BYTES = 1 << 20
#: Text characters that are encoded together.
CHUNK_CHARS = 1 << 21


class RankBitmap:
    """Three levels of 64-bit words; ``first`` finds the lowest member by find-first-set."""

    def __init__(self, size: int):
        self.low = [0] * ((size >> 6) + 1)
        self.mid = [0] * ((size >> 12) + 1)
        self.top = 0

    def add(self, r: int) -> None:
        self.low[r >> 6] |= 1 << (r & 63)
        self.mid[r >> 12] |= 1 << (r >> 6 & 63)
        self.top |= 1 << (r >> 12)

    def remove(self, r: int) -> None:
        i = r >> 6
        self.low[i] &= ~(1 << (r & 63))
        if not self.low[i]:
            j = r >> 12
            self.mid[j] &= ~(1 << (i & 63))
            if not self.mid[j]:
                self.top &= ~(1 << j)

    def first(self) -> int:
        """-1 if empty."""
        t = self.top
        if not t:
            return -1
        j = (t & -t).bit_length() - 1
        m = self.mid[j]
        i = j << 6 | (m & -m).bit_length() - 1
        w = self.low[i]
        return i << 6 | (w & -w).bit_length() - 1


class ByteBPE:
    """A vocabulary of byte strings with ranks: encodes pre-tokens, decodes ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.size = max(ranks.values(), default=0) + 1
        self.shift = self.size.bit_length()
        self.single = np.array([ranks[bytes([b])] for b in range(256)])
        pairs: dict[int, int] = {}
        self.lower = bytearray(self.size)
        for token, r in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << self.shift | b] = r
                    for part in (a, b):
                        if part > r:
                            self.lower[part] = 1
        #: Sorted codes of the pairs that merge, their ranks, and which ranks a lower one may follow.
        self.codes = np.array(sorted(pairs) or [-1], np.int64)
        self.merged = np.array([pairs.get(c, -1) for c in self.codes.tolist()], np.int64)

    def split(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def encode_batch(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each pre-token; a pre-token that is itself in the vocabulary is one id."""
        out: list[list[int]] = [[]] * len(pieces)
        todo, size = [], 0
        for k, piece in enumerate(pieces):
            if (r := self.ranks.get(piece)) is not None:
                out[k] = [r]
            elif piece:
                todo.append(k)
                size += len(piece)
                if size >= QUEUE_BYTES:
                    self._queue(pieces, todo, out)
                    todo, size = [], 0
        if todo:
            self._queue(pieces, todo, out)
        return out

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge ranks of symbol pairs, -1 where the vocabulary has none (or a border is in it)."""
        code = left << self.shift | right  # negative for a border
        at = np.searchsorted(self.codes, code)
        at[at == len(self.codes)] = 0
        return np.where(self.codes[at] == code, self.merged[at], -1)

    def _queue(self, pieces: list[bytes], todo: list[int], out: list[list[int]]) -> None:
        """Encode ``pieces[k]`` for k in ``todo`` with one rank queue."""
        raw = np.frombuffer(b"".join(pieces[k] for k in todo), np.uint8)
        sizes = np.array([len(pieces[k]) for k in todo])
        ends = np.cumsum(sizes) + np.arange(1, len(todo) + 1)  # a border stands before each piece and at the end
        n = int(ends[-1]) + 1
        starts = ends - sizes
        inside = np.ones(n, bool)
        inside[ends] = inside[0] = False
        symbol = np.full(n, -1, np.int64)
        symbol[inside] = self.single[raw]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        pair_rank = np.full(n, -1, np.int64)
        pair_rank[:-1] = self._ranks(symbol[:-1], symbol[1:])
        buckets: dict[int, list[int]] = {}
        marks = RankBitmap(self.size)

        def put(positions: np.ndarray, ranks: np.ndarray) -> None:
            for p, s in zip(positions.tolist(), ranks.tolist(), strict=True):
                if s in buckets:
                    buckets[s].append(p)
                else:
                    buckets[s] = [p]
                    marks.add(s)

        first = np.nonzero(pair_rank >= 0)[0]
        first = first[np.argsort(pair_rank[first], kind="stable")]
        found, at = np.unique(pair_rank[first], return_index=True)
        for s, positions in zip(found.tolist(), np.split(first, at[1:]) if len(at) else [], strict=True):
            buckets[s] = positions.tolist()
            marks.add(s)

        while (r := marks.first()) >= 0:
            p = np.array(sorted(buckets.pop(r)))
            marks.remove(r)
            p = p[pair_rank[p] == r]  # the others are stale
            if not len(p):
                continue
            if len(p) > 1:
                p = p[np.concatenate(([True], p[1:] != p[:-1]))]
                touching = after[p[:-1]] == p[1:]
                if touching.any():  # of a run such as aaaa, every other pair is merged
                    start = np.concatenate(([True], ~touching))
                    k = np.arange(len(p))
                    p = p[(k - np.maximum.accumulate(np.where(start, k, 0))) % 2 == 0]
                if self.lower[r]:  # a merge here may yield a lower rank, which goes first in its piece
                    own = np.searchsorted(ends, p)
                    lead = np.concatenate(([True], own[1:] != own[:-1]))
                    if not lead.all():
                        put(p[~lead], np.full(int((~lead).sum()), r))
                        p = p[lead]
            q = after[p]
            nxt = after[q]
            symbol[p] = r
            pair_rank[q] = -1
            after[p] = nxt
            before[nxt] = p
            prv = before[p]
            pair_rank[p] = right = self._ranks(symbol[p], symbol[nxt])
            keep = right >= 0
            put(p[keep], right[keep])
            pair_rank[prv] = left = self._ranks(symbol[prv], symbol[p])
            keep = left >= 0
            put(prv[keep], left[keep])

        alive = np.zeros(n, bool)
        p = starts  # every piece still has its first position
        while len(p):
            alive[p] = True
            p = after[p]
            p = p[symbol[p] >= 0]
        places = np.nonzero(alive)[0]
        ids, cuts = symbol[places].tolist(), np.searchsorted(places, starts).tolist() + [len(places)]
        for i, k in enumerate(todo):
            out[k] = ids[cuts[i] : cuts[i + 1]]

    def encode(self, text: str) -> list[int]:
        return [i for ids in self.encode_batch([m.encode() for m in self.split(text)]) for i in ids]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@cache
def load(path: str, pattern: str) -> ByteBPE:
    """The vocabulary of a rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return ByteBPE({base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}, pattern)


_caches: dict[tuple[str, str], PieceCache] = {}


def encode_ids(bpe: ByteBPE, cache: PieceCache, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts end to end, how many each has). ``cache`` holds pre-tokens that are known."""

    def whole(chunks: list[str]) -> list[list[int]]:
        split = [[m.encode() for m in bpe.split(c)] for c in chunks]
        ids = iter(bpe.encode_batch([m for ms in split for m in ms]))
        return [[i for _ in ms for i in next(ids)] for ms in split]

    return encode_texts(texts, cache, bpe.encode_batch, whole, lambda t: bpe.pattern.pattern != PATTERN)


def encode_decode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode each text, decode the ids again: ``key, n_tokens, ids_sha256, decoded_sha256`` (and ``ids``).

    ``ids_sha256`` is of the decimal ids joined by commas, ``decoded_sha256`` of the decoded bytes. A null text
    counts as empty: no token and both digests of the empty string. Repeated and null keys stay as they are.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        cache = _caches.setdefault((path, pattern), PieceCache(CACHE_SIZE))
        decimal, token = list(map(str, range(bpe.size))).__getitem__, bpe.bytes_of.__getitem__

        def encoded(keys: pa.Array, texts: list[str]) -> pa.RecordBatch:
            shas, decoded, all_ids = [], [], []
            flat, sizes = encode_ids(bpe, cache, [t or "" for t in texts])
            for part in np.split(flat, np.cumsum(sizes)[:-1]):
                ids = part.tolist()
                shas.append(hashlib.sha256(",".join(map(decimal, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(b"".join(map(token, ids))).hexdigest())
                if with_ids:
                    all_ids.append(ids)
            cols = [keys, pa.array(sizes, pa.int64()), pa.array(shas, pa.string()), pa.array(decoded, pa.string())]
            return pa.RecordBatch.from_arrays(cols + [pa.array(all_ids, pa.list_(pa.int32()))] * with_ids, ["key", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids)

        for batch in batches:
            texts, chars, done = [], 0, 0
            for t in batch.column(1).to_pylist():
                texts.append(t)
                chars += len(t or "")
                if chars >= CHUNK_CHARS:
                    yield encoded(batch.column(0).slice(done, len(texts)), texts)
                    texts, chars, done = [], 0, done + len(texts)
            if texts:
                yield encoded(batch.column(0).slice(done, len(texts)), texts)

    out = df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
    return out.withColumnRenamed("key", key)

"""Token-id files of directly addressable codes.

Ids are cut into chunks of 8, 4, 4, 8 and 8 bits. Level 0 holds the first chunk of every id and a bitmap that
says which ids go on; level 1 holds the next chunk of those, with a bitmap again, and so forth. A rank
directory counts the bitmap's ones before each block of 512 bits, so the place of an id in the next level is
one directory entry and a few popcounts away: any token can be read without decoding what stands before it,
and a run of tokens is a run on every level.

Layout (little-endian): magic, header length, JSON header, then for each document its key and the place of its
first token, then for each level chunks, bitmap and rank directory.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, shared_dir, tasks
from .spans import PieceCache, encode_texts
from .store import read_file, write_file

#: Texts that go to the library at a time.
JOINED = 2000

MAGIC = b"TWDAC001"
#: Bits of each level's chunks.
CHUNK_BITS = (8, 4, 4, 8, 8)
#: Tokens after which a writer begins another file; tokens that a reader decodes at a time.
FILE_TOKENS, RUN_TOKENS = 1 << 22, 1 << 18
#: Pre-tokens in a worker's cache; characters that are encoded together.
CACHE_SIZE = 1_500_000
BATCH_CHARS = 1 << 21


def _pack(chunks: np.ndarray, bits: int) -> np.ndarray:
    if bits == 8:
        return chunks.astype(np.uint8)
    chunks = chunks.astype(np.uint8)
    if len(chunks) % 2:
        chunks = np.append(chunks, np.uint8(0))
    return chunks[::2] | chunks[1::2] << 4


def encode_levels(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(chunks, continuation bitmap, rank directory) of each level for unsigned 32-bit ids."""
    levels, rest = [], ids.astype(np.uint32, copy=False)
    for bits in CHUNK_BITS:
        more = rest >> np.uint32(bits)
        goes_on = more != 0
        bitmap = np.packbits(goes_on, bitorder="little")
        bitmap = np.concatenate([bitmap, np.zeros(-len(bitmap) % 64, np.uint8)])
        ones = np.bitwise_count(bitmap.view(np.uint64)).reshape(-1, 8).sum(1, dtype=np.uint32)
        directory = np.concatenate([[0], np.cumsum(ones)]).astype(np.uint32)
        levels.append((_pack(rest & np.uint32((1 << bits) - 1), bits), bitmap, directory))
        rest = more[goes_on]
        if not len(rest):
            break
    return levels


class TokenFile:
    """Random access to the tokens of one file, of which only the header and what is asked for is read.

    ``source`` is the file's bytes or a seekable file.
    """

    def __init__(self, source):
        self._source = memoryview(source) if isinstance(source, bytes | bytearray | memoryview) else source
        start = bytes(self._read(0, 12))
        if start[:8] != MAGIC:
            raise ValueError("not a token file")
        n = int.from_bytes(start[8:12], "little")
        head = json.loads(bytes(self._read(12, n)))
        self.n_documents, self.n_tokens = head["documents"], head["tokens"]
        at = 12 + n
        self._place: dict[str | tuple[int, int], int] = {}

        def section(name: str | tuple[int, int], size: int) -> None:
            nonlocal at
            at += -at % 8
            self._place[name] = at
            at += size

        for name, size in (("keys", 8 * self.n_documents), ("null_keys", self.n_documents), ("offsets", 8 * self.n_documents + 8)):
            section(name, size)
        self.n_levels = len(head["levels"])
        for level, sizes in enumerate(head["levels"]):
            for k, (size, width) in enumerate(zip(sizes, (1, 1, 4), strict=True)):
                section((level, k), size * width)

    def _read(self, at: int, n: int):
        if isinstance(self._source, memoryview):
            return self._source[at : at + n]
        self._source.seek(at)
        return self._source.read(n)

    def _part(self, name: str | tuple[int, int], kind, start: int, end: int) -> np.ndarray:
        width = np.dtype(kind).itemsize
        return np.frombuffer(self._read(self._place[name] + start * width, (end - start) * width), kind)

    @property
    def keys(self) -> np.ndarray:
        return self._part("keys", np.int64, 0, self.n_documents)

    @property
    def null_keys(self) -> np.ndarray:
        return self._part("null_keys", np.uint8, 0, self.n_documents)

    @property
    def offsets(self) -> np.ndarray:
        """Where each document begins, and the end."""
        return self._part("offsets", np.int64, 0, self.n_documents + 1)

    def _rank(self, level: int, i: int) -> int:
        """Ones in the level's bitmap before bit i: a directory entry and a part of one block."""
        block = i >> 9
        rank = int(self._part((level, 2), np.uint32, block, block + 1)[0])
        if i & 511:
            word = int.from_bytes(self._part((level, 1), np.uint8, block << 6, (block + 1) << 6).tobytes(), "little")
            rank += (word & (1 << (i & 511)) - 1).bit_count()
        return rank

    def tokens(self, start: int, end: int) -> np.ndarray:
        """Ids of the tokens from ``start`` to before ``end``."""
        out = np.zeros(end - start, np.uint32)
        where, shift = None, 0
        for level in range(self.n_levels):
            if start >= end:
                break
            bits = CHUNK_BITS[level]
            if bits == 8:
                part = self._part((level, 0), np.uint8, start, end).astype(np.uint32)
            else:
                pair = self._part((level, 0), np.uint8, start >> 1, (end + 1) >> 1)
                part = np.empty(2 * len(pair), np.uint32)
                part[::2], part[1::2] = pair & 15, pair >> 4
                part = part[start & 1 : (start & 1) + end - start]
            if where is None:
                out[:] = part
            else:
                out[where] |= part << np.uint32(shift)
            shift += bits
            on = np.unpackbits(self._part((level, 1), np.uint8, start >> 3, (end + 7) >> 3), bitorder="little")[start & 7 : (start & 7) + end - start].view(bool)
            where = np.nonzero(on)[0] if where is None else where[on]
            start, end = self._rank(level, start), self._rank(level, end)
        return out

    def token(self, i: int) -> int:
        return int(self.tokens(i, i + 1)[0])

    def document(self, k: int) -> np.ndarray:
        start, end = self._part("offsets", np.int64, k, k + 2).tolist()
        return self.tokens(start, end)

    def documents(self) -> Iterator[np.ndarray]:
        """The ids of every document in turn, decoded in runs of about ``RUN_TOKENS``."""
        offsets = self.offsets
        first = 0
        while first < self.n_documents:
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + RUN_TOKENS, "right")) - 1)
            run = self.tokens(int(offsets[first]), int(offsets[last]))
            yield from np.split(run, offsets[first + 1 : last] - offsets[first])
            first = last


def dump(keys: list[int | None], lengths: list[int], ids: np.ndarray) -> Iterator[bytes]:
    """The parts of a file for documents of these lengths, whose ids follow each other in ``ids``."""
    levels = encode_levels(ids)
    head = json.dumps({"documents": len(keys), "tokens": len(ids), "levels": [[len(x) for x in level] for level in levels]}).encode()
    sections = [np.array([k or 0 for k in keys], np.int64), np.array([k is None for k in keys], np.uint8), np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)]
    size = 12 + len(head)
    yield MAGIC + len(head).to_bytes(4, "little") + head + bytes(-size % 8)
    for x in [*sections, *(x for level in levels for x in level)]:
        yield x.tobytes() + bytes(-x.nbytes % 8)


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte but 0: itself if it is visible in Latin-1."""
    visible = {b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden) if b}


class _Library:
    """The tokenizers library behind a bounded cache of pre-tokens.

    Texts of common characters are cut into pre-tokens here, and the library's merges run once for each that is not
    known yet. What has other characters or the string of a special token, and all texts where the vocabulary is of
    another make, go to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        state = json.loads(self.library.to_str())
        pre, model = state.get("pre_tokenizer") or {}, state["model"]
        self.local = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and state.get("normalizer") is None and (state.get("post_processor") or {}).get("type") in (None, "ByteLevel") and model["type"] == "BPE" and not model.get("dropout")
        self.special = [x["content"] for x in state.get("added_tokens", [])]
        self.letters = _byte_letters()
        self.cache = PieceCache(CACHE_SIZE)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for k in range(0, len(texts), JOINED) for x in self.library.encode_batch_fast(texts[k : k + JOINED], add_special_tokens=False)]

    def _merge(self, pieces: list[bytes]) -> list[list[int]]:
        tokenize = self.library.model.tokenize
        return [[t.id for t in tokenize(w)] for w in b"\0".join(pieces).decode("latin-1").translate(self.letters).split("\0")]

    def _aside(self, text: str) -> bool:
        return not self.local or any(s in text for s in self.special)

    def encode(self, texts: list[str], end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, how many each has), with ``end_id`` after each text."""
        ids, lengths = encode_texts(texts, self.cache, self._merge, self._whole, self._aside)
        if end_id is None:
            return ids, lengths
        return np.insert(ids, np.cumsum(lengths), np.uint32(end_id)), lengths + 1


_libraries: dict[str, _Library] = {}


def write_tokens(df: DataFrame, folder: str, path: str, end_id: int | None, key: str = "doc_id", text: str = "text", file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Encode every text and write token files in ascending key order; returns the manifest.

    Manifest: ``uri, n_documents, n_tokens, first_token`` (tokens in all files before). A null text counts as
    empty, a null key comes first, rows of equal keys keep any order among themselves.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = _libraries.setdefault(path, None) or _Library(path)
        _libraries[path] = library
        task, seq = TaskContext.get().partitionId(), 0
        keys, lengths, parts, n = [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal keys, lengths, parts, n, seq
            uri = write_file(folder, f"{task:06d}-{seq:06d}.dac", dump(keys, lengths, np.concatenate(parts)))
            row = pa.RecordBatch.from_pydict({"task": [task], "seq": [seq], "uri": [uri], "n_documents": [len(keys)], "n_tokens": [n]})
            keys, lengths, parts, n, seq = [], [], [], 0, seq + 1
            return row

        def encoded(ks: list, texts: list[str]) -> None:
            nonlocal n
            ids, sizes = library.encode(texts, end_id)
            keys.extend(ks)
            lengths.extend(sizes.tolist())
            parts.append(ids)
            n += len(ids)

        for batch in batches:
            ks, texts, chars = [], [], 0
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ks.append(k)
                texts.append(t or "")
                chars += len(texts[-1])
                if chars >= BATCH_CHARS:
                    encoded(ks, texts)
                    ks, texts, chars = [], [], 0
                    if n >= file_tokens:
                        yield close()
            if ks:
                encoded(ks, texts)
                if n >= file_tokens:
                    yield close()
        if keys:
            yield close()

    spark = df.sparkSession
    ordered = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).repartitionByRange("key").sortWithinPartitions("key")
    written = materialize(ordered.mapInArrow(run, "task long, seq long, uri string, n_documents long, n_tokens long"), "token-manifest")
    before = Window.orderBy("task", "seq").rowsBetween(Window.unboundedPreceding, -1)  # one row a file, not a document
    return written.select("uri", "n_documents", "n_tokens", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("first_token"))


def read_tokens(manifest: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, start, n_tokens, ids_crc32`` of every document in the files of a manifest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file = TokenFile(read_file(row["uri"]))
                crc = [zlib.crc32(ids) for ids in file.documents()]
                keys, offsets = pa.array(file.keys, mask=file.null_keys.astype(bool)), file.offsets
                yield pa.RecordBatch.from_arrays([keys, pa.array(offsets[:-1] + row["first_token"]), pa.array(np.diff(offsets)), pa.array(crc, pa.int64())], ["key", "start", "n_tokens", "ids_crc32"])

    spread = manifest.repartition(tasks(manifest.sparkSession), "uri")  # by number: the rows are few and small, their files are not
    return spread.mapInArrow(run, "key long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("key", key)


def token_archive(df: DataFrame, path: str, end_id: int | None = 2, folder: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the token files of ``df`` (under ``folder`` or the shared one) and read them back."""
    return read_tokens(write_tokens(df, folder or shared_dir(df.sparkSession, "tokens"), path, end_id, key, text), key)

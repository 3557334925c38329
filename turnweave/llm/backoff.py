"""Language-model scores by stupid backoff, computed relationally over the corpus itself.

S(w | context) is count(context w) / count(context) if count(context w) is at least ``min_count``; otherwise
``alpha`` times the score with a context shorter by a word, and at last count(w) / N. A document's score is the
sum of log10 S over its words.

Relations: the corpus is cut into blocks of documents; a block, which lies in the shared folder as word hashes, is
exploded into its distinct n-grams (64-bit hashes) with their counts inside, cut by hash into buckets. The count
table of a bucket is the union of all blocks' n-grams of that bucket, summed; joined back to the blocks it gives
every n-gram of a block its count in the corpus, and the blocks' words, joined with those counts, are summed by
document. An n-gram passes the shuffle once a block, not once an occurrence, so a frequent one is no hot key. The
number of buckets follows from the number of words, so that a bucket holds about ``BUCKET_WORDS`` whatever the
input. The orders go one after another, so only one order's n-grams are on disk at a time.

Blocks and count tables are files that the Python workers write; Spark's writers, whose JVM starts a process for each
file on a local file system, have no part in it. Small blocks, as many small input files give them, are exploded and
scored together. The driver holds a row for each block.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import gather, shared_dir, tasks
from .spans import mix, word_hashes
from .store import read_file, write_file

#: Words after which a block is closed; words and documents up to which small blocks are put together; words of the
#: corpus for each bucket; characters that are hashed together.
BLOCK_WORDS = 2_500_000
GROUP_SIZE = 1_000_000
BUCKET_WORDS = 2_000_000
HASH_CHARS = 1 << 21
_PRIME = np.uint64(0x9E3779B97F4A7C15)
#: The rows of a count table.
COUNTS = "block long, n int, bucket long, totals binary"


def ngram_hashes(stream: np.ndarray, lengths: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the n-grams, places of their last words) in documents of these lengths, end to end."""
    ends = np.cumsum(lengths)
    place = np.arange(len(stream)) - np.repeat(ends - lengths, lengths)
    at = np.flatnonzero(place >= n - 1)
    total = np.full(len(at), n, np.uint64)
    for k in range(n - 1, -1, -1):
        total = total * _PRIME + stream[at - k]
    return mix(total), at


def dump_block(docs: list[int | None], lengths: np.ndarray, stream: np.ndarray) -> bytes:
    vocabulary, local = np.unique(stream, return_inverse=True)
    parts = [np.array([d or 0 for d in docs], np.int64), np.array([d is None for d in docs], np.uint8), lengths.astype(np.int64), vocabulary.astype(np.uint64), local.astype(np.uint32)]
    data = [zlib.compress(x.tobytes(), 1) for x in parts]
    return b"".join([len(docs).to_bytes(8, "little"), *(len(x).to_bytes(8, "little") + x for x in data)])


def load_block(data: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(document ids, lengths, word hashes end to end)."""
    at, parts = 8, []
    for kind in (np.int64, np.uint8, np.int64, np.uint64, np.uint32):
        n = int.from_bytes(data[at : at + 8], "little")
        parts.append(np.frombuffer(zlib.decompress(data[at + 8 : at + 8 + n]), kind))
        at += 8 + n
    docs, nulls, lengths, vocabulary, local = parts
    return pa.array(docs, mask=nulls.astype(bool)), lengths, vocabulary[local] if len(local) else np.empty(0, np.uint64)


def load_blocks(folder: str, names: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """These blocks end to end."""
    docs, lengths, streams = zip(*(load_block(read_file(f"{folder}/{name}")) for name in names), strict=True)
    return pa.concat_arrays(docs), np.concatenate(lengths), np.concatenate(streams)


def pack_sorted(x: np.ndarray) -> bytes:
    """Ascending 64-bit numbers by their differences, six bytes each where that is enough."""
    step = np.diff(x, prepend=x[:1])
    width = 6 if not len(step) or int(step.max()) < 1 << 48 else 8
    first = int(x[0]) if len(x) else 0
    return bytes([width]) + first.to_bytes(8, "little") + step.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    width, first = data[0], int.from_bytes(data[1:9], "little")
    step = np.zeros(((len(data) - 9) // width, 8), np.uint8)
    step[:, :width] = np.frombuffer(data, np.uint8, offset=9).reshape(-1, width)
    return np.cumsum(step.view("<u8").ravel(), dtype=np.uint64) + np.uint64(first)


def pack_counts(x: np.ndarray) -> bytes:
    """Whole numbers, most of them small: a byte each, 255 for those that follow in full."""
    small = np.minimum(x, 255).astype(np.uint8)
    return zlib.compress(len(x).to_bytes(8, "little") + small.tobytes() + x[small == 255].astype(np.uint64).tobytes(), 1)


def unpack_counts(data: bytes) -> np.ndarray:
    raw = zlib.decompress(data)
    n = int.from_bytes(raw[:8], "little")
    out = np.frombuffer(raw, np.uint8, n, 8).astype(np.uint64)
    out[out == 255] = np.frombuffer(raw[8 + n :], np.uint64)
    return out


def _distinct(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ascending distinct values, which of them each one is)."""
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    new = np.ones(len(grams), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    number = np.empty(len(grams), np.int64)
    number[order] = np.cumsum(new) - 1
    return ranked[new], number


def _cuts(grams: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """The buckets that the ascending hashes fall into, with their places."""
    bucket = (grams >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(grams) else np.empty(0, np.int64)
    ends = np.append(at[1:], len(grams))
    return zip(bucket[at].tolist(), map(slice, at.tolist(), ends.tolist()), strict=True)


def write_blocks(df: DataFrame, folder: str, block_words: int = BLOCK_WORDS) -> list[tuple[str, int, int]]:
    """(name, words, words and documents) of each block of documents (columns doc, text) that lies in the folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: list = []
        hashes: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        held = closed = 0

        def close() -> pa.RecordBatch:
            nonlocal docs, hashes, lengths, held, closed
            data = dump_block(docs, np.concatenate(lengths), np.concatenate(hashes))
            # Named by content, task and number in the task: a task that runs again writes the same file, and equal
            # blocks stay apart.
            name = f"{hashlib.blake2b(data, digest_size=16).hexdigest()}-{TaskContext.get().partitionId()}-{closed}"
            write_file(folder, name, data, exact=True)
            row = pa.RecordBatch.from_pydict({"block": [name], "words": [held], "size": [held + len(docs)]}, pa.schema([("block", pa.string()), ("words", pa.int64()), ("size", pa.int64())]))
            docs, hashes, lengths, held, closed = [], [], [], 0, closed + 1
            return row

        for batch in batches:
            ids, texts, chars = [], [], 0
            for k, (doc, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), 1):
                ids.append(doc)
                texts.append(text)
                chars += len(text or "")
                if chars >= HASH_CHARS or k == batch.num_rows:
                    found, sizes = word_hashes(texts)
                    docs += ids
                    hashes.append(found)
                    lengths.append(sizes)
                    held += len(found)
                    ids, texts, chars = [], [], 0
                    if held >= block_words:
                        yield close()
        if docs:
            yield close()

    return [tuple(r) for r in gather(df.mapInArrow(run, "block string, words long, size long"))]


def together(blocks: list[tuple[str, int]], most: int) -> list[list[str]]:
    """The names of the blocks (name, size), neighbours put together while they have at most that size."""
    groups: list[list[str]] = []
    held = 0
    for name, size in blocks:
        if not groups or held + size > most:
            groups.append([])
            held = 0
        groups[-1].append(name)
        held += size
    return groups


def corpus_counts(groups: DataFrame, folder: str, n: int, buckets: int) -> None:
    """Writes ``block, n, bucket, totals`` as a file for each bucket: the corpus counts of the distinct n-grams of each
    group of blocks (columns block, files), in ascending order of hash. Block 0 has a row in every bucket."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, names in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                _, lengths, stream = load_blocks(folder, names)
                grams, counts = np.unique(ngram_hashes(stream, lengths, n)[0], return_counts=True)
                parts = dict(_cuts(grams, buckets))
                if block == 0:
                    parts = dict.fromkeys(range(buckets), slice(0, 0)) | parts
                rows = [(block, k, pack_sorted(grams[part]), pack_counts(counts[part])) for k, part in parts.items()]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["block", "bucket", "grams", "counts"])

    def total(table: pa.Table) -> pa.Table:
        parts = list(map(unpack_sorted, table.column("grams").to_pylist()))
        _, number = _distinct(np.concatenate(parts))
        counts = np.concatenate(list(map(unpack_counts, table.column("counts").to_pylist())))
        answer = np.bincount(number, weights=counts)[number].astype(np.uint64)
        packed = [pack_counts(x) for x in np.split(answer, np.cumsum([len(p) for p in parts])[:-1])]
        rows = pa.table({"block": table.column("block"), "n": pa.array([n] * len(parts), pa.int32()), "bucket": table.column("bucket"), "totals": pa.array(packed, pa.binary())})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema) as out:
            out.write_table(rows)
        bucket = table.column("bucket")[0].as_py()
        # Named by order and bucket: a task that runs again writes the same rows.
        write_file(folder, counts_file(n, bucket), memoryview(sink.getvalue()), exact=True)
        return pa.table({"bucket": pa.array([bucket], pa.int64())})

    exploded = groups.repartition(tasks(groups.sparkSession)).mapInArrow(explode, "block long, bucket long, grams binary, counts binary")
    gather(exploded.groupBy("bucket").applyInArrow(total, "bucket long").groupBy().count())


def counts_file(n: int, bucket: int) -> str:
    return f"counts-{n}-{bucket}"


def read_counts(spark: SparkSession, folder: str, order: int, buckets: int) -> DataFrame:
    """``block, n, bucket, totals`` of all orders' files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                with pa.ipc.open_stream(read_file(f"{folder}/{counts_file(k // buckets + 1, k % buckets)}")) as rows:
                    yield from rows

    return spark.range(0, order * buckets, 1, tasks(spark)).mapInArrow(read, COUNTS)


def stupid_backoff(df: DataFrame, order: int = 3, alpha: float = 0.4, min_count: int = 2, key: str = "doc_id", text: str = "text", buckets: int | None = None, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``key, n_words, log10_score, log10_mean``: one row for each row of ``df``.

    Words are lower-cased (A-Z) and separated by ASCII white space; counts are over all rows. A null or empty
    text has no words, score 0 and a null mean. Repeated rows count and are scored each; null keys stay. Other
    columns of ``df``, whatever their names, play no part.
    """
    spark = df.sparkSession
    folder = shared_dir(spark, "lm-blocks")
    blocks = write_blocks(df.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text")), folder, block_words)
    n_all = sum(words for _, words, _ in blocks)
    buckets = buckets or max(tasks(spark), -(-n_all // BUCKET_WORDS))
    groups = list(enumerate(together([(name, size) for name, _, size in blocks], min(GROUP_SIZE, block_words))))
    for n in range(1, order + 1) if groups else ():
        corpus_counts(spark.createDataFrame(groups, "block long, files array<string>"), folder, n, buckets)
    # A row of order 0 for each group of blocks, with their names; one without n-grams is scored too.
    every = spark.createDataFrame([(k, 0, 0, "\n".join(names).encode()) for k, names in groups], COUNTS)
    if groups:
        every = every.unionByName(read_counts(spark, folder, order, buckets))

    def score(table: pa.Table) -> pa.Table:
        answers: dict[int, list[tuple[int, bytes]]] = {n: [] for n in range(order + 1)}
        for n, k, totals in zip(*(table.column(c).to_pylist() for c in ("n", "bucket", "totals")), strict=True):
            answers[n].append((k, totals))
        docs, lengths, stream = load_blocks(folder, answers[0][0][1].decode().split("\n"))
        best = np.zeros(len(stream))  # S of each word so far, from the shortest context up
        shorter = np.zeros(len(stream))  # counts of the n-grams one word shorter, by last word
        for n in range(1, order + 1):
            grams, at = ngram_hashes(stream, lengths, n)
            count = np.concatenate([np.empty(0), *(unpack_counts(t) for _, t in sorted(answers[n]))])[_distinct(grams)[1]]
            if n == 1:
                best[at] = count / n_all
            else:
                best[at] = np.where(count >= min_count, count / shorter[at - 1], alpha * best[at])
            shorter = np.zeros(len(stream))
            shorter[at] = count
        total = np.bincount(np.repeat(np.arange(len(lengths)), lengths), weights=np.log10(best), minlength=len(lengths)) if len(lengths) else np.empty(0)
        mean = pa.array(total / np.maximum(lengths, 1), mask=lengths == 0)
        return pa.table({"doc": docs, "n_words": pa.array(lengths), "log10_score": pa.array(total, pa.float64()), "log10_mean": mean})

    out = every.groupBy("block").applyInArrow(score, "doc long, n_words long, log10_score double, log10_mean double")
    return out.withColumnRenamed("doc", key)

"""Token counts: a map-side two-tier lookup.

Tier one is a compact table of the corpus's most frequent pre-tokens and their token counts, built once from all
documents and broadcast (at most ``TABLE_SIZE`` entries, so its size has a fixed bound). Tier two is a cache in each
Python worker: a pre-token that the table lacks is encoded once by the library and then remembered. No occurrence
of a pre-token is ever shuffled: for the table a task sends each distinct one with its number (once more each time
it has met ``TALLY_SIZE`` of them), and then one row per document.

The table decides only which counts are known beforehand, never a result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, scratch

#: Entries of the broadcast table; of a worker's cache before it starts anew; of a task's tally before it is sent.
TABLE_SIZE = 65_536
CACHE_SIZE = 1_500_000
TALLY_SIZE = 250_000
#: Longer pre-tokens are encoded each time and never kept.
CACHED_CHARS = 64

#: The space before a run of other characters or of further spaces.
_WORD_START = re.compile(r"(?<=[^ ]) ")


class PieceCounter(dict):
    """Pre-token to token count; a missing one is encoded by the sentencepiece library."""

    def __init__(self, model_path: str, known: dict[str, int], limit: int = CACHE_SIZE):
        import sentencepiece

        super().__init__(known)
        self.known, self.limit = known, limit
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = map(self.library.id_to_piece, range(self.library.get_piece_size()))
        #: No piece has the word mark anywhere but at its start, so no merge crosses what stands before a mark.
        self.splits = not any("▁" in p.lstrip("▁") or " " in p for p in pieces)

    def __missing__(self, segment: str) -> int:
        if len(self) >= self.limit:
            self.clear()
            self.update(self.known)
        # The library puts one word mark in front, save where there is nothing else.
        n = len(self.library.encode(segment, num_threads=1)) if segment else 1
        if len(segment) <= CACHED_CHARS:
            self[segment] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.splits or "▁" in text:
            return len(self.library.encode(text, num_threads=1))
        return sum(map(self.__getitem__, segments(text)))


def segments(text: str) -> list[str]:
    """Pre-tokens of a text, without the word mark that each begins with."""
    return _WORD_START.split(text) if "  " in text or text[:1] == " " or text[-1:] == " " else text.split(" ")


_workers: dict[tuple, PieceCounter] = {}


def _counter(model_path: str, packed: tuple[bytes, bytes], limit: int) -> PieceCounter:
    key = (model_path, hash(packed), limit)
    if key not in _workers:
        _workers.clear()
        blob, lengths = packed
        words = blob.decode().split("\x00") if lengths else []
        _workers[key] = PieceCounter(model_path, dict(zip(words, memoryview(lengths).cast("H"), strict=True)), limit)
    return _workers[key]


def pretoken_numbers(df: DataFrame, text: str, tally_size: int = TALLY_SIZE) -> DataFrame:
    """``segment, n``: how often each pre-token of at most ``CACHED_CHARS`` characters occurs in all rows."""

    def rows(seen: Counter) -> pa.RecordBatch:
        kept = [s for s in seen if s and "\x00" not in s]
        return pa.RecordBatch.from_arrays([pa.array(kept, pa.string()), pa.array([seen[s] for s in kept], pa.int64())], ["segment", "n"])

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                found = segments(value)
                if max(map(len, found)) > CACHED_CHARS:
                    found = [s for s in found if len(s) <= CACHED_CHARS]
                seen.update(found)
                if len(seen) >= tally_size:
                    yield rows(seen)
                    seen.clear()
        yield rows(seen)

    return df.where(F.col(text).isNotNull()).select(text).mapInArrow(tally, "segment string, n long").groupBy("segment").agg(F.sum("n").alias("n"))


def frequent_table(df: DataFrame, text: str, model_path: str, size: int = TABLE_SIZE) -> tuple[bytes, bytes]:
    """The packed first tier: the most frequent pre-tokens of all rows and their token counts.

    Those that occur equally often are taken together, so the table may have fewer than ``size`` entries; the driver
    gets these alone, and how many pre-tokens there are of each frequency.
    """
    with scratch(df.sparkSession):
        numbers = materialize(pretoken_numbers(df, text), "pretokens")
        least, total = None, 0
        for n, many in numbers.groupBy("n").count().orderBy(F.desc("n")).collect():
            total += many
            if total > size:
                break
            least = n
        words = [r["segment"] for r in numbers.where(F.col("n") >= least).orderBy(F.desc("n"), "segment").collect()] if least else []
    if not words:
        return b"", b""
    counter = PieceCounter(model_path, {})
    return "\x00".join(words).encode(), pa.array([counter[w] for w in words], pa.uint16()).buffers()[1].to_pybytes()[: 2 * len(words)]


def count_tokens(df: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", limit: int = 4096, cache_size: int = CACHE_SIZE) -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` for each row of ``df``.

    A null text counts as empty (0 bytes, 0 tokens); repeated and null keys stay as they are; no begin, end
    or added special tokens; texts are neither truncated nor padded.
    """
    packed = frequent_table(df, text, model_path)
    shared = df.sparkSession.sparkContext.broadcast(packed)
    kind = df.schema[key].dataType

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model_path, shared.value, cache_size)
        for batch in batches:
            texts = batch.column(1)
            n = pa.array([counter.count(t) if t else 0 for t in texts.to_pylist()], pa.int64())
            size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, n, pc.greater(n, limit)], ["key", "n_bytes", "n_tokens", "over_limit"])

    out = df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(count, f"key {kind.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("key", key)

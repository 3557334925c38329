"""Benchmark decontamination by a prefix-filtered set join.

Each benchmark item is cut into windows of ``window`` consecutive words (a shorter item is one window), each
window into shingles of two words (a one-word window is one shingle). A document holds a window only if it
holds all of the window's shingles, so the necessary prefix, with shingles ordered by rarity in the corpus, is
the rarest one. The documents probe an index of prefix shingles; the shingle's place in the window gives the
only possible start (positional bound), which must leave room for the whole window (length bound), and then
the words themselves are compared.

The items are a stated query set. Up to ``BLOCK_WORDS`` words they are broadcast, and the documents are mapped
without a shuffle. A larger benchmark stays a table: its windows are reduced to prefix shingles by joins, each
document sends the places of those of its shingles that are a prefix of some window, and candidates that pass the
bounds are verified against the document's words by a join on the row.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from .common import materialize
from .lookup import bitmap_filter

#: Words of benchmark items, by a bound from their bytes, that are broadcast at most; places of a batch.
BLOCK_WORDS = 1_000_000
PLACES = 1 << 16
RESULTS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
_PLACES = pa.schema([("row", pa.int64()), ("place", pa.int64()), ("last", pa.int64()), ("shingle", pa.int64())])

#: All ASCII characters but letters and digits separate words.
_SEPARATORS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Words of a text: A-Z lower-cased, runs of ASCII letters and digits and of anything beyond ASCII."""
    return text.encode().lower().translate(_SEPARATORS).split() if text else []


def windows_of(ws: list[bytes], size: int) -> list[tuple[bytes, ...]]:
    if not ws:
        return []
    return [tuple(ws[i : i + size]) for i in range(max(1, len(ws) - size + 1))]


def shingles_of(window: tuple[bytes, ...]) -> list[tuple[bytes, bytes | None]]:
    return list(zip(window, window[1:], strict=False)) or [(window[0], None)]


def windows_in(items: list[tuple], size: int) -> dict[tuple, list]:
    """Window to the ids of the items that have it."""
    out: dict[tuple, list] = {}
    for item, t in items:
        for window in windows_of(words(t), size):
            out.setdefault(window, []).append(item)
    return out


def shingle_frequencies(df: DataFrame, text: str, windows: dict[tuple, list]) -> Counter:
    """In how many documents each shingle of the windows occurs; counted in each task, then summed."""
    seconds: dict[bytes, dict] = {}
    numbers: dict[tuple, int] = {}
    for window in windows:
        for s in shingles_of(window):
            seconds.setdefault(s[0], {})[s[1]] = numbers.setdefault(s, len(numbers))
    shared = df.sparkSession.sparkContext.broadcast(seconds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seconds, n = shared.value, Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                ws = words(t)
                ws.append(b"")
                found = set()
                for i in [i for i, w in enumerate(ws) if w in seconds]:
                    after = seconds[ws[i]]
                    if (k := after.get(ws[i + 1])) is not None:
                        found.add(k)
                    if None in after:
                        found.add(after[None])
                n.update(found)
        yield pa.RecordBatch.from_pydict({"shingle": list(n), "n": list(n.values())}, pa.schema([("shingle", pa.int64()), ("n", pa.int64())]))

    rows = df.select(text).mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).collect()
    count = {r["shingle"]: r["n"] for r in rows}
    return Counter({s: count.get(k, 0) for s, k in numbers.items()})


def prefix_index(windows: dict[tuple, list], frequency: Counter) -> dict[bytes, list[tuple]]:
    """First word of a prefix shingle to (second word or None, place in the window, window, ids)."""
    index: dict[bytes, list[tuple]] = {}
    for window, items in windows.items():
        shingles = shingles_of(window)
        at = min(range(len(shingles)), key=lambda k: (frequency[shingles[k]], shingles[k][0], shingles[k][1] or b"", k))
        first, second = shingles[at]
        index.setdefault(first, []).append((second, at, list(window), items))
    return index


def find_windows(ws: list[bytes], index: dict[bytes, list[tuple]]) -> tuple[list[tuple[int, int]], set]:
    """Spans of words that are an occurrence of a window, and the ids of the items found."""
    spans, items, n = [], set(), len(ws)
    for i in [i for i, w in enumerate(ws) if w in index]:
        after = ws[i + 1] if i + 1 < n else None
        for second, place, window, ids in index[ws[i]]:
            start = i - place
            end = start + len(window)
            if (second is None or second == after) and start >= 0 and end <= n and ws[start:end] == window:
                spans.append((start, end))
                items.update(ids)
    return spans, items


def contamination(df: DataFrame, benchmark: DataFrame, window: int = 13, share: tuple[int, int] = (1, 20), key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """``df`` with ``n_words, n_hit, n_items, items_sha256, contaminated`` and, of its own columns, all.

    A word is hit if it lies inside any occurrence of a window. A document is contaminated if it has a hit word
    and the hit words are at least ``share`` of its words. Null and empty texts have no words; items without
    id, text or words have no windows; items that share an id are one item. Repeated rows stay. Columns of
    ``df`` with the name of a result are replaced.
    """
    own = [c for c in df.columns if c not in RESULTS]
    items = benchmark.where(F.col(item_key).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item_key).alias("item"), F.col(item_text).alias("text"))
    # Every word but the last has a separator behind it, so a text has at most half as many words as bytes, rounded up.
    bound = items.agg(F.sum(F.ceil(F.octet_length("text") / 2))).first()[0] or 0
    if bound > block_words:
        return _joined(df.select(*own), items, window, share, text)
    found = windows_in([tuple(r) for r in items.collect()], window) if bound else {}
    return _scan(df.select(*own), prefix_index(found, shingle_frequencies(df, text, found)) if found else {}, text, share)


def _verdict(ws: list[bytes], spans: list[tuple[int, int]], items: set, share: tuple[int, int]) -> tuple:
    hit, end = 0, 0
    for a, b in sorted(spans):
        hit += max(0, b - max(a, end))
        end = max(end, b)
    sha = hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
    return len(ws), hit, len(items), sha, hit > 0 and share[1] * hit >= share[0] * len(ws)


def _with_results(schema: StructType) -> StructType:
    kinds = (LongType(), LongType(), LongType(), StringType(), BooleanType())
    return StructType([*schema.fields, *(StructField(name, kind) for name, kind in zip(RESULTS, kinds, strict=True))])


def _appended(batch: pa.RecordBatch, columns: list[str], verdicts: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
    more = [pa.array([v[k] for v in verdicts], kind) for k, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays([batch.column(batch.schema.names.index(c)) for c in columns] + more, [*columns, *RESULTS])


def _scan(df: DataFrame, index: dict[bytes, list[tuple]], text: str, share: tuple[int, int]) -> DataFrame:
    """The documents against a broadcast index."""
    shared, own = df.sparkSession.sparkContext.broadcast(index), df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            verdicts = []
            for t in batch.column(batch.schema.names.index(text)).to_pylist():
                ws = words(t)
                verdicts.append(_verdict(ws, *find_windows(ws, index), share))
            yield _appended(batch, own, verdicts)

    return df.mapInArrow(run, _with_results(df.schema))


def _shingle_hash(s: tuple[bytes, bytes | None]) -> int:
    return xxhash.xxh3_64_intdigest(s[0] + b" " + (b"" if s[1] is None else s[1])) - (1 << 63)


def _joined(df: DataFrame, items: DataFrame, size: int, share: tuple[int, int], text: str) -> DataFrame:
    """The same by joins, for a benchmark of any size.

    ``windows``: window, its item and its shingles' hashes. ``frequency``: in how many documents a shingle occurs,
    counted for the benchmark's shingles. ``prefix``: of each window the rarest shingle and its place. A document
    row meets the windows of a prefix shingle by an equi-join of (shingle, place) with it; a shingle that very many
    rows hold is no prefix unless all of its window's shingles are as frequent, and the join can be split.
    """
    rows = materialize(df.withColumn("__id", F.monotonically_increasing_id()), "documents")
    kind = items.schema["item"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, t in enumerate(batch.column(1).to_pylist()):
                windows = windows_of(words(t), size)
                if windows:
                    item = pa.concat_arrays([batch.column(0).slice(k, 1)] * len(windows))
                    hashes = [[_shingle_hash(s) for s in shingles_of(w)] for w in windows]
                    yield pa.RecordBatch.from_arrays([item, pa.array([b" ".join(w) for w in windows], pa.binary()), pa.array(list(map(len, windows)), pa.int64()), pa.array(hashes, pa.list_(pa.int64()))], ["item", "words", "width", "hashes"])

    windows = materialize(items.mapInArrow(cut, f"item {kind}, words binary, width long, hashes array<long>").distinct(), "benchmark-windows")
    shingles = windows.select(F.explode("hashes").alias("shingle")).distinct()

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ws = words(t)
                found = [_shingle_hash(s) for s in zip(ws, ws[1:], strict=False)]
                one = [_shingle_hash((w, None)) for w in ws]
                at = [*range(len(found)), *range(len(one))]
                for k in range(0, len(at), PLACES):
                    part = at[k : k + PLACES]
                    yield pa.RecordBatch.from_pydict({"row": [row] * len(part), "place": part, "last": [len(ws)] * len(part), "shingle": (found + one)[k : k + PLACES]}, _PLACES)

    held = rows.select("__id", F.col(text).alias("text")).mapInArrow(places, "row long, place long, last long, shingle long")
    held = materialize(bitmap_filter(held, "shingle", shingles).join(shingles, "shingle", "left_semi"), "benchmark-places")
    frequency = held.select("row", "shingle").distinct().groupBy("shingle").agg(F.count("*").alias("n"))
    ranked = windows.select("item", "words", "width", F.size("hashes").alias("size"), F.posexplode("hashes").alias("at", "shingle")).join(frequency, "shingle")
    # A window with a shingle that no document has can't occur.
    prefix = ranked.groupBy("item", "words").agg(F.min(F.struct("n", "shingle", "at")).alias("p"), F.count("*").alias("known"), F.first("size").alias("size"), F.first("width").alias("width")).where("known = size")
    prefix = prefix.select("item", "words", F.col("p.shingle").alias("shingle"), F.col("p.at").alias("at"), "width")
    start = F.col("place") - F.col("at")
    candidates = held.join(prefix, "shingle").where((start >= 0) & (start + F.col("width") <= F.col("last")))
    candidates = candidates.groupBy("row").agg(F.collect_set(F.struct("item", start.alias("start"), "words")).alias("found"))

    own = df.columns
    both = rows.join(candidates.withColumnRenamed("row", "__id"), "__id", "left").drop("__id").withColumnRenamed("found", "__found")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            verdicts = []
            names = batch.schema.names
            for t, found in zip(batch.column(names.index(text)).to_pylist(), batch.column(names.index("__found")).to_pylist(), strict=True):
                ws, spans, hits = words(t), set(), set()
                for c in found or []:
                    window = c["words"].split(b" ")
                    if ws[c["start"] : c["start"] + len(window)] == window:
                        spans.add((c["start"], c["start"] + len(window)))
                        hits.add(c["item"])
                verdicts.append(_verdict(ws, list(spans), hits, share))
            yield _appended(batch, own, verdicts)

    return both.mapInArrow(verify, _with_results(df.schema))

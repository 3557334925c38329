"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct word shingles. Each set is turned into a bit sketch by toggling (XOR) one
bit per shingle; a shingle in both sets toggles the same bit, so the Hamming distance of two sketches never
exceeds the symmetric difference of the sets. Two sets of sizes a and b with Jaccard >= j differ in at most
``d = (a + b) * (1 - j) / (1 + j)`` shingles.

Pigeonhole join: the documents of a size band cut their sketches into the same ``n > d`` segments. Similar
sets agree in at least ``m = n - d`` of them, so a document may leave out its segments of at most t set bits if
it has fewer than m of those: some segment that says more is then still common. That keeps near-empty segments,
which agree by chance, out of the join without losing a pair. Sizes of a pair lie in one band or in two that
adjoin; documents near the upper border take part in the next band too.

Work on large groups: rows with equal sets are one class, and a map task emits a class once. Each batch of keys
sends the smallest and largest row of a key, so a key that very many sets have is a few rows when its smallest
member is found; the members then meet that one row in a join which Spark can split. In each bucket all members
are first verified against the smallest one; only what that leaves in different components is compared with each
other, behind the Hamming bound of a folded sketch, and verified on the sets.

Counting links: both ends of a link lie in one component. The classes of a component are compared all with all,
by size bands and in blocks of at most about ``LINK_SETS`` classes, and a link counts once for each document that
has the other text. Each pair of blocks is a group of its own, so a large component is spread over the tasks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, discard, materialize, scratch
from .components import connected_components
from .lookup import bitmap_filter
from .spans import mix, word_hashes

#: Growth of the size bands; bits of a segment; bits of the folded sketch (as 64-bit words).
BAND_GROWTH = Fraction(3, 2)
SEGMENT_BITS = 12
FOLDED_WORDS = 16
#: Characters that are hashed together; keys of a batch; classes that a task remembers; pairs to which a set goes once.
BATCH_CHARS = 1 << 20
BATCH_KEYS = 1 << 20
CLASSES_SEEN = 200_000
STAR_BLOCK = 256
#: Classes and shingles of a block in which links are counted; shingles that are multiplied at a time.
LINK_SETS, LINK_SHINGLES, LINK_CHUNK = 256, 1_000_000, 4096
#: Rows of an Arrow batch: each may hold a whole text or two sets.
ARROW_ROWS = 400

_MASK = (1 << 64) - 1
_PRIME = 0x9E3779B97F4A7C15


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """For each text the sorted distinct 48-bit hashes of its ``size``-word shingles; fewer words are one shingle.

    Words are lower-cased (A-Z) and separated by 0x20 and 0x09 to 0x0D only.
    """
    hashes, counts = word_hashes(texts)
    total = np.full(max(0, len(hashes) - size + 1), size, np.uint64)
    for k in range(size):
        total = total * np.uint64(_PRIME) + hashes[k : k + len(total)]
    total = mix(total) >> np.uint64(16)
    out = []
    at = 0
    for n in counts.tolist():
        if n >= size:
            out.append(np.unique(total[at : at + n - size + 1]))
        elif n:
            one = np.full(1, n, np.uint64)
            for h in hashes[at : at + n]:
                one = one * np.uint64(_PRIME) + h
            out.append(mix(one) >> np.uint64(16))
        else:
            out.append(np.empty(0, np.uint64))
        at += n
    return out


def shingle_set(text: str | None, size: int) -> np.ndarray:
    return shingle_sets([text], size)[0]


def _to_bytes(s: np.ndarray) -> bytes:
    return s.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_bytes(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(b, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def folded(s: np.ndarray) -> bytes:
    """The sketch of FOLDED_WORDS * 64 bits."""
    bits = np.bincount((s % np.uint64(FOLDED_WORDS * 64)).astype(np.int64), minlength=FOLDED_WORDS * 64) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


class Bands:
    """Size bands and the segments of each for a Jaccard threshold."""

    def __init__(self, threshold: Fraction):
        self.j = threshold
        self.differ = (1 - threshold) / (1 + threshold)
        self.lows = [1]
        while self.lows[-1] < 1 << 40:
            self.lows.append(max(self.lows[-1] + 1, int(-(-self.lows[-1] * BAND_GROWTH.numerator // BAND_GROWTH.denominator))))
        if 1 / threshold > BAND_GROWTH:
            raise ValueError("the threshold is too low for these bands")
        self._lows = np.array(self.lows)

    def of(self, size: int) -> list[int]:
        """The bands in which a set of this size takes part."""
        band = int(np.searchsorted(self._lows, size, "right")) - 1
        return [band, band + 1] if int(size / self.j) >= self.lows[band + 1] else [band]

    def plan(self, band: int, size: int) -> tuple[int, int]:
        """(segments, segments in which a set of this size and any similar one agree at least)."""
        high = self.lows[band + 1] - 1
        most = int(2 * high * self.differ)
        segments = most + 1 + most // 4
        return segments, segments - int((size + min(int(size / self.j), high)) * self.differ)

    def keys(self, s: np.ndarray) -> list[np.ndarray]:
        """Join keys of a sorted set of 48-bit hashes."""
        out = []
        for band in self.of(len(s)):
            n, agree = self.plan(band, len(s))
            high = self.lows[band + 1] - 1
            if int((len(s) + min(int(len(s) / self.j), high)) * self.differ) == 0:
                continue  # only an equal set is similar, and those are one class already
            # Places in the sketch, ascending with the hash; a place hit an even number of times is not set.
            scale = np.uint64(n << SEGMENT_BITS)
            place = ((s >> np.uint64(20)) * scale) >> np.uint64(28)
            runs = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
            odd = np.diff(np.append(runs, len(place))) & 1 == 1
            place = place[runs[odd]]
            segment = place >> np.uint64(SEGMENT_BITS)
            starts = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1]))) if len(place) else np.empty(0, np.int64)
            bits = np.diff(np.append(starts, len(place)))
            word = np.bitwise_xor.reduceat(mix(place + np.uint64(1)), starts) if len(place) else np.empty(0, np.uint64)
            at = segment[starts] if len(place) else np.empty(0, np.uint64)
            empty = n - len(starts)
            if empty + int((bits == 1).sum()) < agree:
                keep = bits > 1
                at, word = at[keep], word[keep]
            elif empty >= agree:
                gone = np.setdiff1d(np.arange(n, dtype=np.uint64), at)
                at, word = np.concatenate([at, gone]), np.concatenate([word, np.zeros(len(gone), np.uint64)])
            out.append(mix(word ^ mix(at + np.uint64((band + 1) * _PRIME & _MASK))) >> np.uint64(20))
        return out


def shingle_table(df: DataFrame, size: int, key: str, text: str) -> DataFrame:
    """``row, doc, n, class, folded, shingles``: ``row`` numbers the rows, the class is a digest of the set, null if empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
        for batch in batches:
            texts: list[str | None] = []
            held = done = 0
            for k, t in enumerate(batch.column(1).to_pylist(), 1):
                texts.append(t)
                held += len(t or "")
                if held >= BATCH_CHARS or k == batch.num_rows:
                    rows = []
                    for s in shingle_sets(texts, size):
                        data = _to_bytes(s)
                        rows.append((len(s), hashlib.blake2b(data, digest_size=16).digest() if len(s) else None, folded(s), data))
                    cols = [pa.array(np.arange(row, row + len(rows))), batch.column(0).slice(done, len(rows)), *(pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True))]
                    yield pa.RecordBatch.from_arrays(cols, ["row", "doc", "n", "class", "folded", "shingles"])
                    row += len(rows)
                    done += len(rows)
                    texts, held = [], 0

    return df.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text")).mapInArrow(run, "row long, doc long, n long, class binary, folded binary, shingles binary")


def segment_keys(live: DataFrame, threshold: Fraction, combined: bool) -> DataFrame:
    """``key, row``: the join keys of the sets; of the rows of one class a task emits the first only.

    ``combined``: ``key, low, high``, the smallest and largest row that has the key, put together for each batch of
    keys, so that a key which a large part of all sets has sends one row a batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(threshold), set()
        keys: list[np.ndarray] = []
        rows: list[np.ndarray] = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal keys, rows, held
            key, row = np.concatenate(keys).astype(np.int64), np.concatenate(rows)
            keys, rows, held = [], [], 0
            if not combined:
                return pa.RecordBatch.from_arrays([pa.array(key), pa.array(row)], ["key", "row"])
            order = np.lexsort((row, key))
            key, row = key[order], row[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            return pa.RecordBatch.from_arrays([pa.array(key[first]), pa.array(row[first]), pa.array(row[np.append(first[1:], len(key)) - 1])], ["key", "low", "high"])

        for batch in batches:
            for row, cls, data in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if cls in seen:
                    continue
                if len(seen) < CLASSES_SEEN:
                    seen.add(cls)
                for k in bands.keys(_from_bytes(data)):
                    keys.append(k)
                    rows.append(np.full(len(k), row, np.int64))
                    held += len(k)
                if held >= BATCH_KEYS:
                    yield close()
        if held:
            yield close()

    return live.select("row", "class", "shingles").mapInArrow(run, "key long, low long, high long" if combined else "key long, row long")


def _sketches(sets: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """``name, n, w0, w1, ...``: size and folded sketch, in half words, of the rows in ``ids``."""
    words = (F.conv(F.hex(F.substring("folded", 4 * k + 1, 4)), 16, 10).cast("long").alias(f"w{k}") for k in range(2 * FOLDED_WORDS))
    return bitmap_filter(sets.select("row", "n", "folded"), "row", ids).select(F.col("row").alias(name), "n", *words)


def _may_be_similar(x: str, y: str, threshold: Fraction) -> Column:
    """The Hamming distance of two folded sketches is within what the sizes allow."""
    differ = (1 - threshold) / (1 + threshold)
    distance = reduce(lambda a, b: a + b, (F.bit_count(F.col(f"{x}.w{k}").bitwiseXOR(F.col(f"{y}.w{k}"))) for k in range(2 * FOLDED_WORDS)))
    return distance * differ.denominator <= (F.col(f"{x}.n") + F.col(f"{y}.n")) * differ.numerator


def verified(pairs: DataFrame, sets: DataFrame, threshold: Fraction) -> DataFrame:
    """The pairs ``a, b`` of rows whose sets have the Jaccard similarity.

    A set that many pairs have as their first goes once to each block of about ``STAR_BLOCK`` of them.
    """
    uses = pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR_BLOCK).alias("blocks"))
    cut = pairs.join(uses, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("blocks")).alias("block"))
    few = sets.select("row", "shingles")
    heads = cut.select("a", "block").distinct().join(bitmap_filter(few, "row", pairs.select("a").distinct()).toDF("a", "set_a"), "a")
    members = cut.join(bitmap_filter(few, "row", pairs.select("b").distinct()).toDF("b", "set_b"), "b")
    both = members.join(heads, ["a", "block"])
    p, q = threshold.numerator, threshold.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                s, t = _from_bytes(x), _from_bytes(y)
                common = len(np.intersect1d(s, t, assume_unique=True))
                links.append(q * common >= p * (len(s) + len(t) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(links, pa.bool_()))

    return both.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def common_shingles(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of ``left`` has in common with each of ``right``."""
    sets = left + right
    _, value, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    number = np.cumsum(uses > 1) - 1
    several = uses[value] > 1
    value, owner = number[value[several]], owner[several]
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    out = np.zeros((len(left), len(right)), np.int64)
    for low in range(0, int(value[-1]) + 1 if len(value) else 0, LINK_CHUNK):
        at = slice(*np.searchsorted(value, [low, low + LINK_CHUNK]))
        has = np.zeros((len(sets), int(value[at][-1]) - low + 1), np.float32)
        has[owner[at], value[at] - low] = 1
        out += np.rint(has[: len(left)] @ has[len(left) :].T).astype(np.int64)
    return out


def links_between_classes(component: DataFrame, weight: DataFrame, live: DataFrame, threshold: Fraction) -> DataFrame:
    """``node, links``: how many documents have a similar text of another class, for the classes in ``component``.

    Sizes of a pair lie in one band or in two that adjoin. A component that fits a block is one group; of a larger
    one each pair of blocks is a group, to which a class goes once.
    """
    step = -math.log(threshold) * 1.001  # a little more than the ratio of sizes, against rounding
    band = F.floor(F.log("n") / step).cast("int").alias("band")
    named = component.withColumnRenamed("node", "id")
    size = bitmap_filter(live, "id", named.select("id")).select("id", "n", band).join(named, "id")
    size = size.groupBy("component", "band").agg(F.count("*").alias("m"), F.sum("n").alias("held"))
    blocks = F.greatest(F.ceil(F.col("m") / LINK_SETS), F.ceil(F.col("held") / LINK_SHINGLES)).cast("int")
    large = size.groupBy("component").agg(F.sum("m").alias("m"), F.sum("held").alias("held"), F.map_from_entries(F.collect_list(F.struct("band", blocks))).alias("blocks"))
    large = materialize(large.where((F.col("m") > LINK_SETS) | (F.col("held") > LINK_SHINGLES)).select("component", "blocks"), "large-components")

    sets = bitmap_filter(live, "id", named.select("id")).select("id", "n", band, "shingles").join(named, "id").join(weight.withColumnRenamed("node", "id"), "id")
    sets = sets.join(large, "component", "left")
    here, none = F.col("blocks")[F.col("band")], F.array().cast("array<struct<b0:int,i0:int,b1:int,i1:int,side:int>>")
    cell = lambda b0, i0, b1, i1, side: F.struct(*(x.cast("int").alias(k) for x, k in zip((b0, i0, b1, i1, side), ("b0", "i0", "b1", "i1", "side"), strict=True)))
    b, i, zero = F.col("band"), F.col("block"), F.lit(0)
    each = lambda n, f: F.when(n.isNotNull(), F.transform(F.sequence(zero, n - 1), f)).otherwise(none)
    cells = F.concat(
        each(here, lambda j: cell(b, F.least(i, j), b, F.greatest(i, j), (i > j).cast("int"))),
        each(F.try_element_at("blocks", b + 1), lambda j: cell(b, i, b + 1, j, zero)),
        each(F.try_element_at("blocks", b - 1), lambda j: cell(b - 1, j, b, i, F.lit(1))),
    )
    sets = sets.withColumn("block", F.pmod(F.xxhash64("id"), F.coalesce(here, F.lit(1))).cast("int"))
    sets = sets.withColumn("cell", F.explode(F.when(F.col("blocks").isNull(), F.array(cell(zero, zero, zero, zero, zero))).otherwise(cells)))
    p, q = threshold.numerator, threshold.denominator

    def count(table: pa.Table) -> pa.Table:
        ids, weights, side = (table.column(k).to_numpy() for k in ("id", "weight", "side"))
        data = [_from_bytes(x) for x in table.column("shingles").to_pylist()]
        n = np.array([len(s) for s in data])
        inside = all(table.column(x)[0] == table.column(y)[0] for x, y in (("b0", "b1"), ("i0", "i1")))
        left, right = (np.arange(len(ids)),) * 2 if inside else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
        if not len(left) or not len(right):
            return pa.table({"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
        common = common_shingles([data[k] for k in left], [data[k] for k in right])
        link = q * common >= p * (n[left][:, None] + n[right][None, :] - common)
        if inside:
            np.fill_diagonal(link, False)
            return pa.table({"node": ids, "links": link @ weights})
        return pa.table({"node": np.concatenate([ids[left], ids[right]]), "links": np.concatenate([link @ weights[right], weights[left] @ link])})

    cut = sets.select("component", "cell.*", "id", "weight", "shingles")
    found = cut.groupBy("component", "b0", "i0", "b1", "i1").applyInArrow(count, "node long, links long")
    return found.groupBy("node").agg(F.sum("links").alias("links"))


def jaccard_components(df: DataFrame, threshold: Fraction = Fraction(4, 5), size: int = 5, key: str = "doc_id", text: str = "text", count_links: bool = True) -> DataFrame:
    """``key, n_shingles, component_id, n_links``: one row for each row of ``df``.

    ``component_id`` is the smallest key reachable by links, ``n_links`` the number of other documents whose set has
    the similarity with the row's, equal ones included (a document with several texts counts once a text); without
    ``count_links`` it is left out. Empty and null texts have no shingles and link with nothing. Rows that share a
    key count as one document, so they share a component; a row with a null key links with nothing and has a null
    component. Repeated rows stay. The rows are written; all other tables on the way to them are deleted.
    """
    with arrow_rows(df.sparkSession, ARROW_ROWS), scratch(df.sparkSession) as keep:
        return keep(materialize(_components(df, threshold, size, key, text, count_links), "components"))


def _same_document(member: DataFrame) -> DataFrame:
    """``a, b``: the classes of a document's texts hang on the smallest of them."""
    several = member.groupBy("doc").agg(F.min("rep").alias("a"), F.max("rep").alias("last")).where("a < last").select("doc", "a")
    return member.join(several, "doc").where("rep > a").select("a", F.col("rep").alias("b")).distinct()


def _components(df: DataFrame, threshold: Fraction, size: int, key: str, text: str, count_links: bool) -> DataFrame:
    sets = materialize(shingle_table(df, size, key, text), "shingles")
    live = sets.where("n > 0 and doc is not null")
    # A class stands under its smallest row; classes are the nodes.
    rep = materialize(live.groupBy("class").agg(F.min("row").alias("rep")), "classes")
    member = materialize(live.select("row", "doc", "class").join(rep, "class").select("row", "doc", "rep"), "members")

    shared = segment_keys(live, threshold, True).groupBy("key").agg(F.min("low").alias("centre"), F.max("high").alias("last")).where("centre < last")
    shared = materialize(shared.select("key", "centre"), "shared-keys")
    # The smallest row of a key is its class's smallest row: a task emits the first row of a class at least.
    held = segment_keys(live, threshold, False).join(shared, "key").where("row > centre")
    buckets = held.join(member.select("row", "rep"), "row").where("rep > centre").select("key", "rep", "centre").distinct()
    buckets = materialize(buckets, "buckets")
    discard(shared)

    stars = buckets.select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    x, y = _sketches(live, stars.select("a"), "a").alias("x"), _sketches(live, stars.select("b"), "b").alias("y")
    close = stars.alias("p").join(x, F.col("p.a") == F.col("x.a")).join(y, (F.col("p.b") == F.col("y.b")) & _may_be_similar("x", "y", threshold))
    close = materialize(close.select("p.a", "p.b"), "star-pairs")
    links = materialize(verified(close, live, threshold).union(_same_document(member)), "star-links")
    component = connected_components(links)

    # Members of a bucket that are left in different components are compared with each other.
    found = buckets.join(component.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", F.coalesce("component", "rep").alias("component"))
    mixed = found.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    open_ = found.join(mixed, "key")
    half = materialize(open_.join(_sketches(live, open_.select("rep"), "rep"), "rep"), "open-segments")
    x, y = half.alias("x"), half.alias("y")
    apart = (F.col("x.rep") < F.col("y.rep")) & (F.col("x.component") != F.col("y.component"))
    pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & apart & _may_be_similar("x", "y", threshold))
    pairs = materialize(pairs.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct(), "open-pairs")
    more = materialize(verified(pairs, live, threshold), "open-links")
    component = connected_components(links.union(more)) if not more.isEmpty() else component

    node = F.coalesce("component", "rep").alias("node")
    placed = member.join(component.withColumnRenamed("node", "rep"), "rep", "left").select("row", "doc", "rep", node)
    # Written, so that the join below stands alone in its stage and Spark can split a large component.
    least = materialize(placed.groupBy("node").agg(F.min("doc").alias("component_id")), "component-ids")
    named = placed.join(least, "node").select("row", "component_id")
    out = sets.select("row", "doc", "n").join(named, "row", "left")
    columns = [F.col("doc").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc").alias("component_id")]
    if not count_links:
        return out.select(*columns)

    weight = member.select("rep", "doc").distinct().groupBy("rep").agg(F.count("*").alias("weight")).withColumnRenamed("rep", "node")
    count = weight.join(links_between_classes(component, weight, live.withColumnRenamed("row", "id"), threshold), "node", "left")
    # Written, so that the join of a class's rows stands alone in its stage.
    count = materialize(count.select(F.col("node").alias("rep"), (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "class-links")
    # What a document's own other texts add is taken off again.
    own = member.select("doc", "rep").distinct()
    several = own.groupBy("doc").agg(F.count("*").alias("texts")).where("texts > 1").select("doc")
    own = own.join(several, "doc")
    twins = materialize(own.withColumnRenamed("rep", "a").join(own.withColumnRenamed("rep", "b"), "doc").where("a < b"), "own-texts")
    like = twins.join(verified(twins.select("a", "b").distinct(), live, threshold), ["a", "b"])
    less = like.select("doc", F.explode(F.array("a", "b")).alias("rep")).groupBy("doc", "rep").agg(F.count("*").alias("less"))
    linked = member.join(count, "rep").join(less, ["doc", "rep"], "left").select("row", (F.col("n_links") - F.coalesce("less", F.lit(0))).alias("n_links"))
    columns.append(F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return out.join(linked, "row", "left").select(*columns)

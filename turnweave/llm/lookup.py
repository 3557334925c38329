"""A semi-join prefilter of fixed size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the bitmap: 256 KB, whatever the input.
BITS = 1 << 21


def bitmap_filter(df: DataFrame, column: str, ids: DataFrame, bits: int = BITS, outside: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``column`` may be in ``ids`` (one column): a join with ``ids`` must follow.

    ``outside``: all other rows, whose ``column`` is surely not in ``ids``.

    The ids set bits of a bitmap of ``bits`` bits, which is broadcast (at most ``bits / 64`` rows); a large
    table is thus thinned out before it is shuffled. With very many ids it lets more through, never less.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    word = ids.select(place(F.col(ids.columns[0])).alias("p")).groupBy(F.shiftright("p", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("mask"))
    marked = df.withColumn("__p", place(F.col(column)))
    hit = F.shiftright("__p", 6) == F.col("word")
    return marked.join(F.broadcast(word), hit & (F.getbit("mask", (F.col("__p").bitwiseAND(F.lit(63))).cast("int")) == 1), "left_anti" if outside else "left_semi").drop("__p")

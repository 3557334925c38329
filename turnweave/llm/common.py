"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..store import discard, gather, materialize, scratch, shared_dir

__all__ = ["arrow_rows", "discard", "gather", "let", "materialize", "original", "own_columns", "scratch", "shared_dir", "space_chunks", "table", "tasks"]


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table of ``sf_dir``, cut down to ``columns`` so that clashing extra columns never matter."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most so many rows in the actions inside, where a row may be large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def tasks(spark: SparkSession) -> int:
    """How many shuffle partitions the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it in ``body`` (a lambda over a column).

    A higher-order function evaluates an outer expression again for each element; a bound lambda variable
    is evaluated once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def own_columns(df: DataFrame, *names: str) -> DataFrame:
    """The columns ``names`` (null where ``df`` lacks one) and a struct ``__row`` of all others.

    What an operator adds can then clash with none of them; ``original`` puts them back.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c not in names]
    own = [F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string").alias(c) for c in names]
    return df.select(*own, F.struct(*rest, F.lit(0).alias("__any")).alias("__row"))


def original(df: DataFrame, columns: list[str], *names: str) -> DataFrame:
    """The columns that ``own_columns`` took aside for these names, in their order."""
    return df.select(*(F.col(c) if c in names else F.col(f"__row.`{c}`") for c in columns))


_ODD_SPACE = re.compile(r" \s|\s |^ | $")
_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def space_chunks(text: str) -> list[str]:
    """The text cut at each single space that stands between two characters that are not white space."""
    return _LONE_SPACE.split(text) if _ODD_SPACE.search(text) else text.split(" ")

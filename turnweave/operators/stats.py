"""Counts of what was read and built."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .restrictions import restrictions
from .ways import road_ways


def ingest_stats(nodes: DataFrame, ways: DataFrame, relations: DataFrame) -> DataFrame:
    """One row: nodes, ways and their references, used ways and theirs, relations, used relations, mean sizes."""
    of = lambda df, *columns: df.agg(*columns)
    refs = F.coalesce(F.sum(F.size("refs")), F.lit(0)).cast("long")
    n = of(nodes, F.count("*").alias("nodes"))
    w = of(ways, F.count("*").alias("ways"), refs.alias("refs"), F.avg(F.size("refs")).alias("avg_way_size"))
    u = of(road_ways(ways), F.count("*").alias("used_ways"), refs.alias("used_refs"), F.avg(F.size("refs")).alias("avg_used_way_size"))
    r = of(relations, F.count("*").alias("relations"))
    t = of(restrictions(relations), F.count("*").alias("used_relations"))
    out = n
    for one in (w, u, r, t):  # each is a single row
        out = out.join(one)
    return out


def graph_stats(edges: DataFrame, turns: DataFrame) -> DataFrame:
    """One row: directed edges, border segments and their nodes, pixels, turns."""
    e = edges.agg(
        F.count("*").alias("edges"), F.count_if(F.col("is_border") & ~F.col("rev")).alias("border_segments"),
        (2 * F.count_if(F.col("is_border") & ~F.col("rev"))).alias("border_nodes"), F.count_distinct("src_pix").alias("pixels"),
    )
    return e.join(turns.agg(F.count("*").alias("turns")))

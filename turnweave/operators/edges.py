"""Ways cut at junctions into directed edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import let, line_length_km
from .ways import way_refs

#: What identifies a directed edge.
KEY = ("way_id", "seg", "rev")


def way_points(roads: DataFrame, used: DataFrame) -> DataFrame:
    """``way_id, oneway, points``: the nodes of each way in order, with position, use and pixel."""
    found = way_refs(roads).join(used, "node_id")
    points = found.groupBy("way_id").agg(F.array_sort(F.collect_list(F.struct("pos", "node_id", "lat", "lon", "used", "ipix"))).alias("points"))
    return points.join(roads.select("way_id", "oneway"), "way_id")


def way_segments(points: DataFrame) -> DataFrame:
    """``way_id, oneway, seg, part``: a way cut at its junctions, both ends of a part included."""

    def cut(p):
        at = F.filter(F.sequence(F.lit(0), F.size(p) - 1), lambda i: (i == 0) | (F.get(p, i)["used"] > 1))
        return let(at, lambda b: F.when(F.size(b) > 1, F.transform(F.sequence(F.lit(0), F.size(b) - 2), lambda k: F.slice(p, F.get(b, k) + 1, F.get(b, k + 1) - F.get(b, k) + 1))))

    parts = let(F.col("points"), cut)
    return points.where(F.size("points") > 1).select("way_id", "oneway", F.posexplode(parts).alias("seg", "part"))


def segment_costs(segments: DataFrame) -> DataFrame:
    """Adds ``cost``: the great-circle length in km, added up from the first point on."""
    return segments.withColumn("cost", line_length_km(F.col("part")))


def directed_edges(segments: DataFrame) -> DataFrame:
    """Each segment forward and, unless its way is one-way, in reverse.

    ``way_id, seg, rev, was_one_way, src_node, tgt_node, src_pix, tgt_pix, is_border, src, tgt, geom, cost``
    where ``src`` and ``tgt`` are the end points.
    """
    both = F.explode(F.when(F.col("oneway"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True))))
    out = segment_costs(segments).select("way_id", "seg", "oneway", "cost", "part", both.alias("rev"))
    out = out.withColumn("p", F.when(F.col("rev"), F.reverse("part")).otherwise(F.col("part")))
    first, last = F.get("p", F.lit(0)), F.get("p", F.size("p") - 1)
    spot = lambda x: F.struct(x["lat"].alias("lat"), x["lon"].alias("lon"))
    return out.select(
        "way_id", "seg", "rev", F.col("oneway").alias("was_one_way"), first["node_id"].alias("src_node"), last["node_id"].alias("tgt_node"),
        first["ipix"].alias("src_pix"), last["ipix"].alias("tgt_pix"), (first["ipix"] != last["ipix"]).alias("is_border"),
        spot(first).alias("src"), spot(last).alias("tgt"), F.transform("p", spot).alias("geom"), "cost",
    )


def edge_geometry(edges: DataFrame) -> DataFrame:
    """``way_id, seg, rev, i, lat, lon``."""
    return edges.select(*KEY, F.posexplode("geom").alias("i", "p")).select(*KEY, "i", "p.lat", "p.lon")


def border_summary(edges: DataFrame) -> DataFrame:
    """``src_pix, tgt_pix, n_edges`` of the edges that leave their pixel."""
    return edges.where("is_border").groupBy("src_pix", "tgt_pix").agg(F.count("*").alias("n_edges"))


def out_degree(edges: DataFrame) -> DataFrame:
    """``src_node, n``."""
    return edges.groupBy("src_node").agg(F.count("*").alias("n"))


def out_edges(edges: DataFrame) -> DataFrame:
    """``src_node, edges``: the adjacency list."""
    return edges.groupBy("src_node").agg(F.array_sort(F.collect_list(F.struct(*KEY, "tgt_node"))).alias("edges"))

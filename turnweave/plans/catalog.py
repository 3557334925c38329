"""Registered queries on the road network that is derived from the order tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import line_length_km
from ..operators import edges as edge_ops
from ..operators import export, restrictions, stats, turns, ways
from ..sources import derived, osmpbf
from . import oracle
from .pipeline import RoadGraph, build

KEY, TURN = edge_ops.KEY, turns.TURN


def _graph(spark: SparkSession, d: str) -> RoadGraph:
    """Every reference of the derived network has a node."""
    return build(derived.nodes(spark, d), derived.ways(spark, d), derived.relations(spark, d), on_missing="skip")


def _edges(spark: SparkSession, d: str) -> DataFrame:
    """A single use: not stored."""
    return edge_ops.directed_edges(_segments(spark, d))


def _roads(spark: SparkSession, d: str) -> DataFrame:
    return ways.road_ways(derived.ways(spark, d))


def _refs(spark: SparkSession, d: str) -> DataFrame:
    return ways.way_refs(_roads(spark, d))


def _usage(spark: SparkSession, d: str) -> DataFrame:
    return ways.node_usage(_refs(spark, d))


def _used(spark: SparkSession, d: str) -> DataFrame:
    return ways.used_nodes(derived.nodes(spark, d), _usage(spark, d))


def _segments(spark: SparkSession, d: str) -> DataFrame:
    return edge_ops.way_segments(edge_ops.way_points(_roads(spark, d), _used(spark, d)))


def _rules(spark: SparkSession, d: str) -> DataFrame:
    return restrictions.restrictions(derived.relations(spark, d))


def _valid(spark: SparkSession, d: str) -> DataFrame:
    return restrictions.valid_mandatory(_rules(spark, d), _edges(spark, d))


def ways_highway_filter(spark, d):
    return _roads(spark, d).select("way_id", "highway")


def ways_oneway_flag(spark, d):
    return _roads(spark, d).select("way_id", "oneway")


def coord_scale(spark, d):
    return derived.nodes(spark, d)


def delta_decode_refs(spark, d):
    """References as differences, and back."""
    coded = derived.ways(spark, d).select("way_id", F.transform("refs", lambda x, i: x - F.when(i > 0, F.get("refs", i - 1)).otherwise(0)).alias("deltas"))
    return coded.select("way_id", F.posexplode(osmpbf.undelta(F.col("deltas"))).alias("pos", "node_id"))


def ref_endpoints(spark, d):
    return _refs(spark, d)


def node_usage(spark, d):
    return _usage(spark, d)


def used_nodes(spark, d):
    return _used(spark, d).drop("ipix")


def junctions(spark, d):
    return ways.junctions(_usage(spark, d))


def dangling_refs(spark, d):
    """The network without a part of its nodes, as a broken extract would be."""
    return ways.dangling_refs(_refs(spark, d), derived.nodes(spark, d).where("node_id % 97 <> 0"))


def healpix_pixels(spark, d):
    return _used(spark, d).select("node_id", "ipix")


def pixel_counts(spark, d):
    return _used(spark, d).groupBy("ipix").agg(F.count("*").alias("n"))


def way_segments(spark, d):
    p = F.col("part")
    return _segments(spark, d).select("way_id", "seg", F.get(p, F.lit(0))["node_id"].alias("src_node"), F.get(p, F.size(p) - 1)["node_id"].alias("tgt_node"), F.size(p).alias("n_points"))


def segment_cost(spark, d):
    return edge_ops.segment_costs(_segments(spark, d)).select("way_id", "seg", F.round("cost", 6).alias("cost"))


def directed_edges(spark, d):
    return _edges(spark, d).select(*KEY, "was_one_way", "src_node", "tgt_node", "src_pix", "tgt_pix", "is_border")


def edge_geometry(spark, d):
    return edge_ops.edge_geometry(_edges(spark, d))


def border_summary(spark, d):
    return edge_ops.border_summary(_edges(spark, d))


def out_degree(spark, d):
    return edge_ops.out_degree(_edges(spark, d))


def restriction_members(spark, d):
    return restrictions.restriction_members(derived.relations(spark, d)).select("rel_id", "from_way", "via_node", "to_way")


def restriction_codes(spark, d):
    return _rules(spark, d).select("rel_id", F.col("type").cast("int").alias("type"))


def no_restriction_pairs(spark, d):
    return restrictions.forbidden_pairs(_rules(spark, d))


def only_restrictions_valid(spark, d):
    return _valid(spark, d).select("from_way", "via_node", "to_way")


def mandatory_conflicts(spark, d):
    return restrictions.mandatory_turns(_valid(spark, d)).where("n_to > 1").select("from_way", "via_node", "n_to")


def adjacency_pairs(spark, d):
    return turns.adjacency(_edges(spark, d)).select(*TURN, "scope")


def uturn_filtered(spark, d):
    return turns.without_u_turns(turns.adjacency(_edges(spark, d))).select(*TURN)


def turns_no_only(spark, d):
    g = _graph(spark, d)
    return turns.free_turns(g.edges, g.mandatory, g.forbidden).select(*TURN)


def turns_mandatory(spark, d):
    g = _graph(spark, d)
    return turns.mandatory_turns(g.edges, g.mandatory, g.forbidden).select(*TURN)


def turns_all(spark, d):
    return _graph(spark, d).turns.select(*TURN, F.round("weight", 6).alias("weight"))


def edge_midpoint(spark, d):
    return export.edge_midpoints(_edges(spark, d)).select(*KEY, "idx", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


def line_length(spark, d):
    points = edge_ops.way_points(_roads(spark, d), _used(spark, d))
    return points.select("way_id", F.round(line_length_km(F.col("points")), 6).alias("km"))


def turn_geometry(spark, d):
    g = _graph(spark, d)
    out = export.turn_geometry(g.edges, g.mandatory, g.forbidden)
    end = lambda i, c: F.round(F.get("geom", i)[c], 6)
    last = F.size("geom") - 1
    return out.select(*TURN, F.size("geom").alias("n_points"), end(F.lit(0), "lat").alias("first_lat"), end(F.lit(0), "lon").alias("first_lon"), end(last, "lat").alias("last_lat"), end(last, "lon").alias("last_lon"))


def turn_csv(spark, d):
    return _graph(spark, d).csv


def ingest_stats(spark, d):
    out = stats.ingest_stats(derived.nodes(spark, d), derived.ways(spark, d), derived.relations(spark, d))
    return out.withColumns({c: F.round(c, 6) for c in ("avg_way_size", "avg_used_way_size")})


def graph_stats(spark, d):
    g = _graph(spark, d)
    return stats.graph_stats(g.edges, g.turns)


_ALL = (
    ways_highway_filter, ways_oneway_flag, coord_scale, delta_decode_refs, ref_endpoints, node_usage, used_nodes, junctions, dangling_refs,
    healpix_pixels, pixel_counts, way_segments, segment_cost, directed_edges, edge_geometry, border_summary, out_degree, restriction_members,
    restriction_codes, no_restriction_pairs, only_restrictions_valid, mandatory_conflicts, adjacency_pairs, uturn_filtered, turns_no_only,
    turns_mandatory, turns_all, edge_midpoint, line_length, turn_geometry, turn_csv, ingest_stats, graph_stats,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {("line_length_km" if f is line_length else f.__name__): f for f in _ALL}


def oracle_sql() -> dict[str, str]:
    return oracle.sql()

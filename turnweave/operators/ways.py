"""Road ways, their node references and the use of nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import N_SIDE, healpix_ring

#: Supported highway values. Fixed values.
HIGHWAYS = (
    "motorway", "motorway_link", "trunk", "trunk_link", "primary", "primary_link", "secondary", "secondary_link",
    "tertiary", "tertiary_link", "unclassified", "residential", "road",
)
#: Values of the oneway tag that make a way one-way. Fixed values.
ONE_WAY = ("yes", "1")


def road_ways(ways: DataFrame) -> DataFrame:
    """``way_id, highway, oneway, refs`` of the ways that are supported roads.

    Any other oneway value, -1 and reversible among them, leaves a way open in both directions.
    """
    tag = lambda name: F.try_element_at("tags", F.lit(name))
    oneway = F.coalesce(tag("oneway").isin(*ONE_WAY), F.lit(False))
    return ways.where(tag("highway").isin(*HIGHWAYS)).select("way_id", tag("highway").alias("highway"), oneway.alias("oneway"), "refs")


def way_refs(roads: DataFrame) -> DataFrame:
    """``way_id, pos, node_id, is_endpoint``: a way without references yields nothing."""
    out = roads.select("way_id", F.size("refs").alias("n"), F.posexplode("refs").alias("pos", "node_id"))
    return out.select("way_id", "pos", "node_id", ((F.col("pos") == 0) | (F.col("pos") == F.col("n") - 1)).alias("is_endpoint"))


def node_usage(refs: DataFrame) -> DataFrame:
    """``node_id, used``: an end of a way counts twice."""
    return refs.groupBy("node_id").agg(F.sum(F.when(F.col("is_endpoint"), 2).otherwise(1)).cast("long").alias("used"))


def used_nodes(nodes: DataFrame, usage: DataFrame, n_side: int = N_SIDE) -> DataFrame:
    """``node_id, lat, lon, used, ipix``; of nodes that share an id one is taken, the same in every run."""
    place = F.struct(*([c for c in ("file", "seq") if c in nodes.columns] or ["lat", "lon"]))
    wanted = nodes.join(usage, "node_id")  # unused nodes go before the rest is aggregated, on the same key
    one = wanted.groupBy("node_id").agg(F.min_by(F.struct("lat", "lon"), place).alias("p"), F.first("used").alias("used"))
    out = one.select("node_id", "p.lat", "p.lon", "used")
    return out.withColumn("ipix", healpix_ring(F.col("lat"), F.col("lon"), n_side))


def junctions(usage: DataFrame) -> DataFrame:
    return usage.where("used > 1")


def dangling_refs(refs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node_id`` of the references that no node has."""
    return refs.join(nodes, "node_id", "left_anti").select("node_id").distinct()


def checked_roads(roads: DataFrame, nodes: DataFrame, strict: bool = True) -> DataFrame:
    """Roads whose references all have a node; ``strict`` raises if there is any other, else it is dropped."""
    refs = way_refs(roads)
    missing = refs.join(nodes.select("node_id").distinct(), "node_id", "left_anti")
    if strict:
        if (row := missing.select("way_id", "node_id").first()) is not None:
            raise ValueError(f"way {row['way_id']} refers to node {row['node_id']}, which the input lacks")
        return roads
    return roads.join(missing.select("way_id").distinct(), "way_id", "left_anti")

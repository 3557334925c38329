"""The whole plan: nodes, ways and relations to edges and turns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..functions.geo import N_SIDE
from ..operators import edges as edge_ops
from ..operators import restrictions as rule_ops
from ..operators import turns as turn_ops
from ..operators import ways as way_ops
from ..operators.export import csv_rows, write_csv
from ..sources import osmpbf
from ..store import materialize


@dataclass
class RoadGraph:
    """Tables of a network; ``save`` writes what others are made of and ``load`` reads it."""

    nodes: DataFrame
    edges: DataFrame
    restrictions: DataFrame
    mandatory: DataFrame
    forbidden: DataFrame

    @property
    def turns(self) -> DataFrame:
        return turn_ops.turns(self.edges, self.mandatory, self.forbidden)

    @property
    def csv(self) -> DataFrame:
        return csv_rows(self.edges, self.mandatory, self.forbidden)

    def write_csv(self, path: str, single: bool = False) -> None:
        write_csv(self.csv, path, single)

    def save(self, path: str) -> None:
        """Parquet tables; nodes and edges are dealt by pixel, so that a reader of some pixels opens only theirs."""
        self.nodes.write.mode("overwrite").partitionBy("ipix").parquet(f"{path}/nodes")
        self.edges.write.mode("overwrite").partitionBy("src_pix").parquet(f"{path}/edges")
        for name in ("restrictions", "mandatory", "forbidden"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")
        self.turns.write.mode("overwrite").parquet(f"{path}/turns")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> RoadGraph:
        """The network that ``save`` wrote; its turns are joined anew where they are asked for."""
        return cls(*(spark.read.parquet(f"{path}/{name}") for name in ("nodes", "edges", "restrictions", "mandatory", "forbidden")))


def build(nodes: DataFrame, ways: DataFrame, relations: DataFrame, n_side: int = N_SIDE, on_missing: str = "raise", store: bool = True) -> RoadGraph:
    """``on_missing``: what a reference without a node does; ``raise``, ``drop`` its way, or ``skip`` it unchecked.

    ``store``: edges and rules are written to the shared folder once, as all else reads them several times.
    """
    if on_missing not in ("raise", "drop", "skip"):
        raise ValueError("on_missing is raise, drop or skip")
    roads = way_ops.road_ways(ways)
    if on_missing != "skip":
        roads = way_ops.checked_roads(roads, nodes, on_missing == "raise")
    kept = materialize if store else lambda df, _: df
    used = way_ops.used_nodes(nodes, way_ops.node_usage(way_ops.way_refs(roads)), n_side)
    edges = kept(edge_ops.directed_edges(edge_ops.way_segments(edge_ops.way_points(roads, used))), "edges")
    rules = kept(rule_ops.restrictions(relations), "restrictions")
    mandatory = rule_ops.mandatory_turns(rule_ops.valid_mandatory(rules, edges))
    return RoadGraph(used, edges, rules, mandatory, rule_ops.forbidden_pairs(rules))


def build_from_pbf(spark: SparkSession, path: str, **options) -> RoadGraph:
    """Ways that are no roads are left out before their references are decoded."""
    nodes, relations = (osmpbf.read(spark, path, entity) for entity in ("nodes", "relations"))
    ways = osmpbf.read(spark, path, "ways", tag="highway", values=",".join(way_ops.HIGHWAYS))
    return build(nodes, ways, relations, **options)

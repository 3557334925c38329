"""Turns: edges joined with their legal successors.

One equi-join of the edges with themselves on the node between them, for free and for bound edges alike: what a
mandatory restriction demands hangs on the first edge, and whether an edge is the first of its way at its node (the
one candidate that such a restriction tries) hangs on the second, by a window that needs no shuffle of its own. Only
what the rules need goes through the join (keys, end points, cost) and what a caller wants to carry along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .edges import KEY

#: Key columns of a turn: the edge it comes from and the edge it goes to.
TURN = ("from_way", "from_seg", "from_rev", "to_way", "to_seg", "to_rev")
_FROM = {"way_id": "from_way", "seg": "from_seg", "rev": "from_rev", "src_node": "from_source", "tgt_node": "via", "is_border": "from_border", "src": "from_src", "cost": "from_cost", "was_one_way": "was_one_way"}
_TO = {"way_id": "to_way", "seg": "to_seg", "rev": "to_rev", "src_node": "via", "tgt_node": "to_target", "is_border": "to_border", "tgt": "to_tgt", "cost": "to_cost"}


def _renamed(edges: DataFrame, names: dict[str, str], carried: tuple[str, ...] = ()) -> DataFrame:
    return edges.select(*(F.col(a).alias(b) for a, b in names.items()), *carried)


def adjacency(edges: DataFrame) -> DataFrame:
    """All pairs of edges that meet, with ``scope`` of the second."""
    return _renamed(edges, _FROM).join(_renamed(edges, _TO), "via").withColumn("scope", _scope())


def _scope() -> Column:
    return F.when(F.col("to_border"), "border").otherwise("intra")


def is_u_turn() -> Column:
    """The second edge ends where the first began, by coordinates."""
    return (F.col("from_src.lat") == F.col("to_tgt.lat")) & (F.col("from_src.lon") == F.col("to_tgt.lon"))


def without_u_turns(pairs: DataFrame) -> DataFrame:
    return pairs.where(~is_u_turn())


def without_forbidden(pairs: DataFrame, forbidden: DataFrame) -> DataFrame:
    return pairs.join(forbidden, ["from_way", "to_way"], "left_anti")


def ruled_pairs(edges: DataFrame, mandatory: DataFrame, tails: tuple[str, ...] = (), heads: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of edges that meet and that the mandatory restrictions leave; ``bound`` says whether one applied.

    A bound edge goes on to the first edge of the demanded way, one among inner and one among border edges. In
    conflict it is a dead end, and so it is where the demanded way doesn't start at the node. ``tails`` and ``heads``
    are further columns of the first and of the second edge.
    """
    rule = mandatory.select("from_way", F.col("via_node").alias("via"), F.when(F.col("n_to") == 1, F.col("to_way")).alias("must"), F.lit(True).alias("bound"))
    first = _renamed(edges, _FROM, tails).join(rule, ["from_way", "via"], "left").withColumn("bound", F.coalesce("bound", F.lit(False)))
    nth = F.row_number().over(Window.partitionBy("via", "to_way", "to_border").orderBy("to_seg", "to_rev"))
    second = _renamed(edges, _TO, heads).repartition("via").withColumn("nth", nth)
    demanded = F.coalesce((F.col("to_way") == F.col("must")) & (F.col("nth") == 1), F.lit(False))
    return first.join(second, "via").where(~F.col("bound") | demanded).drop("must", "nth")


def legal_pairs(edges: DataFrame, mandatory: DataFrame, forbidden: DataFrame, tails: tuple[str, ...] = (), heads: tuple[str, ...] = ()) -> DataFrame:
    """The ruled pairs that are no U-turn and not forbidden; a second candidate of a mandatory turn is never tried."""
    return without_forbidden(without_u_turns(ruled_pairs(edges, mandatory, tails, heads)), forbidden)


def free_turns(edges: DataFrame, mandatory: DataFrame, forbidden: DataFrame) -> DataFrame:
    """Turns out of edges that no mandatory restriction binds."""
    return legal_pairs(edges, mandatory, forbidden).where("not bound")


def mandatory_turns(edges: DataFrame, mandatory: DataFrame, forbidden: DataFrame) -> DataFrame:
    """Turns that a mandatory restriction demands."""
    return legal_pairs(edges, mandatory, forbidden).where("bound")


def turns(edges: DataFrame, mandatory: DataFrame, forbidden: DataFrame, tails: tuple[str, ...] = (), heads: tuple[str, ...] = ()) -> DataFrame:
    """All legal turns, with ``weight`` (half of both costs) and the nodes around them."""
    weight = ((F.col("from_cost") + F.col("to_cost")) / 2).alias("weight")
    return legal_pairs(edges, mandatory, forbidden, tails, heads).select(*TURN, "was_one_way", "from_source", "via", "to_target", weight, *tails, *heads)

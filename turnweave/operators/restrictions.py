"""Turn restrictions out of relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Supported restriction values and their codes; those under 3 forbid a turn, the others demand it. Fixed values.
CODES = {"no_right_turn": 0, "no_left_turn": 1, "no_straight_on": 2, "only_left_turn": 3, "only_right_turn": 4, "only_straight_on": 5}
MANDATORY_FROM = 3


def _member(role: str, kind: str) -> Column:
    """The last member of a role and type."""
    return F.try_element_at(F.filter("members", lambda m: (m["role"] == role) & (m["type"] == kind)), F.lit(-1))["id"]


def restriction_members(relations: DataFrame) -> DataFrame:
    """``rel_id, kind, from_way, via_node, to_way``: restrictions of exactly three members, all of them there."""
    tagged = relations.withColumn("kind", F.try_element_at("tags", F.lit("restriction"))).where("kind is not null")
    out = tagged.where(F.size("members") == 3).select("rel_id", "kind", _member("from", "WAY").alias("from_way"), _member("via", "NODE").alias("via_node"), _member("to", "WAY").alias("to_way"))
    return out.dropna(subset=["from_way", "via_node", "to_way"])


def restrictions(relations: DataFrame) -> DataFrame:
    """``rel_id, from_way, via_node, to_way, type`` of the supported kinds."""
    members = restriction_members(relations)
    code = F.lit(-1)
    for kind, n in CODES.items():
        code = F.when(F.col("kind") == kind, n).otherwise(code)
    return members.where(F.col("kind").isin(*CODES)).select("rel_id", "from_way", "via_node", "to_way", code.cast("tinyint").alias("type"))


def forbidden_pairs(rules: DataFrame) -> DataFrame:
    """``from_way, to_way``: the node between them plays no part."""
    return rules.where(F.col("type").between(0, MANDATORY_FROM - 1)).select("from_way", "to_way").distinct()


def valid_mandatory(rules: DataFrame, edges: DataFrame) -> DataFrame:
    """``rel_id, from_way, via_node, to_way`` of mandatory restrictions onto a way that has an edge."""
    known = edges.select(F.col("way_id").alias("to_way")).distinct()
    return rules.where(F.col("type") >= MANDATORY_FROM).join(known, "to_way", "left_semi").select("rel_id", "from_way", "via_node", "to_way")


def mandatory_turns(valid: DataFrame) -> DataFrame:
    """``from_way, via_node, to_way, n_to``: one row for a way and node; over one target is a conflict."""
    return valid.groupBy("from_way", "via_node").agg(F.min("to_way").alias("to_way"), F.count_distinct("to_way").alias("n_to"))

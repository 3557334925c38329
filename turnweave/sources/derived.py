"""A road network derived from the order tables by integer arithmetic, for queries, tests and the bench."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ways import HIGHWAYS
from .osmpbf import scale_coordinate

#: Tag values of the derived ways and codes of the derived relations.
HIGHWAY_OF = {"1-URGENT": "motorway", "2-HIGH": "primary", "3-MEDIUM": "residential", "4-NOT SPECIFIED": "footway"}
RESTRICTION_OF = {0: "no_right_turn", 1: "no_left_turn", 2: "no_straight_on", 3: "only_left_turn", 4: "only_right_turn", 5: "only_straight_on", 6: "no_u_turn", 7: "no_right_turn", 8: "no_left_turn"}


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``way_id, pos, node_id``."""
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    lines = _table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    return lines.select((F.col("l_orderkey") + 1).cast("long").alias("way_id"), (F.row_number().over(order) - 1).alias("pos"), (F.col("l_partkey") * 16 + F.col("l_suppkey") % 16 + 1).cast("long").alias("node_id"))


def raw_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``node_id, lat_raw, lon_raw`` in units of 1e-7 degrees (granularity 100)."""
    lines = _table(spark, sf_dir, "lineitem", "l_partkey", "l_suppkey")
    ids = lines.select((F.col("l_partkey") * 16 + F.col("l_suppkey") % 16 + 1).cast("long").alias("node_id")).distinct()
    return ids.select("node_id", (540000000 + (F.col("node_id") * 7919) % 20000 * 1000).alias("lat_raw"), (360000000 + (F.col("node_id") * 104729) % 30000 * 1000).alias("lon_raw"))


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = lambda c: scale_coordinate(F.lit(0).cast("long"), F.lit(100).cast("long"), F.col(c))
    return raw_nodes(spark, sf_dir).select("node_id", scaled("lat_raw").alias("lat"), scaled("lon_raw").alias("lon"))


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``way_id, highway, oneway``."""
    orders = _table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority", "o_orderstatus")
    highway = F.lit(None).cast("string")
    for priority, value in HIGHWAY_OF.items():
        highway = F.when(F.col("o_orderpriority") == priority, value).otherwise(highway)
    oneway = F.when(F.col("o_orderstatus") == "F", "yes").when(F.col("o_orderstatus") == "O", "no").otherwise("-1")
    return orders.select((F.col("o_orderkey") + 1).cast("long").alias("way_id"), highway.alias("highway"), oneway.alias("oneway"))


def ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``way_id, refs, tags``."""
    listed = refs(spark, sf_dir).groupBy("way_id").agg(F.array_sort(F.collect_list(F.struct("pos", "node_id"))).alias("r"))
    tagged = listed.join(tags(spark, sf_dir), "way_id")
    pairs = F.map_from_entries(F.filter(F.array(F.struct(F.lit("highway").alias("k"), F.col("highway").alias("v")), F.struct(F.lit("oneway").alias("k"), F.col("oneway").alias("v"))), lambda x: x["v"].isNotNull()))
    return tagged.select("way_id", F.transform("r", lambda x: x["node_id"]).alias("refs"), pairs.alias("tags"))


def _meetings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Road way and node pairs; ``id, from_way, via_node, to_way, code`` of derived relations."""
    road = tags(spark, sf_dir).where(F.col("highway").isin(*HIGHWAYS)).select("way_id")
    wn = refs(spark, sf_dir).join(road, "way_id").select("way_id", "node_id").distinct()
    a, b = wn.toDF("from_way", "via_node"), wn.toDF("to_way", "n")
    code = (F.col("from_way") * 31 + F.col("to_way") * 17 + F.col("via_node")) % 61
    met = a.join(b, (F.col("via_node") == F.col("n")) & (F.col("from_way") != F.col("to_way"))).drop("n").withColumn("code", code).where("code < 9")
    number = F.row_number().over(Window.orderBy("from_way", "via_node", "to_way"))
    return wn, met.select(number.cast("long").alias("id"), "from_way", "via_node", "to_way", F.col("code").cast("int").alias("code"))


def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rel_id, tags, members``: restrictions, among them some of unsupported type or shape."""
    wn, met = _meetings(spark, sf_dir)
    wrong = F.when((F.col("code") < 3) & (F.col("id") % 7 == 0), F.col("via_node") + 1).otherwise(F.col("via_node"))
    plain = met.select(F.col("id").alias("rel_id"), "from_way", wrong.alias("via_node"), "to_way", "code")
    twice = met.where("code < 3 and id % 5 = 0").select((F.col("id") + 10000000).alias("rel_id"), "from_way", (F.col("via_node") + 1).alias("via_node"), "to_way", "code")
    number = F.row_number().over(Window.orderBy("way_id", "node_id"))
    back = wn.where((F.col("way_id") * 7 + F.col("node_id")) % 53 == 0).select((number + 20000000).cast("long").alias("rel_id"), F.col("way_id").alias("from_way"), F.col("node_id").alias("via_node"), F.col("way_id").alias("to_way"), F.lit(5).alias("code"))
    every = plain.union(twice).union(back)
    member = lambda id_, role, kind: F.struct(F.col(id_).alias("id"), F.lit(role).alias("role"), kind.alias("type"))
    three = F.array(member("from_way", "from", F.lit("WAY")), member("via_node", "via", F.when(F.col("code") == 7, "WAY").otherwise("NODE")), member("to_way", "to", F.lit("WAY")))
    kind = F.lit(None).cast("string")
    for code, value in RESTRICTION_OF.items():
        kind = F.when(F.col("code") == code, value).otherwise(kind)
    return every.select("rel_id", F.create_map(F.lit("restriction"), kind).alias("tags"), F.when(F.col("code") == 8, F.concat(three, F.slice(three, 1, 1))).otherwise(three).alias("members"))

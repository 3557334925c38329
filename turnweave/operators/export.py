"""Turn geometry and the CSV table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import first_half, fixed6, midpoint, point_texts, second_half
from .edges import KEY
from .turns import turns

#: Columns of the CSV file. Fixed values.
CSV_COLUMNS = (
    "weight", "geom", "was_one_way", "osm_way_from", "osm_way_to", "osm_way_from_source_node", "osm_way_from_target_node",
    "osm_way_to_source_node", "osm_way_to_target_node",
)


def edge_midpoints(edges: DataFrame) -> DataFrame:
    """``way_id, seg, rev, idx, lat, lon``."""
    return edges.select(*KEY, midpoint(F.col("geom")).alias("m")).select(*KEY, "m.idx", "m.lat", "m.lon")


def turn_geometry(edges: DataFrame, mandatory: DataFrame, forbidden: DataFrame) -> DataFrame:
    """Turns with ``geom``: the second half of one edge, then the first half of the next (their node comes twice)."""
    out = turns(_with_halves(edges), mandatory, forbidden, ("tail",), ("head",))
    return out.withColumn("geom", F.concat("tail", "head")).drop("tail", "head")


def _with_halves(edges: DataFrame) -> DataFrame:
    m = F.col("__middle")
    return edges.withColumn("__middle", midpoint(F.col("geom"))).withColumns({"head": first_half(F.col("geom"), m), "tail": second_half(F.col("geom"), m)}).drop("__middle")


def csv_rows(edges: DataFrame, mandatory: DataFrame, forbidden: DataFrame) -> DataFrame:
    """The nine columns of the CSV file, numbers written with six decimals.

    Each half of an edge is written as text once; the turns carry the texts and only put them together.
    """
    text = lambda c: point_texts(F.col(f"{c}.lon"), F.col(f"{c}.lat"))
    written = _with_halves(edges).withColumns({"head": text("head"), "tail": text("tail")})
    out = turns(written, mandatory, forbidden, ("tail",), ("head",))
    line = F.concat(F.lit("LINESTRING("), "tail", F.lit(";"), "head", F.lit(")"))
    return out.select(
        fixed6(F.col("weight")).alias("weight"), line.alias("geom"), F.when(F.col("was_one_way"), "true").otherwise("false").alias("was_one_way"),
        F.col("from_way").alias("osm_way_from"), F.col("to_way").alias("osm_way_to"), F.col("from_source").alias("osm_way_from_source_node"),
        F.col("via").alias("osm_way_from_target_node"), F.col("via").alias("osm_way_to_source_node"), F.col("to_target").alias("osm_way_to_target_node"),
    )


def write_csv(rows: DataFrame, path: str, single: bool = False) -> None:
    """A folder of CSV files with a header each; a network without turns gives the header alone.

    ``single``: one file at ``path`` with one header, put together by the driver's file system from parts that the
    tasks wrote, so no task or driver holds the rows.
    """
    if not single:
        rows.write.mode("overwrite").option("header", True).csv(path)
        return
    parts = f"{path}.parts"
    rows.write.mode("overwrite").option("header", False).csv(parts)
    jvm, conf = rows.sparkSession.sparkContext._jvm, rows.sparkSession.sparkContext._jsc.hadoopConfiguration()
    folder, target = jvm.org.apache.hadoop.fs.Path(parts), jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(conf)
    out = fs.create(target, True)
    try:
        out.write((",".join(rows.columns) + "\n").encode())
        for status in sorted(fs.listStatus(folder), key=lambda x: x.getPath().getName()):
            if status.getPath().getName().startswith("part-"):
                part = fs.open(status.getPath())
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, conf, False)
                part.close()
    finally:
        out.close()
    fs.delete(folder, True)

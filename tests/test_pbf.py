"""The PBF source against files that a small encoder writes."""

from __future__ import annotations

import zlib

import pytest

from turnweave.sources import osmpbf


def varint(x: int) -> bytes:
    x &= (1 << 64) - 1
    out = b""
    while x >= 128:
        out += bytes([x & 127 | 128])
        x >>= 7
    return out + bytes([x])


def zigzag(x: int) -> int:
    return x << 1 ^ x >> 63


def number(field: int, x: int) -> bytes:
    return varint(field << 3) + varint(x)


def chunk(field: int, data: bytes) -> bytes:
    return varint(field << 3 | 2) + varint(len(data)) + data


def deltas(xs) -> bytes:
    return b"".join(varint(zigzag(b - a)) for a, b in zip([0, *xs], xs, strict=False))


def dense(nodes) -> bytes:
    ids, lats, lons = zip(*nodes, strict=True)
    return chunk(2, chunk(1, deltas(ids)) + chunk(8, deltas(lats)) + chunk(9, deltas(lons)))


class Strings:
    def __init__(self):
        self.all = [b""]

    def __call__(self, text: str) -> int:
        self.all.append(text.encode())
        return len(self.all) - 1


def tags(strings: Strings, pairs) -> bytes:
    return chunk(2, b"".join(varint(strings(k)) for k, _ in pairs)) + chunk(3, b"".join(varint(strings(v)) for _, v in pairs))


def block(groups, strings=None, extra=b"") -> bytes:
    table = chunk(1, b"".join(chunk(1, s) for s in (strings or Strings()).all))
    return table + b"".join(chunk(2, g) for g in groups) + extra


def blob(kind: str, content: bytes, how: str = "zlib") -> bytes:
    body = {"raw": chunk(1, content), "zlib": number(2, len(content)) + chunk(3, zlib.compress(content)), "lzma": chunk(4, content)}[how]
    head = chunk(1, kind.encode()) + number(3, len(body))
    return len(head).to_bytes(4, "big") + head + body


HEADER = blob("OSMHeader", chunk(4, b"OsmSchema-V0.6"))


@pytest.fixture
def file(tmp_path):
    s = Strings()
    ways = [
        (7, [("highway", "primary"), ("highway", "footway"), ("oneway", "yes")], [5, 3, 9]),
        (-8, [("name", "é")], []),
    ]
    way_group = b"".join(chunk(3, number(1, i) + tags(s, t) + chunk(8, deltas(r))) for i, t, r in ways)
    members = [(7, "from", 1), (3, "via", 0), (8, "to", 1)]
    relation = chunk(4, number(1, 70) + tags(s, [("restriction", "no_left_turn")]) + chunk(8, b"".join(varint(s(r)) for _, r, _ in members)) + chunk(9, deltas([m for m, _, _ in members])) + chunk(10, bytes(k for _, _, k in members)))
    plain = chunk(1, number(1, zigzag(11)) + number(8, zigzag(-5)) + number(9, zigzag(6)))
    path = tmp_path / "a.osm.pbf"
    path.write_bytes(
        HEADER
        + blob("OSMData", block([dense([(3, 100_000_000, 200_000_000), (5, 123_456_785, -1), (-9, 0, 7)])]), "raw")
        + blob("OSMData", block([plain, way_group, relation], s, number(17, 1000) + number(19, 500) + number(20, -700 & (1 << 64) - 1)))
        + blob("Other", b"anything", "lzma")
    )
    return str(path)


def test_nodes(spark, file):
    rows = osmpbf.read(spark, file, "nodes").orderBy("seq").collect()
    assert [(r.node_id, r.lat, r.lon) for r in rows] == [(3, 10.0, 20.0), (5, 12.3456785, -1e-7), (-9, 0.0, 7e-7), (11, (500 - 5000) / 1e9, (-700 + 6000) / 1e9)]


def test_ways_and_relations(spark, file):
    ways = {r.way_id: (r.refs, r.tags) for r in osmpbf.read(spark, file, "ways").collect()}
    assert ways == {7: ([5, 3, 9], {"highway": "primary", "oneway": "yes"}), -8: ([], {"name": "é"})}
    (r,) = osmpbf.read(spark, file, "relations").collect()
    assert (r.rel_id, r.tags) == (70, {"restriction": "no_left_turn"})
    assert [(m.id, m.role, m.type) for m in r.members] == [(7, "from", "WAY"), (3, "via", "NODE"), (8, "to", "WAY")]


def test_partitions_and_folders(spark, file, tmp_path):
    (tmp_path / "b.osm.pbf").write_bytes(HEADER + blob("OSMData", block([dense([(99, 1, 1)])])))
    parts = osmpbf.OsmPbfReader(str(tmp_path), "nodes", 1).partitions()
    assert len(parts) == 3
    assert osmpbf.read(spark, f"file://{tmp_path}", "nodes").count() == 5


def test_broken_files(spark, tmp_path):
    bad = tmp_path / "bad.pbf"
    bad.write_bytes(HEADER + blob("OSMData", block([]), "lzma"))
    with pytest.raises(Exception, match="neither stored nor zlib"):
        osmpbf.read(spark, str(bad), "nodes").collect()
    bad.write_bytes(HEADER + blob("OSMData", block([dense([(1, 1, 1)])]))[:-3])
    with pytest.raises(Exception, match="ends inside"):
        osmpbf.read(spark, str(bad), "nodes").collect()
    uneven = chunk(2, chunk(1, deltas([1, 2])) + chunk(8, deltas([1])) + chunk(9, deltas([1, 2])))
    bad.write_bytes(blob("OSMData", block([uneven])))
    with pytest.raises(Exception, match="different numbers"):
        osmpbf.read(spark, str(bad), "nodes").collect()
    bad.write_bytes(HEADER)
    assert osmpbf.read(spark, str(bad), "ways").count() == 0
    with pytest.raises(Exception, match="entity"):
        osmpbf.read(spark, str(bad), "lakes").collect()


def test_varints():
    xs = [0, 1, 127, 128, 300, (1 << 63) - 1, (1 << 64) - 1]
    assert osmpbf.packed(memoryview(b"".join(map(varint, xs)))).tolist() == xs
    with pytest.raises(ValueError, match="before its time"):
        osmpbf.packed(memoryview(b"\x80"))


def test_a_graph_from_a_file(spark, tmp_path):
    from turnweave.plans.pipeline import build_from_pbf

    s = Strings()
    at = {1: (10.10, 20.10), 2: (10.10, 20.11), 3: (10.10, 20.12), 4: (10.11, 20.11)}
    ways = [(1, [1, 2, 3]), (2, [2, 4])]
    group = b"".join(chunk(3, number(1, i) + tags(s, [("highway", "primary")]) + chunk(8, deltas(r))) for i, r in ways)
    path = tmp_path / "tee.osm.pbf"
    path.write_bytes(HEADER + blob("OSMData", block([dense([(k, round(a * 1e7), round(b * 1e7)) for k, (a, b) in at.items()])])) + blob("OSMData", block([group], s)))
    graph = build_from_pbf(spark, str(path))
    assert graph.edges.count() == 6 and graph.turns.count() == 6


def test_ways_of_a_tag_only(spark, file):
    roads = osmpbf.read(spark, file, "ways", tag="highway", values="primary,road").collect()
    assert [(r.way_id, r.refs) for r in roads] == [(7, [5, 3, 9])]
    assert osmpbf.read(spark, file, "ways", tag="highway", values="footway").count() == 0  # the first of equal keys counts


def test_equal_ids_in_two_files(spark, tmp_path):
    from turnweave.operators.ways import used_nodes

    for name, lat in (("a", 100_000_000), ("b", 300_000_000)):
        (tmp_path / f"{name}.osm.pbf").write_bytes(HEADER + blob("OSMData", block([dense([(5, lat, 0)])])))
    nodes = osmpbf.read(spark, str(tmp_path), "nodes")
    (r,) = used_nodes(nodes, spark.createDataFrame([(5, 1)], "node_id long, used long")).collect()
    assert r.lat == 10.0 and sorted(x.file for x in nodes.collect()) == [0, 1]

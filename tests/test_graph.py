"""Micro-graphs that pin each rule, and random graphs against a plain model of the rules."""

from __future__ import annotations

import csv
import glob
import math
import random
from itertools import count

import pytest
from pyspark.sql import functions as F

from turnweave.functions.geo import fixed6, healpix_ring, midpoint, planar_length
from turnweave.operators import edges as edge_ops
from turnweave.operators import stats, ways
from turnweave.plans.pipeline import build

A, B, C, D, E = 1, 2, 3, 4, 5
PLACES = {A: (10.10, 20.10), B: (10.10, 20.11), C: (10.10, 20.12), D: (10.11, 20.11), E: (10.10, 21.90)}
NODES, WAYS = "node_id long, lat double, lon double", "way_id long, refs array<long>, tags map<string,string>"
RELATIONS = "rel_id long, tags map<string,string>, members array<struct<id:long,role:string,type:string>>"


def way(i, refs, highway="primary", **more):
    return (i, refs, ({"highway": highway} if highway else {}) | more)


def rule(kind, a, via, b, key="restriction", via_type="NODE", more=()):
    members = [(a, "from", "WAY"), (via, "via", via_type), (b, "to", "WAY"), *more]
    return ({key: kind}, [m for m in members if m[0] is not None])


TEE = [way(1, [A, B, C]), way(2, [B, D])]


@pytest.fixture
def graph(spark):
    def make(roads, rules=(), places=None, **options):
        where = PLACES | (places or {})
        nodes = spark.createDataFrame([(k, *p) for k, p in where.items()], NODES)
        relations = spark.createDataFrame([(k, t, m) for k, (t, m) in enumerate(rules)], RELATIONS)
        return build(nodes, spark.createDataFrame(roads, WAYS), relations, **options)

    return make


def turns(g):
    rows = g.turns.collect()
    return sorted((r.from_way, r.from_source, r.via, r.to_way, r.to_target) for r in rows)


def test_line(graph):
    g = graph([way(1, [A, B, C])])
    assert sorted((r.src_node, r.tgt_node) for r in g.edges.collect()) == [(A, C), (C, A)] and turns(g) == []


def test_tee(graph):
    g = graph(TEE)
    assert g.edges.count() == 6
    assert turns(g) == sorted([(1, A, B, 1, C), (1, A, B, 2, D), (1, C, B, 1, A), (1, C, B, 2, D), (2, D, B, 1, A), (2, D, B, 1, C)])


@pytest.mark.parametrize(("value", "n"), [("yes", 5), ("1", 5), ("-1", 6), ("no", 6), ("reversible", 6), (None, 6)])
def test_oneway(graph, value, n):
    tags = {"oneway": value} if value else {}
    assert graph([way(1, [A, B, C]), way(2, [B, D], **tags)]).edges.count() == n


def test_highways(spark):
    values = [*ways.HIGHWAYS, "service", "footway", "living_street", None]
    rows = [way(k, [A, B], v) for k, v in enumerate(values)]
    assert [r.highway for r in ways.road_ways(spark.createDataFrame(rows, WAYS)).orderBy("way_id").collect()] == list(ways.HIGHWAYS)
    assert len(ways.HIGHWAYS) == 13


def test_closed_way(graph):
    g = graph([way(1, [A, B, C, A])])
    assert [(r.src_node, r.tgt_node) for r in g.edges.collect()] == [(A, A)] * 2 and turns(g) == []


def test_parallel_ways_and_twin_nodes(graph):
    assert turns(graph([way(1, [A, B]), way(2, [A, B])])) == []
    twin = graph([way(1, [A, B]), way(2, [B, 6])], places={6: PLACES[A]})
    assert turns(twin) == []


def test_forbidden_turns_ignore_the_node(graph):
    g = graph(TEE, [rule("no_left_turn", 1, 999, 2), rule("no_left_turn", 1, B, 2)])
    assert [t for t in turns(g) if t[0] == 1 and t[3] == 2] == [] and len(turns(g)) == 4
    assert g.forbidden.count() == 1


def test_mandatory_turn(graph):
    g = graph(TEE, [rule("only_straight_on", 1, B, 2)])
    assert [t for t in turns(g) if t[0] == 1] == [(1, A, B, 2, D), (1, C, B, 2, D)]


def test_mandatory_turn_onto_nothing(graph):
    foot = [*TEE, way(3, [B, E], "footway")]
    assert len(turns(graph(foot, [rule("only_left_turn", 1, B, 3)]))) == 6
    far = [*TEE, way(3, [D, E])]
    assert [t for t in turns(graph(far, [rule("only_left_turn", 1, B, 3)])) if t[0] == 1 and t[2] == B] == []


def test_conflicting_and_equal_mandatory_turns(graph):
    roads = [*TEE, way(3, [B, E])]
    assert [t for t in turns(graph(roads, [rule("only_left_turn", 1, B, 2), rule("only_right_turn", 1, B, 3)])) if t[0] == 1] == []
    same = turns(graph(roads, [rule("only_left_turn", 1, B, 2), rule("only_right_turn", 1, B, 2)]))
    assert [t for t in same if t[0] == 1] == [(1, A, B, 2, D), (1, C, B, 2, D)]


def test_only_the_first_candidate_is_tried(graph):
    through = [way(1, [E, B], oneway="yes"), way(2, [A, B, C])]
    assert turns(graph(through, [rule("only_left_turn", 1, B, 2)]))[0] == (1, E, B, 2, A)
    back = [way(1, [A, B, C]), way(2, [B, D])]
    got = turns(graph(back, [rule("only_straight_on", 1, B, 1)]))
    # From A the first edge of way 1 at B is the one back to A, a U-turn: nothing. From C the same edge is legal.
    assert [t for t in got if t[0] == 1] == [(1, C, B, 1, A)]


def test_one_candidate_in_each_scope(graph):
    roads = [way(1, [D, B], oneway="yes"), way(2, [A, B, E])]
    g = graph(roads, [rule("only_left_turn", 1, B, 2)])
    assert [t for t in turns(g) if t[0] == 1] == [(1, D, B, 2, A), (1, D, B, 2, E)]


def test_mandatory_and_forbidden(graph):
    g = graph(TEE, [rule("only_left_turn", 1, B, 2), rule("no_left_turn", 1, B, 2)])
    assert [t for t in turns(g) if t[0] == 1] == []


def test_relation_shapes(graph):
    odd = [
        rule("no_left_turn", 1, None, 2), rule("no_left_turn", 1, B, 2, more=((7, "via", "NODE"),)), rule("no_left_turn", 1, B, 2, via_type="WAY"),
        rule("no_u_turn", 1, B, 2), rule("no_left_turn", 1, B, 2, key="restriction:hgv"), ({"restriction": "no_left_turn"}, []), ({}, []),
    ]
    g = graph(TEE, odd)
    assert g.restrictions.count() == 0 and len(turns(g)) == 6


def test_border_edges(graph):
    g = graph([way(1, [A, E])])
    rows = g.edges.collect()
    assert {(r.src_pix, r.tgt_pix) for r in rows} == {(12311, 12312), (12312, 12311)} and all(r.is_border for r in rows)
    s = stats.graph_stats(g.edges, g.turns).first()
    assert (s.edges, s.border_segments, s.border_nodes, s.pixels, s.turns) == (2, 1, 2, 2, 0)


def test_missing_nodes_and_short_ways(graph):
    roads = [*TEE, way(3, [B, 77])]
    with pytest.raises(ValueError, match="refers to node 77"):
        graph(roads)
    assert len(turns(graph(roads, on_missing="drop"))) == 6
    g = graph([way(1, []), way(2, [A]), way(3, [A, B])])
    assert g.edges.count() == 2 and {r.node_id: r.used for r in g.nodes.collect()} == {A: 4, B: 2}


def test_repeated_node_ids(spark, graph):
    nodes = spark.createDataFrame([(A, 1.0, 1.0, 5), (A, 2.0, 2.0, 3), (B, 1.0, 2.0, 9)], NODES + ", seq long")
    used = ways.used_nodes(nodes, spark.createDataFrame([(A, 2), (B, 2)], "node_id long, used long"))
    assert {r.node_id: r.lat for r in used.collect()} == {A: 2.0, B: 1.0}


def test_degenerate_lines_have_their_first_point(spark):
    line = "array<struct<lat:double,lon:double>>"
    df = spark.createDataFrame([([(1.0, 2.0), (1.0, 2.0)],), ([(0.0, 0.0), (0.0, 1.0), (0.0, 4.0)],)], f"g {line}")
    got = [(r.m.idx, r.m.lat, r.m.lon, r.n) for r in df.select(midpoint(F.col("g")).alias("m"), planar_length(F.col("g")).alias("n")).collect()]
    assert got == [(0, 1.0, 2.0, 0.0), (1, 0.0, 2.0, 4.0)]


def test_six_decimals_round_the_binary_value(spark):
    df = spark.createDataFrame([(12.3456785,), (-0.0000005,), (1.0,)], "x double")
    assert [r[0] for r in df.select(fixed6("x")).collect()] == ["12.345678", "-0.000000", "1.000000"]


def test_pixel_centres(spark):
    n, rows = 50, []
    for i in range(1, 4 * n):
        if i < n or i > 3 * n:
            k = min(i, 4 * n - i)
            z = (1 - k * k / (3 * n * n)) * (1 if i < n else -1)
            ring = [(z, math.pi / (2 * k) * (j - 0.5)) for j in range(1, 4 * k + 1)]
        else:
            z = 4 / 3 - 2 * i / (3 * n)
            ring = [(z, math.pi / (2 * n) * (j - (0.5 if (i - n) % 2 == 0 else 1))) for j in range(1, 4 * n + 1)]
        rows += ring
    rows = [(k, 90 - math.degrees(math.acos(z)), math.degrees(phi)) for k, (z, phi) in enumerate(rows)]
    df = spark.createDataFrame(rows, "k long, lat double, lon double")
    assert len(rows) == 30_000 and df.where(healpix_ring(F.col("lat"), F.col("lon")) != F.col("k")).count() == 0


def test_csv(graph, tmp_path):
    g = graph([*TEE], [rule("only_straight_on", 1, B, 2)])
    g.write_csv(str(tmp_path / "out"))
    rows = [r for f in glob.glob(f"{tmp_path}/out/*.csv") for r in csv.DictReader(open(f))]
    assert len(rows) == 4
    row = next(r for r in rows if (r["osm_way_from"], r["osm_way_from_source_node"]) == ("1", str(A)))
    assert row["geom"] == "LINESTRING(20.105000 10.100000;20.110000 10.100000;20.110000 10.100000;20.110000 10.105000)"
    assert (row["was_one_way"], row["osm_way_to"], row["osm_way_to_target_node"]) == ("false", "2", str(D))
    half = lambda a, b: 6370.986884258304 * 2 * math.asin(math.sqrt(math.sin(math.radians(b[0] - a[0]) / 2) ** 2 + math.cos(math.radians(a[0])) * math.cos(math.radians(b[0])) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2)) / 2
    assert abs(float(row["weight"]) - half(PLACES[A], PLACES[B]) - half(PLACES[B], PLACES[D])) < 2e-6
    graph([way(1, [A, B])]).write_csv(str(tmp_path / "none"))
    g.save(str(tmp_path / "store"))


def test_one_csv_file_and_a_saved_graph(spark, graph, tmp_path):
    from turnweave.plans.pipeline import RoadGraph

    g = graph([*TEE, way(3, [D, E])], [rule("only_left_turn", 1, B, 2), rule("no_right_turn", 2, B, 1)])
    g.write_csv(str(tmp_path / "turns.csv"), single=True)
    with open(tmp_path / "turns.csv") as f:
        rows = list(csv.DictReader(f))
    assert len(rows) == g.turns.count() > 0 and "weight" in rows[0] and not glob.glob(f"{tmp_path}/*.parts")
    g.save(str(tmp_path / "store"))
    again = RoadGraph.load(spark, str(tmp_path / "store"))
    assert turns(again) == turns(g) and again.restrictions.count() == 2
    assert again.edges.where("src_pix = -1").count() == 0



def model(roads, rules, places, pix):
    """The rules on plain lists."""
    used = {}
    for _, refs, _ in roads:
        for k, n in enumerate(refs):
            used[n] = used.get(n, 0) + (2 if k in (0, len(refs) - 1) else 1)
    edges = []
    for w, refs, tags in roads:
        start, seg = 0, count()
        for k in range(1, len(refs)):
            if used[refs[k]] > 1:
                s = next(seg)
                edges.append((w, s, False, refs[start], refs[k]))
                if tags.get("oneway") not in ("yes", "1"):
                    edges.append((w, s, True, refs[k], refs[start]))
                start = k
    no = {(m[0][0], m[2][0]) for t, m in rules if t["restriction"].startswith("no_")}
    only = {}
    for t, m in rules:
        if t["restriction"].startswith("only_") and any(e[0] == m[2][0] for e in edges):
            only.setdefault((m[0][0], m[1][0]), set()).add(m[2][0])
    out = []
    for e in edges:
        u_turn = lambda f, e=e: places[e[3]] == places[f[4]]
        after = [f for f in edges if f[3] == e[4]]
        to = only.get((e[0], e[4]))
        if to is None:
            out += [(e[:3], f[:3]) for f in after if not u_turn(f) and (e[0], f[0]) not in no]
        elif len(to) == 1:
            for border in (False, True):
                mine = sorted(f for f in after if f[0] in to and (pix[f[3]] != pix[f[4]]) == border)[:1]
                out += [(e[:3], f[:3]) for f in mine if not u_turn(f) and (e[0], f[0]) not in no]
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_graphs(graph, seed):
    rng = random.Random(seed)
    places = {k: (round(10 + rng.randrange(8) * 0.3, 2), round(20 + rng.randrange(8) * 0.3, 2)) for k in range(100, 130)}
    roads = [way(k, [rng.choice(list(places)) for _ in range(rng.randrange(0, 6))], **({"oneway": "yes"} if rng.random() < 0.3 else {})) for k in range(1, 40)]
    kinds = ["no_left_turn", "only_left_turn", "only_right_turn", "no_straight_on"]
    rules = []
    for _ in range(60):
        a, b = rng.choice([r for r in roads if r[1]]), rng.choice(roads)
        shared = [r for r in roads if set(r[1]) & set(a[1])]
        rules.append(rule(rng.choice(kinds), a[0], rng.choice(a[1]), rng.choice([b, *shared])[0]))
    g = graph(roads, rules, places)
    pix = {r.node_id: r.ipix for r in g.nodes.collect()}
    got = sorted(((r.from_way, r.from_seg, r.from_rev), (r.to_way, r.to_seg, r.to_rev)) for r in g.turns.collect())
    assert got == model(roads, rules, places, pix) and got
    pairs = {}
    for e in g.edges.collect():
        pairs.setdefault((e.way_id, e.seg), []).append(e)
    assert all(len(p) == 1 or (p[0].cost == p[1].cost and p[0].geom == p[1].geom[::-1]) for p in pairs.values())
    assert edge_ops.out_degree(g.edges).agg(F.sum("n")).first()[0] == g.edges.count()
    assert sum(len(r.edges) for r in edge_ops.out_edges(g.edges).collect()) == g.edges.count()

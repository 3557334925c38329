"""DuckDB twins of the road queries: one chain of common table expressions, of which each query ends with a select."""

from __future__ import annotations

_R = "6370.986884258304"
_RAD = "(pi() / 180)"


def _haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = f"(pow(sin(({lat2} * {_RAD} - {lat1} * {_RAD}) / 2), 2) + cos({lat1} * {_RAD}) * cos({lat2} * {_RAD}) * pow(sin(({lon2} * {_RAD} - {lon1} * {_RAD}) / 2), 2))"
    return f"2 * atan2(sqrt({a}), sqrt(1 - {a})) * {_R}"


def _pixel() -> str:
    """HEALPix RING at 50, from z, tt and the parts of both regions."""
    return """
    case when abs(z) <= 2.0 / 3.0 then 4900 + 200 * (51 + jp - jm - 1) + (((jp + jm - 50 + (1 - ((51 + jp - jm) & 1)) + 1) >> 1) % 200 + 200) % 200
    else case when z > 0 then 2 * cr * (cr - 1) + floor(tt * cr)::bigint % (4 * cr)
      else 30000 - 2 * cr * (cr + 1) + floor(tt * cr)::bigint % (4 * cr) end end"""


#: name: (what it reads, select). In order; a query takes those it needs.
_STEPS: dict[str, str] = {
    "fx_refs": """select l_orderkey + 1 as way_id, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) - 1 as pos,
      1 + l_partkey * 16 + l_suppkey % 16 as node_id from lineitem""",
    "fx_nodes": """select node_id, (540000000 + (node_id * 7919) % 20000 * 1000) * 100 / 1e9 as lat, (360000000 + (node_id * 104729) % 30000 * 1000) * 100 / 1e9 as lon
      from (select distinct node_id from fx_refs)""",
    "fx_tags": """select o_orderkey + 1 as way_id, case o_orderpriority when '1-URGENT' then 'motorway' when '2-HIGH' then 'primary' when '3-MEDIUM' then 'residential' when '4-NOT SPECIFIED' then 'footway' end as highway,
      case o_orderstatus when 'F' then 'yes' when 'O' then 'no' else '-1' end as oneway from orders""",
    "fx_wn": "select distinct r.way_id, r.node_id from fx_refs r join fx_tags t on r.way_id = t.way_id where t.highway in ('motorway', 'primary', 'residential')",
    "fx_rest0": """select row_number() over (order by a.way_id, a.node_id, b.way_id) as id, a.way_id as from_way, a.node_id as via_node, b.way_id as to_way, (a.way_id * 31 + b.way_id * 17 + a.node_id) % 61 as code
      from fx_wn a join fx_wn b on a.node_id = b.node_id and a.way_id <> b.way_id where (a.way_id * 31 + b.way_id * 17 + a.node_id) % 61 < 9""",
    "fx_relations": """select id as rel_id, from_way, case when code < 3 and id % 7 = 0 then via_node + 1 else via_node end as via_node, to_way, code from fx_rest0
      union all select 10000000 + id, from_way, via_node + 1, to_way, code from fx_rest0 where code < 3 and id % 5 = 0
      union all select 20000000 + row_number() over (order by way_id, node_id), way_id, node_id, way_id, 5 from fx_wn where (way_id * 7 + node_id) % 53 = 0""",
    "roads": "select way_id, highway, oneway = 'yes' as oneway from fx_tags where highway in ('motorway', 'primary', 'residential') and way_id in (select way_id from fx_refs)",
    "refs": "select r.way_id, pos, node_id, pos = 0 or pos = max(pos) over (partition by r.way_id) as is_endpoint from fx_refs r join roads using (way_id)",
    "usage": "select node_id, sum(case when is_endpoint then 2 else 1 end)::bigint as used from refs group by 1",
    "zs": f"""select node_id, lat, lon, used, cos((90.0 - lat) * {_RAD}) as z, (lon * {_RAD} - 2 * pi() * floor(lon * {_RAD} / (2 * pi()))) / (pi() / 2) as tt from fx_nodes join usage using (node_id)""",
    "parts": """select *, floor((tt + 0.5) * 50 - z * 0.75 * 50)::bigint as jp, floor((tt + 0.5) * 50 + z * 0.75 * 50)::bigint as jm,
      floor((tt - floor(tt)) * sqrt((1.0 - abs(z)) * 3) * 50)::bigint + floor((1.0 - (tt - floor(tt))) * sqrt((1.0 - abs(z)) * 3) * 50)::bigint + 1 as cr from zs""",
    "used": f"select node_id, lat, lon, used, ({_pixel()})::bigint as ipix from parts",
    "pts": "select r.way_id, oneway, pos, node_id, lat, lon, used, ipix, max(pos) over (partition by r.way_id) as last from refs r join used using (node_id) join roads w on w.way_id = r.way_id",
    "numbered": "select *, sum(case when used > 1 then 1 else 0 end) over (partition by way_id order by pos) - case when used > 1 then 1 else 0 end - 1 as inner_seg, sum(case when used > 1 then 1 else 0 end) over (partition by way_id order by pos) - 1 as next_seg from pts",
    # A junction ends one segment and begins the next.
    "seg_pts": """select way_id, oneway, (case when used > 1 then next_seg - 1 else next_seg end)::int as seg, pos, node_id, lat, lon, ipix from numbered where pos > 0
      union all select way_id, oneway, next_seg::int, pos, node_id, lat, lon, ipix from numbered where used > 1 and pos < last""",
    "steps": f"""select *, {_haversine('plat', 'plon', 'lat', 'lon')} as km, sqrt((plon - lon) * (plon - lon) + (plat - lat) * (plat - lat)) as flat
      from (select *, lag(lat) over w as plat, lag(lon) over w as plon from seg_pts window w as (partition by way_id, seg order by pos))""",
    "segs": """select way_id, oneway, seg, count(*)::int as n_points, arg_min(node_id, pos) as a, arg_max(node_id, pos) as b, arg_min(ipix, pos) as pa, arg_max(ipix, pos) as pb,
      arg_min(lat, pos) as lat_a, arg_min(lon, pos) as lon_a, arg_max(lat, pos) as lat_b, arg_max(lon, pos) as lon_b, list_sum(list(km order by pos)) as cost from steps group by 1, 2, 3""",
    "edges": """select way_id, seg, false as rev, oneway as was_one_way, a as src_node, b as tgt_node, pa as src_pix, pb as tgt_pix, pa <> pb as is_border, lat_a, lon_a, lat_b, lon_b, cost from segs
      union all select way_id, seg, true, oneway, b, a, pb, pa, pa <> pb, lat_b, lon_b, lat_a, lon_a, cost from segs where not oneway""",
    "geom": """select way_id, seg, false as rev, (row_number() over (partition by way_id, seg order by pos) - 1)::int as i, lat, lon from seg_pts
      union all select way_id, seg, true, (row_number() over (partition by way_id, seg order by pos desc) - 1)::int, lat, lon from seg_pts where not oneway""",
    "members": "select rel_id, from_way, via_node, to_way, code from fx_relations where code not in (7, 8)",
    "rules": "select rel_id, from_way, via_node, to_way, code::int as type from members where code < 6",
    "forbidden": "select distinct from_way, to_way from rules where type < 3",
    "valid": "select rel_id, from_way, via_node, to_way from rules where type >= 3 and to_way in (select way_id from edges)",
    "mandatory": "select from_way, via_node, min(to_way) as to_way, count(distinct to_way) as n_to from valid group by 1, 2",
    "adjacent": """select e.way_id as from_way, e.seg as from_seg, e.rev as from_rev, f.way_id as to_way, f.seg as to_seg, f.rev as to_rev, case when f.is_border then 'border' else 'intra' end as scope,
      e.was_one_way, e.src_node as from_source, e.tgt_node as via, f.tgt_node as to_target, e.lat_a = f.lat_b and e.lon_a = f.lon_b as u_turn, (e.cost + f.cost) / 2 as weight from edges e join edges f on e.tgt_node = f.src_node""",
    "ruled": """select p.*, m.n_to, m.to_way as must, row_number() over (partition by p.from_way, p.from_seg, p.from_rev, scope, p.to_way order by to_seg, to_rev) as nth
      from adjacent p left join mandatory m on m.from_way = p.from_way and m.via_node = p.via""",
    "legal": """select r.* from ruled r where not u_turn and not exists (select 1 from forbidden f where f.from_way = r.from_way and f.to_way = r.to_way)
      and (n_to is null or (n_to = 1 and to_way = must and nth = 1))""",
    "lens": """select *, sum(d) over (partition by way_id, seg, rev order by i) as cl, coalesce(sum(d) over (partition by way_id, seg, rev order by i rows between unbounded preceding and 1 preceding), 0) as ol,
      sum(d) over (partition by way_id, seg, rev) / 2 as half from (select *, lag(lat) over w as plat, lag(lon) over w as plon, sqrt((lag(lon) over w - lon) ** 2 + (lag(lat) over w - lat) ** 2) as d from geom window w as (partition by way_id, seg, rev order by i))""",
    "hits": "select way_id, seg, rev, min(i) as i from lens where d > 0 and half <= cl + 1e-13 and half > ol + 1e-13 group by 1, 2, 3",
    "mids": """select g.way_id, g.seg, g.rev, coalesce(l.i - 1, 0)::int as idx, coalesce((1 - (half - ol) / d) * plat + (half - ol) / d * l.lat, g.lat) as lat, coalesce((1 - (half - ol) / d) * plon + (half - ol) / d * l.lon, g.lon) as lon
      from geom g left join hits h on h.way_id = g.way_id and h.seg = g.seg and h.rev = g.rev left join lens l on l.way_id = g.way_id and l.seg = g.seg and l.rev = g.rev and l.i = h.i where g.i = 0""",
    "counts": "select way_id, seg, rev, count(*) as n, list(printf('%.6f %.6f', lon, lat) order by i) as texts from geom group by 1, 2, 3",
    "halves": "select m.*, c.n, c.texts from mids m join counts c using (way_id, seg, rev)",
    "shapes": """select t.*, a.n - 1 - a.idx + b.idx + 1 + 2 as n_points, a.lat as first_lat, a.lon as first_lon, b.lat as last_lat, b.lon as last_lon,
      array_to_string(list_concat(list_concat([printf('%.6f %.6f', a.lon, a.lat)], a.texts[a.idx + 2:]), list_concat(b.texts[:b.idx + 1], [printf('%.6f %.6f', b.lon, b.lat)])), ';') as line
      from legal t join halves a on a.way_id = t.from_way and a.seg = t.from_seg and a.rev = t.from_rev join halves b on b.way_id = t.to_way and b.seg = t.to_seg and b.rev = t.to_rev""",
}

_T = "from_way, from_seg, from_rev, to_way, to_seg, to_rev"

_QUERIES = {
    "ways_highway_filter": "select way_id, highway from roads",
    "ways_oneway_flag": "select way_id, oneway from roads",
    "coord_scale": "select node_id, lat, lon from fx_nodes",
    "delta_decode_refs": "select way_id, pos::int as pos, sum(delta) over (partition by way_id order by pos)::bigint as node_id from (select way_id, pos, node_id - coalesce(lag(node_id) over (partition by way_id order by pos), 0) as delta from fx_refs where way_id in (select way_id from fx_tags))",
    "ref_endpoints": "select way_id, pos::int as pos, node_id, is_endpoint from refs",
    "node_usage": "select * from usage",
    "used_nodes": "select node_id, lat, lon, used from used",
    "junctions": "select * from usage where used > 1",
    "dangling_refs": "select distinct node_id from refs where node_id % 97 = 0",
    "healpix_pixels": "select node_id, ipix from used",
    "pixel_counts": "select ipix, count(*) as n from used group by 1",
    "way_segments": "select way_id, seg, a as src_node, b as tgt_node, n_points from segs",
    "segment_cost": "select way_id, seg, round(cost, 6) as cost from segs",
    "directed_edges": "select way_id, seg, rev, was_one_way, src_node, tgt_node, src_pix, tgt_pix, is_border from edges",
    "edge_geometry": "select * from geom",
    "border_summary": "select src_pix, tgt_pix, count(*) as n_edges from edges where is_border group by 1, 2",
    "out_degree": "select src_node, count(*) as n from edges group by 1",
    "restriction_members": "select rel_id, from_way, via_node, to_way from members",
    "restriction_codes": "select rel_id, type from rules",
    "no_restriction_pairs": "select * from forbidden",
    "only_restrictions_valid": "select from_way, via_node, to_way from valid",
    "mandatory_conflicts": "select from_way, via_node, n_to from mandatory where n_to > 1",
    "adjacency_pairs": f"select {_T}, scope from adjacent",
    "uturn_filtered": f"select {_T} from adjacent where not u_turn",
    "turns_no_only": f"select {_T} from legal where n_to is null",
    "turns_mandatory": f"select {_T} from legal where n_to is not null",
    "turns_all": f"select {_T}, round(weight, 6) as weight from legal",
    "edge_midpoint": "select way_id, seg, rev, idx, round(lat, 6) as lat, round(lon, 6) as lon from mids",
    "line_length_km": f"select way_id, round(coalesce(list_sum(list(km order by pos)), 0), 6) as km from (select way_id, pos, {_haversine('plat', 'plon', 'lat', 'lon')} as km from (select way_id, pos, lat, lon, lag(lat) over w as plat, lag(lon) over w as plon from pts window w as (partition by way_id order by pos))) group by 1",
    "turn_geometry": f"select {_T}, n_points::int as n_points, round(first_lat, 6) as first_lat, round(first_lon, 6) as first_lon, round(last_lat, 6) as last_lat, round(last_lon, 6) as last_lon from shapes",
    "turn_csv": "select printf('%.6f', weight) as weight, 'LINESTRING(' || line || ')' as geom, case when was_one_way then 'true' else 'false' end as was_one_way, from_way as osm_way_from, to_way as osm_way_to, from_source as osm_way_from_source_node, via as osm_way_from_target_node, via as osm_way_to_source_node, to_target as osm_way_to_target_node from shapes",
    "ingest_stats": """select (select count(*) from fx_nodes) as nodes, count(*) as ways, sum(n)::bigint as refs, round(avg(n), 6) as avg_way_size, count(*) filter (used) as used_ways, (sum(n) filter (used))::bigint as used_refs, round(avg(n) filter (used), 6) as avg_used_way_size,
      (select count(*) from fx_relations) as relations, (select count(*) from rules) as used_relations from (select way_id, count(*) as n, any_value(way_id in (select way_id from roads)) as used from fx_refs where way_id in (select way_id from fx_tags) group by 1)""",
    "graph_stats": """select count(*) as edges, count(*) filter (is_border and not rev) as border_segments, 2 * count(*) filter (is_border and not rev) as border_nodes, count(distinct src_pix) as pixels, (select count(*) from legal) as turns from edges""",
}


def _needs(text: str) -> list[str]:
    import re

    wanted, todo = set(), [text]
    while todo:
        t = todo.pop()
        for name in _STEPS:
            if name not in wanted and re.search(rf"\b{name}\b", t):
                wanted.add(name)
                todo.append(_STEPS[name])
    return [name for name in _STEPS if name in wanted]


def sql() -> dict[str, str]:
    """Each query with the steps it needs."""
    out = {}
    for name, select in _QUERIES.items():
        steps = ",\n".join(f"{step} as materialized ({_STEPS[step]})" for step in _needs(select))
        out[name] = f"with {steps}\n{select}"
    return out

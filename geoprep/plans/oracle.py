"""DuckDB SQL oracles for the registered queries.

Each query is re-derived here in plain SQL over the same Parquet views: the fixtures
with the same integer formulas, and the spatial predicate by brute force (box filter +
every edge of the polygon, crossing parity and on-edge test) -- no grid and no bands, so
it checks the distributed path independently.  DuckDB has no spatial extension here.
"""

from __future__ import annotations

from geoprep.sources.fixtures import SHAPE_TEMPLATES


def _num(v) -> str:
    return f"CAST({float(v)!r} AS DOUBLE)"


def _tpl_values() -> str:
    rows = []
    for kind, (_, parts) in SHAPE_TEMPLATES.items():
        for pi, part in enumerate(parts):
            for ri, ring in enumerate(part):
                for si, (x, y) in enumerate(ring):
                    rows.append(f"({kind}, {pi}, {ri}, {si}, {_num(x)}, {_num(y)})")
    return ",\n    ".join(rows)


def fmt(v: str) -> str:
    """WKT number text: shortest decimal, integral values without '.0'."""
    return f"regexp_replace(CAST({v} AS VARCHAR), '\\.0$', '')"


GROUP_CODE = "CASE {k} % 5 WHEN 0 THEN 'USA' WHEN 1 THEN 'GBR' WHEN 2 THEN 'DEU' WHEN 3 THEN 'FRO' END"


def fixture_ctes() -> str:
    """CTEs: shape_tpl, adm0_raw, adm1_raw, adm2_raw (with kind, x0, y0), spr, geojson."""
    k0, k1, k2 = "n_nationkey", "s_suppkey", "p_partkey"
    return f"""
shape_tpl(kind, part, ring, seq, x, y) AS (VALUES
    {_tpl_values()}),
adm0_raw AS (
  SELECT {GROUP_CODE.format(k=k0)} AS shapeGroup, 'ADM0' AS shapeType,
         CASE WHEN {k0} % 7 = 6 THEN NULL
              WHEN {k0} % 7 = 5 THEN ' ' || n_name || '  MAIN LAND '
              ELSE n_name || ' MAIN  LAND' END AS shapeName,
         'C' || CAST({k0} AS VARCHAR) AS shapeID, CAST({k0} % 3 AS INTEGER) AS kind,
         CAST(-20.0 AS DOUBLE) + 4.0 * CAST({k0} % 10 AS DOUBLE) AS x0,
         CAST(-20.0 AS DOUBLE) + 4.0 * floor(CAST({k0} AS DOUBLE) / 10.0) AS y0
  FROM nation),
adm1_raw AS (
  SELECT {GROUP_CODE.format(k=k1)} AS shapeGroup, 'ADM1' AS shapeType,
         CASE WHEN {k1} % 8 = 6 THEN NULL
              WHEN {k1} % 8 = 7 THEN ' North  State ' || CAST({k1} AS VARCHAR) || ' '
              ELSE 'State ' || CAST({k1} AS VARCHAR) END AS shapeName,
         'S' || CAST({k1} AS VARCHAR) AS shapeID, CAST({k1} % 3 AS INTEGER) AS kind,
         CAST(-20.0 AS DOUBLE) + 4.0 * CAST({k1} % 10 AS DOUBLE) AS x0,
         CAST(-20.0 AS DOUBLE) + 4.0 * floor(CAST({k1} AS DOUBLE) / 10.0) AS y0
  FROM supplier),
adm2_raw AS (
  SELECT {GROUP_CODE.format(k=k2)} AS shapeGroup, 'ADM2' AS shapeType,
         CASE WHEN {k2} % 11 = 10 THEN NULL ELSE 'City ' || CAST({k2} % 40 AS VARCHAR) END AS shapeName,
         'T' || CAST({k2} AS VARCHAR) AS shapeID, 3 AS kind,
         CAST(-20.0 AS DOUBLE) + CAST(({k2} * 37) % 160 AS DOUBLE) / 4.0 AS x0,
         CAST(-20.0 AS DOUBLE) + 4.0 * floor(CAST({k2} AS DOUBLE) / 200.0) + CAST(({k2} * 53) % 16 AS DOUBLE) / 4.0 AS y0
  FROM part),
place_base AS (
  SELECT c_custkey AS id,
         CASE c_custkey % 5 WHEN 0 THEN 'US' WHEN 1 THEN 'USA' WHEN 2 THEN 'CA' WHEN 3 THEN 'US' END AS country,
         lpad(CAST(c_custkey % 997 AS VARCHAR), 5, '0') AS name,
         CAST(-20.5 AS DOUBLE) + CAST((c_custkey * 7919) % 164 AS DOUBLE) / 4.0 AS lon,
         CAST(-20.0 AS DOUBLE) + 4.0 * floor(CAST(c_custkey AS DOUBLE) / 150.0)
           + CAST((c_custkey * 104729) % 17 AS DOUBLE) / 4.0 AS lat
  FROM customer),
spr AS (SELECT id, country, name FROM place_base),
geojson AS (
  SELECT id,
    CASE WHEN id % 50 = 11 THEN '{{oops'
         WHEN id % 50 = 23 THEN '{{"properties":{{"geom:longitude":' || CAST(lon AS VARCHAR) || '}}}}'
         WHEN id % 50 = 31 THEN '{{"geometry":{{"type":"Point","coordinates":[' || CAST(lon AS VARCHAR) || ','
                               || CAST(lat AS VARCHAR) || ']}}}}'
         ELSE '{{"geometry":' ||
              CASE WHEN id % 50 = 36 THEN
                '{{"type":"Polygon","coordinates":[[' ||
                '[' || CAST(lon AS VARCHAR) || ',' || CAST(lat AS VARCHAR) || '],' ||
                '[' || CAST(lon + 0.5 AS VARCHAR) || ',' || CAST(lat AS VARCHAR) || '],' ||
                '[' || CAST(lon + 0.5 AS VARCHAR) || ',' || CAST(lat + 0.5 AS VARCHAR) || '],' ||
                '[' || CAST(lon AS VARCHAR) || ',' || CAST(lat + 0.5 AS VARCHAR) || '],' ||
                '[' || CAST(lon AS VARCHAR) || ',' || CAST(lat AS VARCHAR) || ']]]}}'
              ELSE '{{"type":"Point","coordinates":[' || CAST(lon AS VARCHAR) || ',' || CAST(lat AS VARCHAR) || ']}}' END
              || ',"properties":{{' ||
              CASE WHEN id % 6 = 0 THEN '"mz:postal_locality":"Old  Town ' || CAST(id % 9 AS VARCHAR) || '",'
                   WHEN id % 3 = 0 THEN '"mz:postal_locality":"Old Town ' || CAST(id % 9 AS VARCHAR) || '",'
                   ELSE '' END ||
              CASE WHEN id % 7 = 0 THEN ''
                   WHEN id % 13 = 5 THEN '"geom:latitude":"' || CAST(lat AS VARCHAR) || '",'
                   ELSE '"geom:latitude":' || CAST(lat AS VARCHAR) || ',' END ||
              '"geom:longitude":' || CAST(lon AS VARCHAR) || '}}}}'
    END AS body
  FROM place_base WHERE id % 10 <> 9)"""


def polygon_ctes(name: str, raw: str) -> str:
    """CTEs {name}_edges(rid, x1, y1, x2, y2), {name}_box(rid, ...), {name}_reps(rid, px, py),
    {name}_wkt(rid, wkt) for a fixture polygon table ``raw`` keyed by shapeID."""
    return f"""
{name}_verts AS (
  SELECT a.shapeID AS rid, a.kind, t.part, t.ring, t.seq, t.x + a.x0 AS x, t.y + a.y0 AS y
  FROM {raw} a JOIN shape_tpl t ON t.kind = a.kind),
{name}_edges AS (
  SELECT v1.rid, v1.x AS x1, v1.y AS y1, v2.x AS x2, v2.y AS y2
  FROM {name}_verts v1 JOIN {name}_verts v2
    ON v2.rid = v1.rid AND v2.part = v1.part AND v2.ring = v1.ring AND v2.seq = v1.seq + 1),
{name}_box AS (
  SELECT rid, min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax FROM {name}_verts GROUP BY rid),
{name}_reps AS (SELECT rid, x AS px, y AS py FROM {name}_verts WHERE ring = 0 AND seq = 0),
{name}_rings AS (
  SELECT rid, kind, part, ring,
         '(' || string_agg({fmt('x')} || ' ' || {fmt('y')}, ', ' ORDER BY seq) || ')' AS txt
  FROM {name}_verts GROUP BY rid, kind, part, ring),
{name}_parts AS (
  SELECT rid, kind, part, '(' || string_agg(txt, ', ' ORDER BY ring) || ')' AS txt
  FROM {name}_rings GROUP BY rid, kind, part),
{name}_wkt AS (
  SELECT rid, CASE WHEN max(kind) = 2 THEN 'MULTIPOLYGON (' || string_agg(txt, ', ' ORDER BY part) || ')'
                   ELSE 'POLYGON ' || string_agg(txt, ', ' ORDER BY part) END AS wkt
  FROM {name}_parts GROUP BY rid)"""


def places_ctes(countries=("USA", "US")) -> str:
    """CTEs: places(id, country, postal_code, city, lat, lon, wkt) and the geometry tables
    g_verts(wkt, seq, x, y), g_edges(wkt, ...), g_reps(wkt, px, py), g_box(wkt, ...), g_areal(wkt)."""
    clist = ", ".join(f"'{c}'" for c in countries)
    return f"""
rec AS (
  SELECT s.id, s.country, s.name AS postal_code, g.body
  FROM spr s JOIN geojson g ON s.id = g.id WHERE s.country IN ({clist})),
rec_json AS (
  SELECT id, country, postal_code,
         CASE WHEN json_valid(body) THEN json_extract_string(body, '$.geometry.type') END AS gtype,
         CASE WHEN json_valid(body) THEN json_extract(body, '$.geometry.coordinates') END AS coords,
         CASE WHEN json_valid(body) THEN json_extract(body, '$.properties') END AS props
  FROM rec),
rec_ok AS (
  SELECT *, (gtype IN ('Point', 'Polygon') AND coords IS NOT NULL AND props IS NOT NULL
             AND json_type(props) = 'OBJECT') AS ok
  FROM rec_json),
poly_verts AS (
  SELECT id, s AS seq,
         CAST(json_extract(coords, '$[0][' || CAST(s AS VARCHAR) || '][0]') AS DOUBLE) AS x,
         CAST(json_extract(coords, '$[0][' || CAST(s AS VARCHAR) || '][1]') AS DOUBLE) AS y
  FROM (SELECT id, coords, unnest(range(CAST(json_array_length(coords, '$[0]') AS BIGINT))) AS s
        FROM rec_ok WHERE ok AND gtype = 'Polygon')),
poly_wkt AS (
  SELECT id, 'POLYGON ((' || string_agg({fmt('x')} || ' ' || {fmt('y')}, ', ' ORDER BY seq) || '))' AS wkt
  FROM poly_verts GROUP BY id),
places AS (
  SELECT r.id, r.country, r.postal_code,
         CASE WHEN r.ok THEN json_extract_string(r.props, '$."mz:postal_locality"') END AS city,
         coalesce(CASE WHEN r.ok THEN TRY_CAST(json_extract_string(r.props, '$."geom:latitude"') AS DOUBLE) END,
                  CAST('NaN' AS DOUBLE)) AS lat,
         coalesce(CASE WHEN r.ok THEN TRY_CAST(json_extract_string(r.props, '$."geom:longitude"') AS DOUBLE) END,
                  CAST('NaN' AS DOUBLE)) AS lon,
         CASE WHEN r.ok AND r.gtype = 'Point' THEN
                'POINT (' || {fmt("CAST(json_extract(r.coords, '$[0]') AS DOUBLE)")} || ' '
                || {fmt("CAST(json_extract(r.coords, '$[1]') AS DOUBLE)")} || ')'
              WHEN r.ok AND r.gtype = 'Polygon' THEN pw.wkt END AS wkt,
         CASE WHEN r.ok AND r.gtype = 'Point' THEN CAST(json_extract(r.coords, '$[0]') AS DOUBLE) END AS px,
         CASE WHEN r.ok AND r.gtype = 'Point' THEN CAST(json_extract(r.coords, '$[1]') AS DOUBLE) END AS py
  FROM rec_ok r LEFT JOIN poly_wkt pw ON pw.id = r.id),
g_verts AS (
  SELECT DISTINCT p.wkt, v.seq, v.x, v.y FROM poly_verts v JOIN places p ON p.id = v.id
  UNION ALL
  SELECT DISTINCT wkt, 0 AS seq, px AS x, py AS y FROM places WHERE px IS NOT NULL),
g_edges AS (
  SELECT v1.wkt, v1.x AS x1, v1.y AS y1, v2.x AS x2, v2.y AS y2
  FROM g_verts v1 JOIN g_verts v2 ON v2.wkt = v1.wkt AND v2.seq = v1.seq + 1),
g_reps AS (SELECT wkt, x AS px, y AS py FROM g_verts WHERE seq = 0),
g_box AS (SELECT wkt, min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax FROM g_verts GROUP BY wkt),
g_areal AS (SELECT DISTINCT wkt FROM places WHERE wkt LIKE 'POLYGON%')"""


def _pip(points: str, key: str, edges: str, edge_key: str, box: str, box_key: str, pair_key_out: str) -> str:
    """Brute-force closed point-in-polygon: points(key.., px, py) x polygons (box + all edges)."""
    return f"""
  SELECT DISTINCT {pair_key_out.replace('q.', '').replace('b.', '')} FROM (
  SELECT {pair_key_out}, q.px, q.py
  FROM {points} q JOIN {box} b ON q.px BETWEEN b.xmin AND b.xmax AND q.py BETWEEN b.ymin AND b.ymax
                 AND {box_key}
       JOIN {edges} e ON {edge_key}
  GROUP BY ALL
  HAVING sum(CASE WHEN ((e.y1 > q.py) <> (e.y2 > q.py))
                       AND (((e.x2 - e.x1) * (q.py - e.y1) - (q.px - e.x1) * (e.y2 - e.y1) > 0) = (e.y2 > e.y1))
                  THEN 1 ELSE 0 END) % 2 = 1
      OR bool_or(((e.x2 - e.x1) * (q.py - e.y1) - (q.px - e.x1) * (e.y2 - e.y1)) = 0
                 AND q.px BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
                 AND q.py BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)))"""


def hits_cte(name: str, poly: str) -> str:
    """CTE {name}(wkt, rid): place geometries meeting polygons of ``poly`` (closed intersects)."""
    o = "(({bx2} - {bx1}) * ({ay} - {by1}) - ({by2} - {by1}) * ({ax} - {bx1}))"

    def orient(bx1, by1, bx2, by2, ax, ay):
        return o.format(bx1=bx1, by1=by1, bx2=bx2, by2=by2, ax=ax, ay=ay)

    d1 = orient("pe.x1", "pe.y1", "pe.x2", "pe.y2", "ge.x1", "ge.y1")
    d2 = orient("pe.x1", "pe.y1", "pe.x2", "pe.y2", "ge.x2", "ge.y2")
    d3 = orient("ge.x1", "ge.y1", "ge.x2", "ge.y2", "pe.x1", "pe.y1")
    d4 = orient("ge.x1", "ge.y1", "ge.x2", "ge.y2", "pe.x2", "pe.y2")

    def on(px, py, sx1, sy1, sx2, sy2):
        return (f"{px} BETWEEN least({sx1}, {sx2}) AND greatest({sx1}, {sx2}) AND "
                f"{py} BETWEEN least({sy1}, {sy2}) AND greatest({sy1}, {sy2})")

    rep_pip = _pip("g_reps", "", f"{poly}_edges", "e.rid = b.rid", f"{poly}_box", "TRUE", "q.wkt, b.rid")
    rev_pip = _pip(f"(SELECT DISTINCT gb.wkt, r.rid, r.px, r.py FROM {poly}_reps r JOIN g_box gb "
                   f"ON r.px BETWEEN gb.xmin AND gb.xmax AND r.py BETWEEN gb.ymin AND gb.ymax "
                   f"WHERE gb.wkt IN (SELECT wkt FROM g_areal))",
                   "", "g_edges", "e.wkt = b.wkt", "g_box", "b.wkt = q.wkt", "q.wkt, q.rid")
    return f"""
{name} AS (
  {rep_pip}
  UNION
  SELECT DISTINCT ge.wkt, pe.rid
  FROM g_edges ge JOIN g_box gb ON gb.wkt = ge.wkt
       JOIN {poly}_box pb ON gb.xmin <= pb.xmax AND pb.xmin <= gb.xmax AND gb.ymin <= pb.ymax AND pb.ymin <= gb.ymax
       JOIN {poly}_edges pe ON pe.rid = pb.rid
  WHERE (sign({d1}) * sign({d2}) < 0 AND sign({d3}) * sign({d4}) < 0)
     OR ({d1} = 0 AND {on("ge.x1", "ge.y1", "pe.x1", "pe.y1", "pe.x2", "pe.y2")})
     OR ({d2} = 0 AND {on("ge.x2", "ge.y2", "pe.x1", "pe.y1", "pe.x2", "pe.y2")})
     OR ({d3} = 0 AND {on("pe.x1", "pe.y1", "ge.x1", "ge.y1", "ge.x2", "ge.y2")})
     OR ({d4} = 0 AND {on("pe.x2", "pe.y2", "ge.x1", "ge.y1", "ge.x2", "ge.y2")})
  UNION
  {rev_pip})"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes)


def postal_sql(countries=("USA", "US")) -> str:
    """The flagship W4 in brute force."""
    return with_ctes(
        fixture_ctes(), polygon_ctes("st", "adm1_raw"), polygon_ctes("ct", "adm2_raw"), places_ctes(countries),
        hits_cte("st_hits", "st"), hits_cte("ct_hits", "ct"),
        """
ct_pick AS (
  SELECT wkt, city FROM (
    SELECT h.wkt, a.shapeName AS city,
           row_number() OVER (PARTITION BY h.wkt ORDER BY a.shapeName IS NULL, a.shapeName, a.shapeID) AS rn
    FROM ct_hits h JOIN adm2_raw a ON a.shapeID = h.rid) WHERE rn = 1),
postal AS (
  SELECT replace(p.country, ' ', '_') AS country, replace(a.shapeName, ' ', '_') AS state,
         replace(coalesce(p.city, c.city), ' ', '_') AS city, p.postal_code, p.lat, p.lon, p.wkt AS wkt_geometry
  FROM places p LEFT JOIN st_hits h ON h.wkt = p.wkt LEFT JOIN adm1_raw a ON a.shapeID = h.rid
       LEFT JOIN ct_pick c ON c.wkt = p.wkt)""") + "\n"

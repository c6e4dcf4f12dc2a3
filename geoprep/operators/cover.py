"""Adaptive grid cover of polygons: cells that a point can be tested in by itself.

A polygon starts with the at most 2x2 cells of its own size (level: a power of two) and every
cell with more than ``max_edges`` of its edges is split, 4x4 at the next finer level, until
none has or ``max_splits`` is reached.  A final cell holds, for each part of the polygon that
it meets, the part's edges inside the cell and whether the cell's lower left corner lies in
the part; a cell inside some part holds no edges at all.

A point in a cell is joined to that corner by a vertical way along the cell's left side and a
horizontal way from there: it lies in the part iff corner and edges crossed on both ways say
so.  Every edge that can be crossed is in the cell.  Points count as shifted by (e1, e2) with
e1 >> e2 > 0 infinitely small, so that an edge through a corner or along a side is crossed or
not, never both; a point on an edge is found by itself (the predicate is closed).  Parity is
taken per part, and parts are joined by OR: overlapping parts do not cancel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoprep.functions import geometry as G
from geoprep.operators.stage import stage

E_MIN, E_MAX = -30, 40
STEP = 2                      # a split makes 2^STEP x 2^STEP cells
EDGE = "struct<x1:double,y1:double,x2:double,y2:double>"


def edges_by_part(geom: Column) -> Column:
    """array (part) of array of edges; open rings of areal parts are closed, lines stay as they
    are, empty rings and parts have no edges."""
    def ring(r, areal):
        n = F.size(r)
        body = F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.struct(
            r[i]["x"].alias("x1"), r[i]["y"].alias("y1"), r[i + 1]["x"].alias("x2"), r[i + 1]["y"].alias("y2")))
        closing = F.when(areal & ((r[0]["x"] != r[n - 1]["x"]) | (r[0]["y"] != r[n - 1]["y"])), F.array(F.struct(
            r[n - 1]["x"].alias("x1"), r[n - 1]["y"].alias("y1"), r[0]["x"].alias("x2"), r[0]["y"].alias("y2"))))
        return F.when(n >= 2, F.concat(body, F.coalesce(closing, F.array().cast(f"array<{EDGE}>"))))

    return F.transform(geom["parts"], lambda p, i: F.flatten(F.filter(
        F.transform(p, lambda r: ring(r, G.areal_part(geom, i))), lambda e: e.isNotNull())))


def exponent(ext: Column) -> Column:
    """The level of an extent: the least multiple of ``STEP`` with 2^level >= ext."""
    e = F.when(ext > 0, F.ceil(F.log2(ext))).otherwise(F.lit(E_MIN))
    e = F.least(F.greatest(e, F.lit(E_MIN)), F.lit(E_MAX))
    return (F.ceil(e / F.lit(float(STEP))) * F.lit(STEP)).cast("int")


def cell_of(v: Column, level: Column) -> Column:
    return F.floor(v / F.pow(F.lit(2.0), level))


def explode_cells(df: DataFrame, level: Column, x0="xmin", y0="ymin", x1="xmax", y1="ymax") -> DataFrame:
    """Explode a box into the cells of ``level`` it touches."""
    return (df.withColumn("cx", F.explode(F.sequence(cell_of(F.col(x0), level), cell_of(F.col(x1), level))))
              .withColumn("cy", F.explode(F.sequence(cell_of(F.col(y0), level), cell_of(F.col(y1), level)))))


def orient(ax, ay, bx, by, cx, cy) -> Column:
    return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)


def between(v, a, b) -> Column:
    return (v >= F.least(a, b)) & (v <= F.greatest(a, b))


def boxed(df: DataFrame, geom: str, *keep) -> DataFrame:
    """``keep``, g, pe (edges by part), edges, box and level of the geometries."""
    df = df.select(*keep, F.col(geom).alias("g"), edges_by_part(F.col(geom)).alias("pe"), G.bbox(F.col(geom)).alias("bb"))
    df = df.select(*keep, "g", "pe", F.flatten("pe").alias("edges"), "bb.xmin", "bb.ymin", "bb.xmax", "bb.ymax")
    return df.withColumn("lvl", exponent(F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"))))


def rep_vertices(geom: Column) -> Column:
    """First vertex of every part."""
    return F.filter(F.transform(geom["parts"], lambda p: F.get(F.get(p, F.lit(0)), F.lit(0))), lambda v: v.isNotNull())


CELL = ["pid", "lvl", "cx", "cy"]


def _crosses(e, x0, y0, s) -> Column:
    """Whether the line of an edge meets the closed cell (a hair too often rather than too
    seldom): the cell's corners do not all lie on one side of it."""
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    base = dx * (y0 - e["y1"]) - dy * (x0 - e["x1"])
    zero = F.lit(0.0)
    hair = (F.abs(dx) + F.abs(dy)) * s * F.lit(1e-9)
    return (base + F.least(zero, dx * s) + F.least(zero, -dy * s) <= hair) & (base + F.greatest(zero, dx * s) + F.greatest(zero, -dy * s) >= -hair)


ENDS = ("x1", "y1", "x2", "y2")


def _touched(rows: DataFrame) -> DataFrame:
    """Rows (edge, lvl, cx, cy) whose edge meets the closed cell (its box already does)."""
    x0, y0, s = _corner()
    return rows.where(_crosses({k: F.col(k) for k in ENDS}, x0, y0, s))


def _edges_in(edges: DataFrame, within: bool = False) -> DataFrame:
    """The edges with each cell of their ``lvl`` they meet (``within``: inside the cell they have)."""
    at = {}
    for v in "xy":
        lo, hi = (cell_of(f(f"{v}1", f"{v}2"), F.col("lvl")) for f in (F.least, F.greatest))
        if within:                               # columns cx, cy are those of the coarser cell
            first = F.shiftleft(F.col(f"c{v}"), STEP)
            lo, hi = F.greatest(lo, first), F.least(hi, first + (1 << STEP) - 1)
        at[v] = F.when(lo <= hi, F.sequence(lo, hi))
    rows = edges.withColumns({"__x": at["x"], "__y": at["y"]}).drop("cx", "cy")
    return _touched(rows.withColumn("cx", F.explode("__x")).withColumn("cy", F.explode("__y")).drop("__x", "__y"))


def _bands(polys: DataFrame, per_band: int = 32) -> tuple[DataFrame, DataFrame]:
    """(grid, edges): per polygon its horizontal bands, and its edges in every band they touch."""
    nb = F.greatest(F.lit(1), F.ceil(F.size("edges") / F.lit(float(per_band)))).cast("long")
    p = polys.select("pid", "ymin", "ymax", nb.alias("nb"), "pe").withColumn("hb", (F.col("ymax") - F.col("ymin")) / F.col("nb"))
    e = p.select("pid", "ymin", "nb", "hb", F.posexplode("pe").alias("p", "es")).select("pid", "ymin", "nb", "hb", "p", F.explode("es").alias("e"))
    e = e.select("pid", "p", "e.*", F.explode(F.sequence(_band(F.least("e.y1", "e.y2")), _band(F.greatest("e.y1", "e.y2")))).alias("band"))
    return p.drop("pe"), e


def _band(y: Column) -> Column:
    raw = F.floor((y - F.col("ymin")) / F.when(F.col("hb") > 0, F.col("hb")).otherwise(F.lit(1.0)))
    return F.when((F.col("nb") <= 1) | (F.col("hb") <= 0), F.lit(0).cast("long")).otherwise(
        F.least(F.col("nb") - 1, F.greatest(F.lit(0).cast("long"), raw)))


def _corners_inside(cells: DataFrame, polys: DataFrame) -> DataFrame:
    """pid, lvl, cx, cy, p: the cells whose lower left corner lies in part p."""
    grid, edges = _bands(polys)
    x0, y0, _ = _corner()
    c = cells.join(grid, "pid").withColumns({"x": x0, "y": y0})
    c = c.where((F.col("y") >= F.col("ymin")) & (F.col("y") <= F.col("ymax"))).select(*CELL, "x", "y", _band(F.col("y")).alias("band"))
    j = c.join(edges, ["pid", "band"])
    right = _right_of({k: F.col(k) for k in ENDS}, F.col("x"), F.col("y"))
    return j.where(right).groupBy(*CELL, "p").agg(F.count(F.lit(1)).alias("k")).where("k % 2 = 1").drop("k")


def _local_edge(x1, y1, x2, y2, x0, y0) -> Column:
    """An edge as its cell holds it: with what the test needs to know about the corner (x0, y0)."""
    dx, dy = x2 - x1, y2 - y1
    tie = (dy < 0) | ((dy == 0) & (dx > 0))
    at_corner = orient(x1, y1, x2, y2, x0, y0)
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"), tie.alias("tie"),
                    ((at_corner > 0) | ((at_corner == 0) & tie)).alias("left"), ((x1 > x0) != (x2 > x0)).alias("over"))


def _right_of(e, x, y) -> Column:
    """Whether the ray from (x, y) to the right crosses the edge."""
    side = orient(e["x1"], e["y1"], e["x2"], e["y2"], x, y)
    up = e["y2"] > e["y1"]
    return ((e["y1"] > y) != (e["y2"] > y)) & ((up & (side > 0)) | (~up & (side < 0)))


def _corner() -> tuple[Column, Column, Column]:
    s = F.pow(F.lit(2.0), F.col("lvl"))
    return F.col("cx") * s, F.col("cy") * s, s


def _finished(rows: DataFrame) -> DataFrame:
    """A cell inside some part holds no edges; a cell that meets no part is none."""
    whole = F.exists("parts", lambda p: (F.size(p["edges"]) == 0) & p["corner"])
    rows = rows.select(*CELL, whole.alias("inside"), F.filter("parts", lambda p: F.size(p["edges"]) > 0).alias("parts"))
    return rows.where(F.col("inside") | (F.size("parts") > 0)).withColumn(
        "parts", F.when(F.col("inside"), F.slice("parts", 1, 0)).otherwise(F.col("parts")))


def _cover_in_row(polys: DataFrame) -> DataFrame:
    """The cover of polygons of so few edges that no cell needs a split: without any shuffle.
    What an edge needs in every cell is computed once a polygon."""
    def terms(e):
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
        return F.struct(*[e[k].alias(k) for k in ENDS], dx.alias("dx"), dy.alias("dy"), (F.abs(dx) + F.abs(dy)).alias("reach"),
                        F.least(e["x1"], e["x2"]).alias("xl"), F.greatest(e["x1"], e["x2"]).alias("xh"),
                        F.least(e["y1"], e["y2"]).alias("yl"), F.greatest(e["y1"], e["y2"]).alias("yh"),
                        ((dy < 0) | ((dy == 0) & (dx > 0))).alias("tie"))

    polys = polys.select("pid", "lvl", "xmin", "ymin", "xmax", "ymax", F.transform("pe", lambda p: F.transform(p, terms)).alias("pe"))
    rows = explode_cells(polys, F.col("lvl"))
    x0, y0, s = (F.col(c) for c in ("__x", "__y", "__s"))
    rows = rows.withColumns(dict(zip(("__x", "__y", "__s"), _corner()))).withColumns({"__u": x0 + s, "__v": y0 + s})

    def near(e):
        return (e["xl"] <= F.col("__u")) & (e["xh"] >= x0) & (e["yl"] <= F.col("__v")) & (e["yh"] >= y0)

    def at_corner(e):
        return e["dx"] * (y0 - e["y1"]) - e["dy"] * (x0 - e["x1"])

    def crosses(m):                              # as _crosses, with its terms at hand
        zero, e, hair = F.lit(0.0), m["e"], m["e"]["reach"] * s * F.lit(1e-9)
        return (m["base"] + F.least(zero, e["dx"] * s) + F.least(zero, -e["dy"] * s) <= hair) & \
               (m["base"] + F.greatest(zero, e["dx"] * s) + F.greatest(zero, -e["dy"] * s) >= -hair)

    def local(m):
        e, base = m["e"], m["base"]
        return F.struct(*[e[k].alias(k) for k in ENDS], e["tie"].alias("tie"),
                        ((base > 0) | ((base == 0) & e["tie"])).alias("left"), ((e["x1"] > x0) != (e["x2"] > x0)).alias("over"))

    def right(e):                                # as _right_of
        side = at_corner(e)
        return ((e["y1"] > y0) != (e["y2"] > y0)) & F.when(e["y2"] > e["y1"], side > 0).otherwise(side < 0)

    def part(p):
        corner = F.size(F.filter(p, right)) % 2 == 1
        met = F.transform(F.filter(p, near), lambda e: F.struct(e.alias("e"), at_corner(e).alias("base")))
        return F.struct(corner.alias("corner"), F.transform(F.filter(met, crosses), local).alias("edges"))

    return _finished(rows.select(*CELL, F.transform("pe", part).alias("parts")))


def build_cover(polys: DataFrame, *, max_edges: int = 16, max_splits: int = 8, stage_mode: str | None = "checkpoint",
                most_edges: int | None = None) -> DataFrame:
    """pid, lvl, cx, cy, inside, parts (corner inside, edges) of every cell a polygon meets.

    ``polys``: pid, pe, edges, box, lvl (``boxed``), staged.  ``most_edges``, if known, tells
    when no cell can need a split."""
    small = _cover_in_row(polys.where(F.size("edges") <= max_edges))
    if most_edges is not None and most_edges <= max_edges:
        return small
    polys = polys.where(F.size("edges") > max_edges)
    edges = polys.select("pid", "lvl", F.posexplode("pe").alias("p", "es")).select("pid", "lvl", "p", F.explode("es").alias("e")).select("pid", "lvl", "p", "e.*")
    cells = explode_cells(polys.select("pid", "lvl", "xmin", "ymin", "xmax", "ymax"), F.col("lvl")).select(*CELL)
    parts = _edges_in(edges)
    done_cells, done_parts = [], []
    for _ in range(max_splits):
        parts = stage(parts, stage_mode)
        full = stage(parts.groupBy(*CELL).agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > max_edges).select(*CELL), stage_mode)
        if full.isEmpty():
            break
        done_cells.append(cells.join(full, CELL, "left_anti"))
        done_parts.append(parts.join(full, CELL, "left_anti"))
        finer = F.col("lvl") - STEP
        four = F.array(*[F.lit(k).cast("long") for k in range(1 << STEP)])
        cells = full.withColumn("i", F.explode(four)).withColumn("j", F.explode(four)).select(
            "pid", finer.alias("lvl"), (F.shiftleft("cx", STEP) + F.col("i")).alias("cx"), (F.shiftleft("cy", STEP) + F.col("j")).alias("cy"))
        parts = _edges_in(parts.join(full, CELL).withColumn("lvl", finer), within=True)
    for c, p in zip(done_cells, done_parts):
        cells, parts = cells.unionByName(c), parts.unionByName(p)
    cells = stage(cells, stage_mode) if done_cells else cells
    x0, y0, _ = _corner()
    edge = _local_edge(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"), x0, y0)
    rows = parts.select(*CELL, "p", edge.alias("e"), F.lit(False).alias("corner"))
    inside = _corners_inside(cells, polys).select(*CELL, "p", F.lit(None).cast(rows.schema["e"].dataType).alias("e"), F.lit(True).alias("corner"))
    per_part = rows.unionByName(inside).groupBy(*CELL, "p").agg(F.max("corner").alias("corner"), F.collect_list("e").alias("edges"))
    # of the parts that hold the whole cell, one says as much as all
    whole = (F.size("edges") == 0) & F.col("corner")
    got = per_part.groupBy(*CELL).agg(F.max(F.when(whole, F.struct("corner", "edges"))).alias("w"),
                                      F.collect_list(F.when(~whole, F.struct("corner", "edges"))).alias("parts"))
    got = got.withColumn("parts", F.when(F.col("w").isNotNull(), F.array("w")).otherwise(F.col("parts")))
    return small.unionByName(_finished(got))


def in_cell(px: Column, py: Column, x0: Column) -> Column:
    """Whether a point of the row's cell (left side ``x0``, inside, parts) meets the polygon."""

    def crossed(e):
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
        up = dx * (py - e["y1"])
        side, here = up - dy * (x0 - e["x1"]), up - dy * (px - e["x1"])
        foot = (side > 0) | ((side == 0) & e["tie"])             # the corner of the way: (x0, py)
        mine = (here > 0) | ((here == 0) & e["tie"])
        turns = (e["over"] & (e["left"] != foot)).cast("long") + (((e["y1"] > py) != (e["y2"] > py)) & (foot != mine)).cast("long")
        on = (here == 0) & between(px, e["x1"], e["x2"]) & between(py, e["y1"], e["y2"])
        return F.when(on, F.lit(1 << 32)).otherwise(turns)

    def in_part(p):
        n = F.aggregate(p["edges"], F.lit(0).cast("long"), lambda acc, e: acc + crossed(e))
        return (n >= (1 << 32)) | ((n % 2 == 1) != p["corner"])

    return F.col("inside") | F.exists("parts", in_part)


def in_shape(x: Column, y: Column, parts: Column) -> Column:
    """Whether a point meets an areal shape given by its edges by part."""
    def crossing(e):
        side = orient(e["x1"], e["y1"], e["x2"], e["y2"], x, y)
        on = (side == 0) & between(x, e["x1"], e["x2"]) & between(y, e["y1"], e["y2"])
        turn = ((e["y1"] > y) != (e["y2"] > y)) & ((side > 0) == (e["y2"] > e["y1"]))
        return F.when(on, F.lit(1 << 32)).otherwise(turn.cast("long"))

    def in_part(p):
        n = F.aggregate(p, F.lit(0).cast("long"), lambda acc, e: acc + crossing(e))
        return (n >= (1 << 32)) | (n % 2 == 1)

    return F.exists(parts, in_part)


def edges_meet(a: Column, b: Column) -> Column:
    """Whether two closed segments meet."""
    d1 = orient(b["x1"], b["y1"], b["x2"], b["y2"], a["x1"], a["y1"])
    d2 = orient(b["x1"], b["y1"], b["x2"], b["y2"], a["x2"], a["y2"])
    d3 = orient(a["x1"], a["y1"], a["x2"], a["y2"], b["x1"], b["y1"])
    d4 = orient(a["x1"], a["y1"], a["x2"], a["y2"], b["x2"], b["y2"])
    proper = (F.signum(d1) * F.signum(d2) < 0) & (F.signum(d3) * F.signum(d4) < 0)
    touch = (((d1 == 0) & between(a["x1"], b["x1"], b["x2"]) & between(a["y1"], b["y1"], b["y2"])) |
             ((d2 == 0) & between(a["x2"], b["x1"], b["x2"]) & between(a["y2"], b["y1"], b["y2"])) |
             ((d3 == 0) & between(b["x1"], a["x1"], a["x2"]) & between(b["y1"], a["y1"], a["y2"])) |
             ((d4 == 0) & between(b["x2"], a["x1"], a["x2"]) & between(b["y2"], a["y1"], a["y2"])))
    return proper | touch

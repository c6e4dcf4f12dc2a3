"""Distributed spatial join with the closed ``intersects`` predicate.

No theta join appears in the plan: every step is an equi join that Spark can run as a
shuffled or (when AQE measures a side as small) broadcast hash join.

Point x polygon (the common case): points meet the cells of the polygons' adaptive cover
(``geoprep.operators.cover``) on (level, cx, cy); a candidate is decided in its row, from the
few edges of its cell, so nothing is shuffled after that join, whatever the polygon's size.

Other left geometries (lines, polygons, multi-points, collections): A meets B iff a
representative vertex of a part of A lies in B, or an edge of A meets an edge of B, or
(areal parts of A) a representative vertex of a part of B lies in A.  The first test reuses the
point path; the other two run on the pairs whose boxes overlap, against the edges that the
cells of B's cover hold.

The polygon side is prepared once into a ``PolygonIndex`` (staged) and can be reused across
joins and chunks; it may hold several layers, which are then matched in one pass.  The left
side is staged once too (it feeds several branches); a count of its non-point geometries,
taken in the same job, lets point-only inputs skip the shape path entirely.

All arithmetic is division-free where a sign decides (ANSI mode raises on x/0, and the
order of AND operands is not promised).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoprep.functions import geometry as G
from geoprep.operators import cover as C
from geoprep.operators.stage import stage, stage_table, stage_with_metrics


# ---------------------------------------------------------------------------------------
# The indexed side


@dataclass
class PolygonIndex:
    """Right sides prepared for joins: polygons (pid, box, representative vertices), the cells of
    their covers, the grid levels of the cells and of the polygons, and per layer the right rows' other columns
    keyed by ``__mrid``, all staged.  Build it once with ``index_polygons`` or
    ``index_layers`` and reuse it, e.g. for every chunk of an incremental load."""

    polys: DataFrame
    cells: DataFrame
    levels: list
    own_levels: list
    layers: list                        # (attrs, columns); a pid is row number * layers + layer
    max_edges: int

    def layer_and_row(self, pid: str = "pid") -> list:
        return [F.expr(f"cast({pid} % {len(self.layers)} as int)").alias("layer"), F.expr(f"{pid} div {len(self.layers)}").alias("__mrid")]

    @property
    def attrs(self) -> DataFrame:
        return self.layers[0][0]

    @property
    def columns(self) -> list:
        return self.layers[0][1]


def index_layers(rights: list, *, right_geom: str = "geometry", max_edges: int = 16,
                 stage_mode: str | None = "checkpoint") -> PolygonIndex:
    """One index over the polygons of several right sides, told apart by their layer (0, 1, ...).

    A right row's key is a number given while it is staged, so rows need no unique column and
    equal rows each match.  ``max_edges`` bounds the edges a point is tested against; it does
    not change results."""
    shapes, layers = [], []
    for k, right in enumerate(rights):
        cols = [c for c in right.columns if c != right_geom]
        rows = stage_table(right.select(F.monotonically_increasing_id().alias("__mrid"), F.col(right_geom).alias("__g"), *cols), "layer")
        layers.append((rows.drop("__g"), cols))
        areal = F.col("__g").isNotNull() & F.col("__g")["kind"].isin(*G.AREAL)
        shapes.append(rows.where(areal).select((F.col("__mrid") * len(rights) + k).alias("pid"), "__g"))
    parts = int(rights[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    polys = C.boxed(reduce(DataFrame.unionByName, shapes).repartition(parts, "pid"), "__g", "pid").withColumn("reps", C.rep_vertices(F.col("g"))).drop("g")
    polys, m = stage_with_metrics(polys, stage_mode, {"most": F.max(F.size("edges")), "levels": F.collect_set("lvl")})
    cells = C.build_cover(polys, max_edges=max_edges, stage_mode=stage_mode, most_edges=m["most"] or 0)
    cells, c = stage_with_metrics(cells, stage_mode, {"levels": F.collect_set("lvl")})
    return PolygonIndex(polys, cells, sorted(c["levels"] or []), sorted(m["levels"] or []), layers, max_edges)


def index_polygons(right: DataFrame, *, right_geom: str = "geometry", max_edges: int = 16,
                   stage_mode: str | None = "checkpoint") -> PolygonIndex:
    """Prepare one polygon side (``index_layers``)."""
    return index_layers([right], right_geom=right_geom, max_edges=max_edges, stage_mode=stage_mode)


# ---------------------------------------------------------------------------------------
# Point in polygon


def points_in_polygons(points: DataFrame, index: PolygonIndex) -> DataFrame:
    """Points (px, py, ...) x indexed polygons -> hits (the columns of ``points``, pid), closed test."""
    at = F.explode(F.array(*[F.lit(int(x)) for x in index.levels]).cast("array<int>")).alias("lvl")
    keyed = points.select("*", at)
    keyed = keyed.withColumns({"cx": C.cell_of(F.col("px"), F.col("lvl")), "cy": C.cell_of(F.col("py"), F.col("lvl"))})
    met = keyed.join(index.cells, ["lvl", "cx", "cy"]).withColumn("x0", F.col("cx") * F.pow(F.lit(2.0), F.col("lvl")))
    return met.where(C.in_cell(F.col("px"), F.col("py"), F.col("x0"))).select(*points.columns, "pid")


# ---------------------------------------------------------------------------------------
# Non-point left geometries


def _candidate_pairs(a: DataFrame, b: DataFrame, b_levels: list) -> DataFrame:
    """Box-overlap pairs (gid, pid) between left shapes ``a`` and polygons ``b``.

    A pair is found at exactly one level, max(level a, level b), in two equi joins:
    (1) A keyed at every coarser level that B uses meets B at B's own level;
    (2) A at its own level meets B keyed at its own or any coarser level (B is the
    polygon side, keyed at most once per level up to E_MAX).  Within the level the pair
    is kept only in the cell holding the lower-left corner of the boxes' overlap.
    """
    def boxes(df, key, prefix):
        return df.select(key, F.col("lvl").alias(f"l{prefix}"), *[F.col(c).alias(f"{prefix}{c}")
                                                              for c in ("xmin", "ymin", "xmax", "ymax")])

    def cells(df, prefix, level):
        return C.explode_cells(df.withColumn("L", level), level, f"{prefix}xmin", f"{prefix}ymin", f"{prefix}xmax", f"{prefix}ymax")

    ab, bb = boxes(a, "gid", "a"), boxes(b, "pid", "b")
    coarser = F.explode(F.array(*[F.lit(int(x)) for x in b_levels]).cast("array<int>"))
    a_up = cells(ab.withColumn("__L", coarser).where(F.col("__L") > F.col("la")), "a", F.col("__L")).drop("__L")
    b_own = cells(bb, "b", F.col("lb"))
    j1 = a_up.join(b_own, ["L", "cx", "cy"])
    a_own = cells(ab, "a", F.col("la"))
    top = C.STEP * -(-C.E_MAX // C.STEP)
    b_up = cells(bb.withColumn("__L", F.explode(F.sequence(F.col("lb"), F.lit(top), F.lit(C.STEP)))),
                 "b", F.col("__L")).drop("__L")
    j2 = a_own.join(b_up, ["L", "cx", "cy"])
    j = j1.unionByName(j2)
    j = j.where((F.col("axmin") <= F.col("bxmax")) & (F.col("bxmin") <= F.col("axmax")) &
                (F.col("aymin") <= F.col("bymax")) & (F.col("bymin") <= F.col("aymax")))
    rx, ry = F.greatest("axmin", "bxmin"), F.greatest("aymin", "bymin")
    j = j.where((C.cell_of(rx, F.col("L")) == F.col("cx")) & (C.cell_of(ry, F.col("L")) == F.col("cy")))
    return j.select("gid", "pid")


def _shape_hits(pairs: DataFrame, a: DataFrame, index: PolygonIndex) -> DataFrame:
    """The pairs with some edge of A meeting some edge of B, or a representative vertex of a
    part of B in an areal part of A.  B comes as the edges of its cells and as one row of vertices."""
    s = F.pow(F.lit(2.0), F.col("lvl"))
    held = F.flatten(F.transform("parts", lambda p: F.transform(p["edges"], lambda e: F.struct(e["x1"].alias("x1"), e["y1"].alias("y1"), e["x2"].alias("x2"), e["y2"].alias("y2")))))
    reps = index.polys.select("pid", "reps")
    borders = index.cells.where(F.size("parts") > 0).select(
        "pid", (F.col("cx") * s).alias("bx0"), (F.col("cy") * s).alias("by0"), ((F.col("cx") + 1) * s).alias("bx1"), ((F.col("cy") + 1) * s).alias("by1"),
        held.alias("be"), F.lit(None).cast(reps.schema["reps"].dataType).alias("reps"))
    whole = index.polys.select("pid", F.col("xmin").alias("bx0"), F.col("ymin").alias("by0"), F.col("xmax").alias("bx1"), F.col("ymax").alias("by1"),
                               F.lit(None).cast(borders.schema["be"].dataType).alias("be"), "reps")
    j = pairs.join(a.select("gid", "edges", "inner", "xmin", "ymin", "xmax", "ymax"), "gid").join(borders.unionByName(whole), "pid")
    j = j.where((F.col("xmin") <= F.col("bx1")) & (F.col("bx0") <= F.col("xmax")) & (F.col("ymin") <= F.col("by1")) & (F.col("by0") <= F.col("ymax")))
    near = F.filter("edges", lambda e: (F.least(e["x1"], e["x2"]) <= F.col("bx1")) & (F.greatest(e["x1"], e["x2"]) >= F.col("bx0")) &
                    (F.least(e["y1"], e["y2"]) <= F.col("by1")) & (F.greatest(e["y1"], e["y2"]) >= F.col("by0")))
    crossing = F.exists(near, lambda e: F.exists("be", lambda f: C.edges_meet(e, f)))
    inside = F.exists("reps", lambda v: (v["x"] >= F.col("xmin")) & (v["x"] <= F.col("xmax")) & (v["y"] >= F.col("ymin")) & (v["y"] <= F.col("ymax")) &
                      C.in_shape(v["x"], v["y"], F.col("inner")))
    return j.where(F.when(F.col("be").isNotNull(), crossing).otherwise(inside)).select("gid", "pid")


def prepare_left_shapes(left: DataFrame, *, left_geom: str = "geometry", stage_mode: str | None = "checkpoint") -> DataFrame:
    """The distinct non-point geometries of ``left`` with a number, box, level and edges, staged
    once; pass it as ``left_shapes`` to reuse it across several matches."""
    g = F.col(left_geom)
    shapes = left.where(g.isNotNull() & (g["kind"] != G.POINT)).select(g.alias("gk")).distinct()
    shapes = C.boxed(shapes.withColumn("gid", F.monotonically_increasing_id()), "gk", "gid")
    areal = F.filter(F.transform("pe", lambda p, i: F.when(G.areal_part(F.col("g"), i), p)), lambda p: p.isNotNull())
    return stage_table(shapes.select("gid", F.col("g").alias("gk"), "edges", areal.alias("inner"), "xmin", "ymin", "xmax", "ymax", "lvl"), "left-shapes")


def intersecting_pairs(left: DataFrame, index: PolygonIndex, *, left_geom: str = "geometry",
                       has_shapes: bool | None = None, left_shapes: DataFrame | None = None,
                       stage_mode: str | None = "checkpoint"):
    """Matches between the distinct geometries of ``left`` and the indexed polygons.

    Returns (point_pairs, shape_pairs): point_pairs(px, py, pid) for left points and
    shape_pairs(gk, pid) for other left geometries (gk = the geometry itself), or None
    when the left side has no other geometries (``has_shapes``; found out when not given).
    """
    g = F.col(left_geom)
    pts = left.where(g.isNotNull() & (g["kind"] == G.POINT)).select(
        G.point_x(g).alias("px"), G.point_y(g).alias("py"))
    if has_shapes is None:
        has_shapes = not left.where(g.isNotNull() & (g["kind"] != G.POINT)).isEmpty()
    pts = pts.where(F.col("px").isNotNull() & F.col("py").isNotNull())
    hits = points_in_polygons(pts.distinct(), index)
    if not has_shapes:
        return hits, None
    a = left_shapes if left_shapes is not None else prepare_left_shapes(left, left_geom=left_geom, stage_mode=stage_mode)
    # a shape's vertices carry its number through the point path: no join back on coordinates
    reps = a.select("gid", F.explode(C.rep_vertices(F.col("gk"))).alias("v")).select("gid", F.col("v.x").alias("px"), F.col("v.y").alias("py"))
    inside = points_in_polygons(reps, index).select("gid", "pid")
    cand = _candidate_pairs(a, index.polys, index.own_levels)
    shape_pairs = inside.unionByName(_shape_hits(cand, a, index)).distinct().join(a.select("gid", "gk"), "gid").select("gk", "pid")
    return hits, shape_pairs


_NON_POINT = "__non_point_geometries"


def _stage_left(left: DataFrame, left_geom: str, stage_mode):
    """Stage the left side; count its non-point geometries in the same pass."""
    g = F.col(left_geom)
    staged, m = stage_with_metrics(left, stage_mode,
                                   {_NON_POINT: F.count(F.when(g.isNotNull() & (g["kind"] != G.POINT), 1))})
    return staged, bool(m[_NON_POINT])


def _match_keys(left: DataFrame, left_geom: str) -> DataFrame:
    """Left rows with their join keys: (__px, __py) for points, __gk for other geometries.  A
    row without a geometry gets a key of its own that no match has (no y is NaN), so such rows
    are spread over the tasks instead of sharing one key."""
    g = F.col(left_geom)
    is_pt = g.isNotNull() & (g["kind"] == G.POINT)
    return left.withColumns({
        "__px": F.when(is_pt, G.point_x(g)).when(g.isNull(), F.monotonically_increasing_id().cast("double")),
        "__py": F.when(is_pt, G.point_y(g)).when(g.isNull(), F.lit(float("nan"))),
        "__gk": F.when(g.isNotNull() & ~is_pt, g)})


def _pairs(left: DataFrame, index: PolygonIndex, left_geom: str, has_shapes=None, left_shapes=None,
           stage_mode="checkpoint") -> DataFrame:
    """(__qx, __qy, __qg, layer, __mrid): one row per (distinct left geometry, polygon) hit."""
    point_pairs, shape_pairs = intersecting_pairs(left, index, left_geom=left_geom, has_shapes=has_shapes,
                                                  left_shapes=left_shapes, stage_mode=stage_mode)
    place = index.layer_and_row()
    pairs = point_pairs.select(F.col("px").alias("__qx"), F.col("py").alias("__qy"),
                               F.lit(None).cast(G.GEOM).alias("__qg"), *place)
    if shape_pairs is None:
        return pairs
    return pairs.unionByName(shape_pairs.select(
        F.lit(None).cast("double").alias("__qx"), F.lit(None).cast("double").alias("__qy"),
        F.col("gk").alias("__qg"), *place))


def _join_back(lk: DataFrame, pairs: DataFrame, how: str) -> DataFrame:
    cond = [lk["__px"].eqNullSafe(pairs["__qx"]), lk["__py"].eqNullSafe(pairs["__qy"]),
            lk["__gk"].eqNullSafe(pairs["__qg"])]
    return lk.join(pairs, cond, how).drop("__px", "__py", "__gk", "__qx", "__qy", "__qg")


def _index_of(right, right_geom, max_edges, stage_mode) -> PolygonIndex:
    if isinstance(right, PolygonIndex):
        return right
    return index_polygons(right, right_geom=right_geom, max_edges=max_edges, stage_mode=stage_mode)


def _check(left, index: PolygonIndex, how, predicate):
    if predicate != "intersects":
        raise ValueError("only the 'intersects' predicate is supported")
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    clash = set(index.columns) & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}; rename them first")


def spatial_join(left: DataFrame, right, *, how: str = "left", predicate: str = "intersects",
                 left_geom: str = "geometry", right_geom: str = "geometry", max_edges: int = 16,
                 stage_mode: str | None = "checkpoint") -> DataFrame:
    """``left`` rows with the columns of every ``right`` row whose polygon meets their geometry.

    A left row meeting n right rows gives n rows; with ``how="left"`` a row meeting none
    (or with a null geometry) is kept once with nulls on the right.  The right geometry
    column is not returned.  ``right`` is a DataFrame or a ``PolygonIndex``.  The left
    side feeds three branches (points, other shapes, the join back), so it is staged once
    (``stage_mode``, see ``geoprep.operators.stage``).
    """
    index = _index_of(right, right_geom, max_edges, stage_mode)
    _check(left, index, how, predicate)
    left, shapes = _stage_left(left, left_geom, stage_mode)
    pairs = _pairs(left, index, left_geom, shapes, stage_mode=stage_mode).drop("layer").join(index.attrs, "__mrid").drop("__mrid")
    return _join_back(_match_keys(left, left_geom), pairs, how).select(*left.columns, *index.columns)


def first_match(left: DataFrame, right, order, *, how: str = "left", left_geom: str = "geometry",
                right_geom: str = "geometry", max_edges: int = 16, stage_mode: str | None = "checkpoint") -> DataFrame:
    """``left`` rows with the columns of ONE matching ``right`` row per distinct geometry:
    the first by ``order`` (columns of ``right``, ascending, nulls first -- wrap a column
    in ``F.isnull`` first to put nulls last).  Left rows never multiply (A4 + J4).

    The pick is an aggregate (``min`` of a struct) per distinct geometry, so it combines
    map-side and does not sort a geometry's matches inside one task.
    """
    index = _index_of(right, right_geom, max_edges, stage_mode)
    _check(left, index, how, "intersects")
    left, shapes = _stage_left(left, left_geom, stage_mode)
    best = _best(_pairs(left, index, left_geom, shapes, stage_mode=stage_mode).join(index.attrs, "__mrid"),
                 index.columns, order)
    joined = _join_back(_match_keys(left, left_geom), best, how)
    return joined.select(*left.columns, *index.columns)


def _best(table: DataFrame, rcols: list, order) -> DataFrame:
    ordered = F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(order)], F.struct(*rcols).alias("__row"))
    best = table.groupBy("__qx", "__qy", "__qg").agg(F.min(ordered).alias("__ord"))
    return best.select("__qx", "__qy", "__qg", *[F.col("__ord.__row")[c].alias(c) for c in rcols])


def match_table(left: DataFrame, right, *, left_geom: str = "geometry", right_geom: str = "geometry",
                max_edges: int = 16, stage_mode: str | None = "checkpoint", has_shapes: bool | None = None,
                left_shapes: DataFrame | None = None) -> DataFrame:
    """All (distinct left geometry, right row) hits as (__qx, __qy, __qg, <right columns>);
    join it to ``with_match_keys(left)`` with ``join_matches``.  ``right`` is a DataFrame
    or a ``PolygonIndex``; ``has_shapes`` says whether the left side has non-point
    geometries (found out when not given)."""
    index = _index_of(right, right_geom, max_edges, stage_mode)
    if has_shapes is None:
        left, has_shapes = _stage_left(left, left_geom, stage_mode)
    else:
        left = stage(left, stage_mode)
    return (_pairs(left, index, left_geom, has_shapes, left_shapes, stage_mode)
            .drop("layer").join(index.attrs, "__mrid").drop("__mrid"))


def match_layers(left: DataFrame, index: PolygonIndex, *, left_geom: str = "geometry", has_shapes: bool | None = None,
                 stage_mode: str | None = "checkpoint") -> list:
    """``match_table`` for every layer of an index, from one pass over the geometries: the hits
    of all layers are staged together (keys and a number) and split at the end."""
    hits = stage_table(_pairs(left, index, left_geom, has_shapes, stage_mode=stage_mode), "layer-hits")
    return [hits.where(F.col("layer") == k).drop("layer").join(attrs, "__mrid").drop("__mrid") for k, (attrs, _) in enumerate(index.layers)]


def first_match_table(left: DataFrame, right, order, **kw) -> DataFrame:
    """One right row per distinct left geometry, the first by ``order`` (see ``first_match``)."""
    return first_of(match_table(left, right, **kw), order)


def first_of(t: DataFrame, order) -> DataFrame:
    """The first row by ``order`` per distinct left geometry of a match table."""
    rcols = [c for c in t.columns if c not in ("__qx", "__qy", "__qg")]
    return _best(t, rcols, order)


def with_match_keys(left: DataFrame, left_geom: str = "geometry") -> DataFrame:
    return _match_keys(left, left_geom)


def join_matches(keyed_left: DataFrame, table: DataFrame, how: str = "left") -> DataFrame:
    """Join a match table back on the geometry keys; the keys of ``table`` are dropped,
    those of ``keyed_left`` kept for further matches."""
    cond = [keyed_left["__px"].eqNullSafe(table["__qx"]), keyed_left["__py"].eqNullSafe(table["__qy"]),
            keyed_left["__gk"].eqNullSafe(table["__qg"])]
    return keyed_left.join(table, cond, how).drop("__qx", "__qy", "__qg")

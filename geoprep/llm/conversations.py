"""Operator 13: cheapest repair of conversations by an auction shortest-path algorithm.

A conversation is a lattice: a layer per gap between its rows, and in each layer the four
states of the pattern ``(s?(ua)+)?`` (nothing yet, after the system row, a user open, answered).
Keep, Rerole and Delete lead from a layer to the next, Insert stays in it; costs are integers.

1. Rows are numbered per conversation (``sequence_within``: a conversation of any length is
   cut across partitions), faults are marked, and runs of ``run_rows`` rows become codes.
2. Auction: a path grows from the origin over arcs with price[i] = cost + price[j] and
   shrinks, raising its end's price to the least cost + price[j], where there is none.  When it
   meets a node whose price is final, so are the prices on the path.
3. Trace: from the origin, the arc with the least initial is taken whose end, made final by an
   auction of its own, still has price[i] = cost + price[j]: the ASCII-least cheapest edits.
4. A conversation of several runs: for each run, the auction's prices of the ways from four
   entry states to four exit states; ``states_along`` passes the remaining cost backwards and,
   after the traces from each entry, the states forwards.  A single run needs neither.

Null role and text count as one space; rows of equal turn go by role and text.  An initial is the role's
first character (none for an empty one).  Of rows that repeat role and text, the first is the
original.  A null conv_id is a conversation of its own.  Other columns are not read.  Hashing a
repaired conversation is a stream through one task, as its digest is; it holds a row at a time.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoprep.operators.numbering import LONGS, join_null_safe, sequence_within, states_along

from .common import staged

NONE, SYSTEM, USER, ANSWERED = range(4)
INITIAL = {"s": 0, "u": 1, "a": 2}
OTHER = 3                                    # an initial of no role
TRUNCATED, REFUSED = 4, 8                    # flags of a row's code; refused: blank or duplicate
RETYPE, REMOVE, ADD, CUT_OFF = 2, 3, 2, 1    # costs
FAR = 1 << 40                                # no way
SPACE = " \t\n\x0b\x0c\r"
#: The state after a role initial, by state; absent: not allowed.
NEXT = {(NONE, 0): SYSTEM, (NONE, 1): USER, (SYSTEM, 1): USER, (USER, 2): ANSWERED, (ANSWERED, 1): USER}
ENDS = (0, FAR, FAR, 0)                      # the pattern may end before any row or after an answer


class Lattice:
    """One run of row codes; ``ends``: cost from each state after its last row to the end."""

    def __init__(self, codes: bytes, ends, last: bool):
        self.codes, self.ends, self.last = codes, ends, last
        self.goal = 4 * (len(codes) + 1)
        self.price = [0] * (self.goal + 1)
        self.final = {self.goal}
        self.out = [None] * self.goal

    def arcs(self, node: int) -> list:
        """(initial, role given, cost, next node), by initial."""
        if self.out[node] is None:
            layer, q = divmod(node, 4)
            role = 2 if q == USER else 1                                # what may be inserted or given
            turn = NEXT[q, role]
            add = ("I", role, ADD, 4 * layer + turn)
            if layer == len(self.codes):
                out = [("", 0, self.ends[q], self.goal)] if self.ends[q] < FAR else []
                out += [add] if self.last else []
            else:
                code = self.codes[layer]
                out = [("D", 0, REMOVE, node + 4), add]
                if not code & REFUSED:
                    more = CUT_OFF if code & TRUNCATED else 0
                    if (q, code & 3) in NEXT:
                        out.append(("K", 0, more, 4 * layer + 4 + NEXT[q, code & 3]))
                    out.append(("R", role, RETYPE + more, 4 * layer + 4 + turn))
            self.out[node] = out
        return self.out[node]

    def auction(self, origin: int) -> int:
        """The final price of ``origin``: its cheapest way to the goal (FAR: none)."""
        price, final, path = self.price, self.final, [origin]
        while path[-1] not in final:
            node, least, to = path[-1], FAR, -1
            for _, _, cost, j in self.arcs(node):
                if cost + price[j] < least:
                    least, to = cost + price[j], j
            if to < 0:                                                  # contract for good: no way on
                price[node] = FAR
                final.add(node)
                path.pop()
                if not path:
                    return FAR
            elif price[node] < least:
                price[node] = least
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
        final.update(path)
        return price[origin]

    def trace(self, state: int) -> tuple[tuple, int]:
        """The ASCII-least cheapest edits from ``state``, per row (and one entry after the last),
        each an initial and the role given; and the state they end in."""
        node, rows = state, [""] * (len(self.codes) + 1)
        self.auction(node)
        while True:
            for initial, role, cost, j in self.arcs(node):
                if self.price[node] == cost + self.price[j]:
                    self.auction(j)
                    if self.price[node] == cost + self.price[j]:
                        break
            if j == self.goal:
                return tuple(rows), node % 4
            rows[node // 4] += initial + ".ua"[role]
            node = j


@lru_cache(1 << 14)
def solve(codes: bytes, ends: tuple, last: bool) -> tuple:
    """For each entry state: its cost (FAR: no way), edits per row and exit state."""
    lattice = Lattice(codes, ends, last)
    return tuple((lattice.price[q], *lattice.trace(q)) if lattice.auction(q) < FAR else (FAR, (), q) for q in range(4))


@lru_cache(1 << 14)
def solve_whole(codes: bytes) -> tuple:
    lattice = Lattice(codes, ENDS, True)
    return (*lattice.trace(NONE), lattice.price[NONE])


@lru_cache(1 << 14)
def run_costs(codes: bytes) -> tuple:
    """Costs from every entry state to every exit state of a run, entry after entry."""
    out = [FAR] * 16
    for q in range(4):
        lattice = Lattice(codes, tuple(0 if k == q else FAR for k in range(4)), False)
        for p in range(4):
            if q >= USER or p == q or (p, q) == (NONE, SYSTEM) and any(c in (0, TRUNCATED) for c in codes):      # a way exists
                out[4 * p + q] = lattice.auction(p)
    return tuple(out)


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults, by the checksum of ``conv_id:turn``: dropped, emptied, without
    full stops, repeated, or made the user's."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", blank("conv_id"), blank("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), kind.alias("k")).where("k <> 0")
    text = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("k") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "k")
    return rows.withColumn("copy", F.explode(F.expr("sequence(1, if(k = 3, 2, 1))"))).drop("k", "copy")


def repair(conversations: DataFrame, run_rows: int = 32) -> tuple[DataFrame, DataFrame]:
    """(edits, summary) for rows conv_id, turn, role, text.

    edits: conv_id, seq, role, text (of the row) and ops: two letters an edit, the initial and
    the role given (u, a; . for none); Inserts stand before their row, or after the last one.
    summary: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.
    """
    text = F.coalesce("text", F.lit(" "))
    role = F.coalesce("role", F.lit(" "))
    rows = staged(conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                                       F.monotonically_increasing_id().alias("uid")), "talk-rows")
    kept = F.rtrim("text", F.lit(SPACE))
    first = F.substring("role", 1, 1)
    initial = F.coalesce(*[F.when(first == k, v) for k, v in INITIAL.items()], F.lit(OTHER))
    narrow = rows.select("conv_id", "turn", "role", "uid", F.sha2("text", 256).alias("h"), initial.alias("initial"),
                         (kept == "").alias("empty"), (~F.substring(kept, -1, 1).isin(".", "!", "?")).alias("open"))
    narrow = staged(sequence_within(narrow, ["conv_id"], [F.col("turn").asc_nulls_first(), "role", "h"]), "talk-numbered")
    original = narrow.groupBy("conv_id", "role", "h").agg(F.min(F.struct("seq", "uid"))["uid"].alias("uid")).select("uid", F.lit(True).alias("original"))
    fault = F.when(F.col("empty"), "blank").when(F.col("original").isNull(), "duplicate").when(F.col("open"), "truncated")
    marked = narrow.join(original, "uid", "left").withColumn("fault", fault).withColumn(
        "code", F.col("initial") + F.when(F.col("fault") == "truncated", TRUNCATED).when(F.col("fault").isNotNull(), REFUSED).otherwise(0))
    per_run = marked.withColumn("__seg", F.expr(f"(seq - 1) div {int(run_rows)}")).groupBy("conv_id", "__seg").agg(
        F.sort_array(F.collect_list(F.struct("seq", "uid", F.col("code").cast("byte").alias("code")))).alias("r"),
        *[F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in ("blank", "duplicate", "truncated")],
        F.min("turn").alias("lo"), F.max("turn").alias("hi"))
    runs = staged(per_run.withColumn("codes", F.col("r.code")), "talk-runs")
    turns = narrow.where("turn IS NOT NULL").groupBy("conv_id", "turn").agg(F.lit(1).alias("n")).groupBy("conv_id").agg(F.sum("n").alias("turns"))

    solved = _solve_runs(runs)
    # what stands between two runs: the last initial of one and the first of the next
    after = runs.select("conv_id", (F.col("__seg") - 1).alias("__seg"), (F.get("codes", F.lit(0)) % 4).alias("then"))
    joined = join_null_safe(runs.drop("r"), after, ["conv_id", "__seg"], "left")
    joined = join_null_safe(joined, solved.select("conv_id", "__seg", "ops", "cost"), ["conv_id", "__seg"])
    follows = F.when(F.col("then").isNotNull(), F.array_append(F.transform("codes", lambda c: (c % 4).cast("int")), F.col("then").cast("int"))) \
        .otherwise(F.transform("codes", lambda c: (c % 4).cast("int")))
    legal = lambda a, b: ((a == 0) & (b == 1)) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1))
    illegal = F.size(F.filter(F.zip_with(F.slice("f", 1, F.size("f") - 1), F.slice("f", 2, F.size("f") - 1), legal), lambda x: ~x))
    joined = joined.withColumn("f", follows).withColumn("illegal", illegal)
    summary = joined.groupBy("conv_id").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")],
        F.max("cost").alias("cost"), F.sort_array(F.collect_list(F.struct("__seg", F.array_join("ops", "").alias("o")))).alias("o"))
    audit = F.regexp_replace(F.array_join("o.o", ""), "(.).", "$1")
    gaps = F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("turns"), F.lit(0))
    summary = join_null_safe(summary, turns, ["conv_id"], "left").select(
        "conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", F.col("illegal").cast("long").alias("illegal"),
        F.col("cost").cast("long").alias("cost"), audit.alias("audit"))
    each = join_null_safe(runs.select("conv_id", "__seg", "r"), solved.select("conv_id", "__seg", "ops"), ["conv_id", "__seg"])
    each = each.select(F.explode(F.arrays_zip(F.col("r.uid").alias("uid"), F.col("r.seq").alias("seq"), F.col("ops").alias("ops"))).alias("z")) \
        .select("z.uid", "z.seq", "z.ops")
    return rows.join(each, "uid").select("conv_id", "seq", "role", "text", "ops"), summary


def _solve_runs(runs: DataFrame) -> DataFrame:
    """conv_id, __seg, ops (per row; the edits after the last row join its own), cost (of the
    whole conversation, on its first run)."""
    last = runs.groupBy("conv_id").agg(F.max("__seg").alias("last"))
    ours = join_null_safe(runs.select("conv_id", "__seg", "codes"), last, ["conv_id"])

    @F.pandas_udf("ops array<string>, cost long")
    def whole(codes: pd.Series) -> pd.DataFrame:
        rows = [solve_whole(bytes(c.tolist())) for c in codes]
        return pd.DataFrame({"ops": [_per_row(r[0]) for r in rows], "cost": [r[2] for r in rows]})

    short = ours.where("last = 0").withColumn("s", whole("codes")).select("conv_id", "__seg", "s.ops", "s.cost")
    long_ = ours.where("last > 0")
    if not long_.limit(1).count():
        return staged(short, "talk-solved")

    @F.pandas_udf(LONGS)
    def costs(codes: pd.Series) -> pd.Series:
        return pd.Series([list(run_costs(bytes(c.tolist()))) for c in codes])

    def then(f, g):                            # the later run comes first: f after g
        return [min(min(int(g[4 * p + m]) + int(f[4 * m + q]) for m in range(4)), FAR) for p in range(4) for q in range(4)]

    def before(m, v):
        return [min(min(int(m[4 * p + q]) + int(v[q]) for q in range(4)), FAR) for p in range(4)]

    long_ = staged(long_, "talk-long")
    turned = long_.withColumn("__map", costs("codes")).withColumn("__seg", F.col("last") - F.col("__seg"))
    closing = [Lattice(b"", ENDS, True).auction(q) for q in range(4)]
    left = states_along(staged(turned, "talk-costs"), ["conv_id"], closing, then, before)
    left = join_null_safe(left, last, ["conv_id"]).select("conv_id", (F.col("last") - F.col("__seg")).alias("__seg"), F.col("__state").alias("ends"))

    @F.pandas_udf("ways array<array<string>>, exits array<bigint>, costs array<bigint>")
    def ways(codes: pd.Series, ends: pd.Series, is_last: pd.Series) -> pd.DataFrame:
        out = [solve(bytes(c.tolist()), ENDS if z else tuple(int(x) for x in e), bool(z)) for c, e, z in zip(codes, ends, is_last)]
        return pd.DataFrame({"ways": [[_per_row(w[1]) for w in o] for o in out], "exits": [[w[2] for w in o] for o in out],
                             "costs": [[w[0] for w in o] for o in out]})

    traced = staged(join_null_safe(long_, left, ["conv_id", "__seg"]).withColumn(
        "w", ways("codes", "ends", F.col("__seg") == F.col("last"))).select("conv_id", "__seg", "w.*"), "talk-traced")
    entry = states_along(traced.select("conv_id", "__seg", F.col("exits").alias("__map")), ["conv_id"], [NONE],
                         lambda f, g: [int(g[int(x)]) for x in f], lambda m, s: [int(m[int(s[0])])])
    at = F.col("__state")[0].cast("int")
    got = join_null_safe(traced, entry, ["conv_id", "__seg"]).select(
        "conv_id", "__seg", F.get("ways", at).alias("ops"), F.when(F.col("__seg") == 0, F.get("costs", at)).alias("cost"))
    return staged(short.unionByName(got), "talk-solved")


def _per_row(rows: tuple) -> list:
    return [*rows[:-2], rows[-2] + rows[-1]] if len(rows) > 1 else list(rows)


def repaired_rows(edits: DataFrame) -> DataFrame:
    """conv_id, seq, pos, role, text of the repaired conversations, one row each."""
    ops = edits.withColumn("z", F.expr("explode(transform(sequence(1, length(ops) div 2), i -> named_struct('pos', i, 'op', substring(ops, 2 * i - 1, 2))))"))
    op = F.substring("z.op", 1, 1)
    given = F.when(F.substring("z.op", 2, 1) == "u", "user").otherwise("assistant")
    return ops.where(op != "D").select("conv_id", "seq", F.col("z.pos").alias("pos"), F.when(op == "K", F.col("role")).otherwise(given).alias("role"),
                                       F.when(op == "I", "").otherwise(F.col("text")).alias("text"))


def digests(rows: DataFrame) -> DataFrame:
    """key (conv_id as text), sha256 of the ``role:text`` lines of each conversation."""
    lines = rows.select(F.col("conv_id").cast("string").alias("key"), "seq", "pos", F.concat_ws(":", "role", "text").alias("line"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lines.repartition(parts, "key").sortWithinPartitions("key", "seq", "pos").select("key", "line")

    def stream(batches):
        key, h = None, None
        for pdf in batches:
            done = []
            for k, line in zip(pdf["key"], pdf["line"]):
                k = k if isinstance(k, str) else None
                if h is None or k != key:
                    if h is not None:
                        done.append((key, h.hexdigest()))
                    key, h = k, hashlib.sha256(line.encode())
                else:
                    h.update(b"\n" + line.encode())
            if done:
                yield pd.DataFrame(done, columns=["key", "sha256"])
        if h is not None:
            yield pd.DataFrame([(key, h.hexdigest())], columns=["key", "sha256"])

    return dealt.mapInPandas(stream, "key string, sha256 string")

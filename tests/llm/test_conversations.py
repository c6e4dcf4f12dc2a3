"""Conversation repair against a row-by-row minimum, and its edge cases."""
import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from geoprep.llm import conversations as C
from geoprep.llm.queries import op13_conversation_repair

SPACE = " \t\n\x0b\x0c\r"
TALK = "conv_id long, turn long, role string, text string, seq int, ops string, uid string, h int"       # with clashing extra columns
TURN = {"n": "u", "s": "u", "u": "a", "a": "u"}


def cheapest(codes):
    """(cost, audit) of the least cost, then the ASCII-least audit, by trying every edit of every row."""
    best = {"n": (0, "")}

    def add(at, q, cost, audit):
        if q not in at or (cost, audit) < at[q]:
            at[q] = cost, audit

    def inserts(at):
        for _ in range(2):
            for q, (cost, audit) in list(at.items()):
                add(at, TURN[q], cost + 2, audit + "I")
        return at

    for initial, fault in codes:
        after = {}
        for q, (cost, audit) in inserts(best).items():
            add(after, q, cost + 3, audit + "D")
            if fault != "r":
                more = fault == "t"
                if initial == TURN[q] or (q, initial) == ("n", "s"):
                    add(after, initial, cost + more, audit + "K")
                add(after, TURN[q], cost + 2 + more, audit + "R")
        best = after
    best = inserts(best)
    return min(best[q] for q in "na" if q in best)


def byte(code):
    return "suax".index(code[0]) + {".": 0, "t": C.TRUNCATED, "r": C.REFUSED}[code[1]]


CODES = st.lists(st.tuples(st.sampled_from("suaax"), st.sampled_from("..tr")), min_size=1, max_size=12)


@given(CODES)
@settings(max_examples=400, deadline=None)
def test_auction_finds_the_least_audit_of_the_least_cost(codes):
    rows, end, cost = C.solve_whole(bytes(map(byte, codes)))
    assert (cost, "".join(rows)[::2]) == cheapest(codes) and end in (C.NONE, C.ANSWERED)


@given(CODES)
@settings(max_examples=150, deadline=None)
def test_prices_between_states_are_distances(codes):
    got, b = C.run_costs(bytes(map(byte, codes))), bytes(map(byte, codes))
    want = [[C.FAR] * 4 for _ in range(4)]
    for p in range(4):
        at = {p: 0}
        for c in b:
            for _ in range(2):
                for q, cost in list(at.items()):
                    n = C.NEXT[q, 2 if q == C.USER else 1]
                    at[n] = min(at.get(n, C.FAR), cost + 2)
            after = {}
            for q, cost in at.items():
                moves = [(q, 3)]
                if not c & C.REFUSED:
                    more = 1 if c & C.TRUNCATED else 0
                    moves += [(C.NEXT[q, 2 if q == C.USER else 1], 2 + more)] + ([(C.NEXT[q, c & 3], more)] if (q, c & 3) in C.NEXT else [])
                for n, more in moves:
                    after[n] = min(after.get(n, C.FAR), cost + more)
            at = after
        for q, cost in at.items():
            want[p][q] = cost
    assert got == tuple(x for row in want for x in row)


def brute(rows):
    """The whole query in plain Python: conv_id -> its result columns."""
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if k == 1 else "".join(c for c in text if c not in ".!?") if k == 2 else text
        out[conv] += [(turn, "user" if k == 4 else role, text)] * {0: 0, 3: 2}.get(k, 1)
    res = {}
    for conv, talk in out.items():
        talk.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, codes, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in talk:
            body = text.rstrip(SPACE)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                count[fault] += 1
            codes.append((role[:1] if role[:1] in ("s", "u", "a") else "x", {None: ".", "truncated": "t"}.get(fault, "r")))
        turns = {t for t, _, _ in talk if t is not None}
        cost, audit = cheapest(codes)
        lines, i, last = [], 0, "n"
        for op in audit:
            role, text = (talk[i][1], talk[i][2]) if op != "I" else (None, "")
            i += op != "I"
            if op != "D":
                if op != "K":
                    role = "user" if TURN[last] == "u" else "assistant"
                last = role[:1]
                lines.append(f"{role}:{text}")
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(talk, talk[1:]))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        res[conv] = (gaps, *count.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return res


def random_rows():
    rnd = random.Random(4)
    texts = ["Yes.", "No", "Why?", "", " \t", "Stop!", "x" * 50_000, "Ünï.", "a.b ", None, "Well.\n"]
    roles = ["user"] * 6 + ["assistant"] * 6 + ["system", "tool", "", None, "User"]
    rows = []
    for conv in [*range(60), None]:
        for t in range(rnd.choice([1, 2, 3, 8])):
            rows.append((conv, rnd.choice([t, t, t, t, None, 7]), rnd.choice(roles), rnd.choice(texts)))
    rows += [(100, t, ("user", "assistant")[(t + (t % 37 == 0)) % 2], f"line {t}" + "." * (t % 11 > 0)) for t in range(900)]     # over many runs
    rows += [(101, 5, "user", "Same.")] * 300                                                                                   # ties and repeats
    rows += [(102, None, None, None)]
    return rows


@pytest.mark.parametrize("run_rows", [1, 7, 32])
def test_repair_equals_brute_force(spark, run_rows, monkeypatch):
    rows = random_rows()
    df = spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], TALK)
    edits, summary = C.repair(C.damage(df), run_rows=run_rows)
    want = brute(rows)
    shas = {r["key"]: r["sha256"] for r in C.digests(C.repaired_rows(edits)).collect()}
    got = {r["conv_id"]: tuple(r)[1:] for r in summary.collect()}
    empty = hashlib.sha256(b"").hexdigest()
    for conv, w in want.items():
        have = got.get(conv, (0,) * 6 + ("",))
        assert (*have, shas.get(None if conv is None else str(conv), empty)) == w, conv


def test_every_conversation_returns_and_an_empty_table_is_empty(spark, tmp_dir):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    for name, rows in (("a", [(gone, 0, "user", "Hi."), (5000, 1, "user", "Hi.")]), ("b", [])):
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_dir}/{name}/conversations.parquet")
    out = {r["conv_id"]: r for r in op13_conversation_repair(spark, f"{tmp_dir}/a").collect()}
    assert out[gone]["audit"] == "" and out[gone]["cost"] == 0 and out[gone]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    assert set(out) == {gone, 5000}
    assert op13_conversation_repair(spark, f"{tmp_dir}/b").count() == 0

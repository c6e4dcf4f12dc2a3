"""Keyed writes and batch plans: upsert, insert-if-absent, rejects, exact per-key
sequences under skew, byte-bounded batches against a brute force."""
import random
from functools import reduce

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from geoprep.operators import keyed as K
from geoprep.operators import numbering as N


def test_upsert_last_write_wins_and_rejects(spark):
    target = spark.createDataFrame([("a", 1, "t"), ("b", 1, "t")], "k string, v int, src string")
    b1 = spark.createDataFrame([("a", 5, "b1"), ("a", 7, "b1"), (None, 9, "b1")], "k string, v int, src string")
    b2 = spark.createDataFrame([("a", 2, "b2"), ("c", 3, "b2")], "k string, v int, src string")
    merged, rejected = K.upsert(target, [b1, b2], ["k"], ["v"])
    got = {r["k"]: (r["v"], r["src"]) for r in merged.collect()}
    assert got == {"a": (2, "b2"), "b": (1, "t"), "c": (3, "b2")}
    rej = rejected.collect()
    assert len(rej) == 1 and rej[0]["reject_reason"] == "null key column k" and rej[0]["batch_no"] == 1


def test_upsert_twice_equals_once(spark):
    rows = [(f"k{i % 7}", i) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, v int")
    once, _ = K.upsert(df.limit(0), df, ["k"], ["v"])
    twice, _ = K.upsert(once, df, ["k"], ["v"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_insert_absent(spark):
    target = spark.createDataFrame([("AAPL", 1)], "symbol string, ts int")
    new = spark.createDataFrame([("AAPL", 1), ("AAPL", 2), ("AAPL", 2), ("MSFT", 1), (None, 3)], "symbol string, ts int")
    got = sorted(tuple(r) for r in K.insert_absent(target, new, ["symbol", "ts"], ["ts"]).collect())
    assert got == [("AAPL", 2), ("MSFT", 1)]


def test_sequence_within_is_exact_under_a_hot_key(spark):
    rnd = random.Random(1)
    # one key holds over a third of the rows; null keys form their own group
    rows = [("hot" if i % 3 else f"k{i % 11}", i, rnd.random()) for i in range(3000)] + [(None, 10_000 + i, 0.0) for i in range(20)]
    df = spark.createDataFrame(rows, "k string, id long, w double")
    seq = K.sequence_within(df, ["k"], ["id"], partitions=7)
    got = {r["id"]: r["seq"] for r in seq.collect()}
    by_key = {}
    for k, i, _ in sorted(rows, key=lambda r: ((r[0] is not None, r[0]), r[1])):
        by_key.setdefault(k, []).append(i)
    want = {i: n + 1 for ids in by_key.values() for n, i in enumerate(sorted(ids))}
    assert got == want


def _greedy(sizes, limit):
    out, b, used = [], 0, 0
    for i, s in enumerate(sizes):
        if i > 0 and used + s > limit:
            b, used = b + 1, 0
        out.append(b)
        used += s
    return out


@pytest.mark.parametrize("segment_rows, fan", [(1, 2), (7, 2), (50, 3), (100_000, 32)])
def test_byte_batches_match_brute_force(spark, segment_rows, fan):
    rnd = random.Random(5)
    rows = [("k0" if i % 3 else None, i, "x" * rnd.choice([0, 1, 5, 40, 111, 112, 113])) for i in range(400)] + [("k0", 999, "y" * 500)]
    df = spark.createDataFrame(rows, "k string, id long, payload string")
    plan = K.batch_plan_bytes(df, ["k"], ["id"], max_bytes=120, segment_rows=segment_rows, fan=fan, partitions=5)
    got = {r["id"]: (r["batch_no"], r["row_bytes"]) for r in plan.collect()}
    for key in ("k0", None):
        ids = sorted(i for k, i, _ in rows if k == key)
        assert [got[i][0] for i in ids] == _greedy([got[i][1] for i in ids], 120)


@given(st.lists(st.integers(0, 12), min_size=1, max_size=40), st.integers(1, 15), st.data())
@settings(max_examples=200, deadline=None)
def test_run_maps_compose_to_the_pass_over_all_rows(sizes, limit, data):
    cuts = sorted(data.draw(st.sets(st.integers(1, max(1, len(sizes) - 1)), max_size=5)) & set(range(1, len(sizes))))
    parts = [sizes[a:b] for a, b in zip([0, *cuts], [*cuts, len(sizes)])]
    whole = reduce(N.run_compose, [N.run_map(p, limit) for p in parts])
    for state in range(-1, limit + 14):
        used, closed = (state, 0) if state >= 0 else (None, 0)
        for s in sizes:
            closed, used = (closed + 1, s) if used is not None and used + s > limit else (closed, (used or 0) + s)
        assert N.run_apply(whole, state) == (closed, used)
    assert list(N._batch_of_rows(sizes, limit, -1, 0)) == _greedy(sizes, limit)


def test_numbering_leaves_values_as_they_are(spark):
    import datetime
    rows = [("a", i, 2 ** 53 + 1 + i if i % 2 else None, datetime.date(9999, 12, 31), [1, None]) for i in range(20)]
    df = spark.createDataFrame(rows, "k string, id long, v long, d date, xs array<int>")
    out = K.batch_plan_rows(df, ["k"], ["id"], 3).select(*df.columns)
    assert sorted(map(tuple, out.collect())) == rows and out.schema == df.schema


def test_fixed_count_batches_partition_the_input(spark):
    df = spark.range(0, 103).select(F.lit("k").alias("k"), F.col("id"))
    plan = K.batch_plan_rows(df, ["k"], ["id"], rows=10)
    sizes = sorted(r["rows"] for r in K.batch_summary(plan, ["k"]).collect())
    assert sum(sizes) == 103 and sizes.count(10) == 10 and sizes.count(3) == 1


def test_align_adds_missing_columns(spark):
    df = spark.createDataFrame([("US", "x")], "country_code string, extra string")
    out = K.align(df, "country_code string, state string")
    assert out.columns == ["country_code", "state"] and out.collect()[0]["state"] is None


def test_sequence_within_across_small_arrow_batches(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        rows = [("hot" if i % 4 else f"k{i % 5}", i) for i in range(2000)]
        df = spark.createDataFrame(rows, "k string, id long")
        got = {r["id"]: r["seq"] for r in K.sequence_within(df, ["k"], ["id"], partitions=5).collect()}
        want, seen = {}, {}
        for k, i in sorted(rows, key=lambda r: (r[0], r[1])):
            seen[k] = seen.get(k, 0) + 1
            want[i] = seen[k]
        assert got == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_sequence_within_keeps_nested_columns(spark):
    from geoprep.sources import fixtures as FX
    from conftest import SF001
    adm1 = FX.adm1(spark, SF001)
    out = K.sequence_within(adm1, ["shapeGroup"], ["shapeID"])
    assert dict(out.dtypes)["geometry"] == dict(adm1.dtypes)["geometry"]
    got = {r["shapeID"]: r["geometry"] for r in out.collect()}
    want = {r["shapeID"]: r["geometry"] for r in adm1.collect()}
    assert got == want


def test_upsert_with_an_empty_batch_keeps_the_table(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    merged, rejected = K.upsert(target, target.limit(0), ["k"], ["v"])
    assert sorted(map(tuple, merged.collect())) == [("a", 1), ("b", 2)] and rejected.count() == 0


def test_rows_exactly_filling_a_batch(spark):
    # every payload is 10 bytes + 8 for the id: four rows make exactly 72 bytes
    df = spark.createDataFrame([("k", i, "x" * 10) for i in range(8)], "k string, id long, p string")
    plan = K.batch_plan_bytes(df.drop("k").withColumn("k", F.lit("")), ["k"], ["id"], max_bytes=72)
    sizes = sorted((r["batch_no"], r["rows"], r["bytes"]) for r in K.batch_summary(plan, ["k"]).collect())
    assert sizes == [(0, 4, 72), (1, 4, 72)]

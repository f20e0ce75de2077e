"""Folds in order, against plain loops over all rows."""

import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from strandline.operators import file_packing, graph, queues, slices, tables


def fold(sizes, trigger, cap):
    total, number, out = 0, 0, []
    for n in sizes:
        if n > cap:
            out.append(None)
            continue
        if total and total + n > cap:
            total, number = 0, number + 1
        out.append(number)
        total += n
        if trigger is not None and total >= trigger:
            total, number = 0, number + 1
    return out


CASES = [(None, 10), (7, 10), (10, 10), (15, 10), (1, 10), (0, 10)]


@pytest.mark.parametrize(("trigger", "cap"), CASES)
def test_a_run_packs_from_any_filling(trigger, cap):
    rng = random.Random(trigger)
    for _ in range(150):
        sizes = [rng.choice([0, 0, 1, 2, 3, 5, 9, 10]) for _ in range(rng.randint(0, 25))]
        run = file_packing.Run(np.array(sizes, np.int64), trigger, cap)
        from_, fillings, bins = run.table()
        for filling in range((cap if trigger is None else min(cap, max(1, trigger) - 1)) + 1):
            total, number, out = filling, 0, []
            for n in sizes:
                if total and total + n > cap:
                    total, number = 0, number + 1
                out.append(number)
                total += n
                if trigger is not None and total >= trigger:
                    total, number = 0, number + 1
            assert run.numbers(filling, 0).tolist() == out, (sizes, filling)
            assert run.after(filling, 0) == (total, number)
            at = max(k for k, f in enumerate(from_) if f <= filling)
            assert (filling - 1 - fillings[at] if fillings[at] < 0 else fillings[at], bins[at]) == (total, number)


@pytest.mark.parametrize(("trigger", "cap", "rows", "group"), [(None, 10, 4, 2), (7, 10, 4, 2), (7, 10, 1000, 64), (10, 10, 7, 3), (15, 10, 3, 64), (1, 10, 9, 2)])
def test_packing_equals_the_fold(spark, monkeypatch, trigger, cap, rows, group):
    monkeypatch.setattr(slices, "SLICE_ROWS", rows)
    monkeypatch.setattr(slices, "GROUP", group)
    rng = random.Random(cap + rows)
    folders = {"a": [rng.choice([0, 1, 2, 3, 5, 9, 11, 40]) for _ in range(33)], "b": [3] * 5, "c": [99], None: [rng.choice([1, 4]) for _ in range(9)]}
    data = [(f, k, s) for f, sizes in folders.items() for k, s in enumerate(sizes)]
    rng.shuffle(data)
    found = file_packing.pack(spark.createDataFrame(data, "folder string, i int, size int"), ["i"], "size", trigger, cap, ["folder"]).collect()
    for folder, sizes in folders.items():
        assert [r.bin for r in sorted((r for r in found if r.folder == folder), key=lambda r: r.i)] == fold(sizes, trigger, cap)
    sizes = [rng.choice([1, 2, 2, 3, 12]) for _ in range(60)]
    found = file_packing.pack(spark.createDataFrame(list(enumerate(sizes)), "i int, size int"), ["i"], "size", trigger, cap).orderBy("i").collect()
    assert [r.bin for r in found] == fold(sizes, trigger, cap)


def counted(kinds, limit):
    n, first = 0, None
    for at, kind in enumerate(kinds, 1):
        n = n + 1 if kind == "blocked" else max(0, n - 1) if kind == "transient" else 0
        first = at if first is None and n >= limit else first
    return n, first


def test_outcomes_compose():
    rng = random.Random(2)
    for _ in range(400):
        kinds = [rng.choices(["blocked", "transient", "definitive"], [5, 4, rng.choice([0, 1])])[0] for _ in range(rng.randint(1, 30))]
        limit = rng.randint(1, 6)
        own = queues.Outcomes(np.array(kinds))
        a, b = own.map()
        for x in range(limit):
            n, first = counted(["blocked"] * x + kinds, limit)
            assert (a if b is None else max(a, x + b)) == n
            assert own.reached(limit)[x] == (None if first is None else first - x)


@pytest.mark.parametrize("rows", [3, 1000])
def test_a_validator_with_all_outcomes_is_dealt_to_many_slices(spark, monkeypatch, rows):
    monkeypatch.setattr(slices, "SLICE_ROWS", rows)
    rng = random.Random(rows)
    own = {"v": [rng.choice(["blocked", "blocked", "transient", "definitive"]) for _ in range(60)], "w": ["blocked"] * 4, None: ["transient", None, "blocked"]}
    data = [(v, k, o) for v, kinds in own.items() for k, o in enumerate(kinds)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "validator string, at int, outcome string")
    if rows == 3:
        assert slices.in_slices(df, ["validator"], ["at"]).filter("validator = 'v'").select("__slice").distinct().count() > 10
    found = {r.validator: (r.counter, r.blocked_at) for r in queues.blocked_state(df, ["validator"], ["at"]).collect()}
    assert found == {v: counted(kinds, 5) for v, kinds in own.items()}
    assert queues.blocked_state(df.limit(0), ["validator"], ["at"]).collect() == []


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Exchange hashpartitioning")


@pytest.mark.parametrize("n", [0, 1, 37, 200, 400, 1000])
def test_many_of_many_without_one_task(spark, monkeypatch, n):
    monkeypatch.setattr(slices, "ONE_TASK", 10)
    monkeypatch.setattr(slices, "SLICE_ROWS", 60)
    rows = spark.range(400).select("id", (F.col("id") * 7919 % 101).alias("k"))
    expected = sorted(((r.k, r.id) for r in rows.collect()), key=lambda r: (-r[0], r[1]))[:n]
    found = slices.first_rows(rows, [F.desc("k"), "id"], n)
    assert sorted((r.k, r.id) for r in found.collect()) == sorted(expected)
    assert n <= 10 or "Limit" not in found._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(tables, "ONE_TASK", 10)
    drawn = sorted(r.id for r in tables.random_rows(rows, n, "s", "id").collect())
    assert drawn == sorted(r.id for r in rows.orderBy(tables.hash_order("s", "id"), "id").limit(n).collect())


@pytest.mark.parametrize("rate", [0.5, 1e-4])
def test_few_new_rows_of_a_long_history(spark, rate):
    known = spark.range(2000).select((F.col("id") * 3).cast("string").alias("url"))
    rows = spark.range(60).select((F.col("id") * 50).cast("string").alias("url"), "id").unionByName(spark.createDataFrame([(None, 99)], "url string, id long"))
    found = tables.new_rows_of_few(rows, known, ["url"], rate)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, tables.new_rows(rows, known, ["url"]).collect()))
    assert tables.new_rows_of_few(rows, known, ["url"], most=3).count() == found.count()
    assert tables.new_rows_of_few(rows.limit(0), known, ["url"]).collect() == []


def test_a_layer_shuffles_what_it_reaches_only(spark):
    edges = spark.createDataFrame([(f"c{k}", f"c{k + 1}") for k in range(25)] + [("c3", "c1"), ("c5", "x"), ("x", "c5")], "source string, destination string")
    found = graph.layers(edges, spark.createDataFrame([("c0",)], "channel string"))
    assert {r.channel: r.depth for r in found.collect()} == {**{f"c{k}": k for k in range(26)}, "x": 6}
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        own = graph.Bucketed(spark)
        own.append("edges", edges, "source")
        own.append("seen", spark.createDataFrame([("c0", 0), ("c1", 1)], "channel string, depth int"), "channel", "depth")
        layer = graph.reached(own, 1).join(own.read("seen").select("channel"), "channel", "left_anti")
        assert [r.channel for r in layer.collect()] == ["c2"]
        assert exchanges(layer) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)

"""Hand-computed cases and properties."""

import collections
import math
import random

import pytest
from pyspark.sql import Row, functions as F

from waymark import tables
from waymark.functions import scalar as S
from waymark.operators import frames, imaging, paths, planning, ranks, points, stats

P = ["p"]


def line(spark, xy, p=1):
    return spark.createDataFrame([(p, i, *map(lambda v: None if v is None else float(v), q)) for i, q in enumerate(xy)], "p int, i long, x double, y double")


def values(spark, vs):
    return spark.createDataFrame([(None if v is None else float(v),) for v in vs], "v double")


def test_describe(spark):
    r = stats.describe(values(spark, [1, 2, 3, 4]), "v").first()
    assert tuple(r) == pytest.approx((4, 1, 4, 2.5, 2.5, 1.3, 3.7, 1.118033988749895))
    assert stats.describe(values(spark, [7]), "v").first()["stddev"] is None
    empty = stats.describe(values(spark, [None, None]), "v").first()
    assert empty["count"] == 0 and empty["min"] is None and empty["mean"] is None


def test_path_metrics(spark):
    r = paths.metrics(line(spark, [(0, 0), (3, 4), (3, 4), (6, 8)]), P).first()
    assert (r.length, r.displacement, r.tortuosity, r.keypoints, r.frames) == (10, 10, 1, 4, 200)
    r = paths.metrics(line(spark, [(0, 0), (1, 0), (0, 0)]), P).first()
    assert (r.length, r.displacement, r.tortuosity) == (2, 0, None)
    bad = line(spark, [(0, 0), (None, 1)])
    assert paths.metrics(bad, P).count() == 0 and paths.failures(bad, P).count() == 1


@pytest.mark.parametrize("follow, want", [(1.5, 3), (5, 1), (0, 4)])
def test_frame_count(spark, follow, want):
    assert frames.frame_count(line(spark, [(k, 0) for k in range(4)]), P, follow).first().frames == want


def test_dedupe_keeps_by_last_kept(spark):
    got = [r.x for r in paths.dedupe(line(spark, [(0, 0), (6e-5, 0), (1.2e-4, 0)]), P, 1e-4).orderBy("i").collect()]
    assert got == [0, 1.2e-4]


def test_stride_and_sample(spark):
    df = line(spark, [(k, 0) for k in range(4)])
    assert [r.i for r in paths.stride(df, P, 2).orderBy("i").collect()] == [0, 2, 3]
    df = line(spark, [(k, 0) for k in range(10)])
    assert [r.i for r in paths.uniform_sample(df, P, "i", 4).orderBy("i").collect()] == [0, 2, 4, 6]
    assert paths.uniform_sample(df, P, "i", 0).count() == 10


def test_world_to_pixel_rounds_to_even(spark):
    u, v = S.world_to_pixel("x", "y", 0.0, 10.0, 1.0)
    got = line(spark, [(0.5, 9.5), (1.5, 8.5), (2.5, 7.5)]).orderBy("i").select(u, v).collect()
    assert [tuple(r) for r in got] == [(0, 0), (2, 2), (2, 2)]


def test_resume(spark):
    rows = [("a", "SUCCESS"), ("a", "FAILED"), ("b", "FAILED"), ("b", "SUCCESS"), ("c", "FAILED")]
    for log in (rows, rows[::-1]):
        got = {r.k: r.state for r in planning.resume_state(spark.createDataFrame(log, "k string, status string"), ["k"]).collect()}
        assert got == {"a": "completed", "b": "completed", "c": "failed"}


def test_histogram(spark):
    assert {r.bin for r in stats.histogram(values(spark, [0, 2, 10]), "v", 5).collect()} == {1, 2, 5}
    assert [(r.bin, r.n) for r in stats.histogram(values(spark, [3, 3]), "v", 5).collect()] == [(3, 2)]


def test_coverage(spark):
    e = spark.createDataFrame([("s", x) for x in "abc"], "g string, k string")
    a = spark.createDataFrame([("s", x) for x in "bd"], "g string, k string")
    r = stats.coverage(e, a, "g", "k").first()
    assert (r.ratio, r.missing, r.extra, r.shared) == (round(1 / 3, 6), 2, 1, 1)
    assert stats.difference_samples(e, a, "g", "k", 25).first()["items"] == "a,c"


def test_assignment(spark):
    labels = spark.createDataFrame([(x,) for x in "edcba"], "label string")
    got = planning.assign(labels, "label", ["u", "v"]).orderBy("label").collect()
    assert [r["round"] for r in got] == [0, 0, 1, 1, 2] and [r["order"] for r in got] == [0, 1, 0, 1, 0]
    seeded = planning.assign(labels, "label", ["u", "v", "w"], seed=33, sequential=True).orderBy("label").collect()
    rng, order, want = random.Random(33), ["u", "v", "w"], []
    for _ in range(2):
        rng.shuffle(order)
        want += order
    assert [r.actor for r in seeded] == want[:5]


def test_seeded_rounds_in_parallel(spark, monkeypatch):
    """Each round has a shuffle of its own, whatever the partitions; one generator's rounds may come in blocks."""
    names = [f"a{k}" for k in range(5)]
    labels = spark.range(1003).select(F.format_string("%04d", "id").alias("label")).repartition(7)
    got = {r.label: (r["round"], r.order, r.actor) for r in planning.assign(labels, "label", names, seed=33).collect()}
    assert len(got) == 1003
    for k in range(1003):
        order = list(names)
        random.Random(f"33/{k // 5}").shuffle(order)
        assert got[f"{k:04d}"] == (k // 5, k % 5, order[k % 5])
    monkeypatch.setattr(planning, "ROUNDS", 17)
    turns = dict(planning.sequential_rounds(names, 201, 33))
    for r in planning.assign(labels, "label", names, seed=33, sequential=True).collect():
        assert r.actor == turns[r["round"]][r.order]
    assert planning.assign(labels.where("false"), "label", names, seed=1).count() == planning.assign(labels.where("false"), "label", names, seed=1, sequential=True).count() == 0


def test_seeded_rounds_are_not_joined(spark):
    """Rounds are shuffled beside their labels: no table of all actors of all rounds is dealt out or sent around."""
    labels = spark.range(2003).select(F.col("id").alias("label"))
    seeded = planning.assign(labels, "label", ["u", "v", "w"], seed=1)
    plain = planning.assign(labels, "label", ["u", "v", "w"])
    joins = [x for x in seeded._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in x]
    assert len(joins) == 1 and "strategy=broadcast" in joins[0]  # the sizes of ranges
    assert seeded.schema == plain.schema and seeded.agg(F.count_distinct("label"), F.count_distinct("round", "actor")).first() == (2003, 2003)


def test_ranks(spark):
    """Places, neighbours, running sums and quantiles of groups of any size, ties and null groups included."""
    rng = random.Random(4)
    rows = [(rng.choice([None, "a", "a", "a", "b", "c"]), rng.choice([None, *range(20)]), k) for k in range(500)]
    df = spark.createDataFrame(rows, "g string, v int, id long").repartition(5)
    groups = collections.defaultdict(list)
    for g, v, k in rows:
        groups[g].append((v, k))
    placed = ranks.placed(df, ["g"], ["id"], "p").collect()
    at = {g: {k: n for n, (_, k) in enumerate(sorted(x, key=lambda r: r[1]))} for g, x in groups.items()}
    assert len(placed) == 500 and all(at[r.g][r.id] == r.p for r in placed)
    follow = {(r.g, r.id): r.b for r in ranks.with_next(df, ["g"], ["id"], "id", "b").collect()}
    assert len(follow) == 500 - len(groups) and all(at[g][b] == at[g][k] + 1 for (g, k), b in follow.items())
    sums = {r.id: r.s for r in ranks.running(df.withColumn("v", F.coalesce("v", F.lit(1))), ["g"], ["id"], "v", "s").collect()}
    for g, x in groups.items():
        total = 0
        for v, k in sorted(x, key=lambda r: r[1]):
            assert sums[k] == total
            total += 1 if v is None else v
    got = {r.g: r for r in ranks.quantiles(df, ["g"], "v", {"low": 0.0, "mid": 0.5, "odd": 0.37}).collect()}
    for g, x in groups.items():
        v = sorted(v for v, _ in x if v is not None)
        for name, q in (("low", 0.0), ("mid", 0.5), ("odd", 0.37)):
            pos = (len(v) - 1) * q
            want = v[math.floor(pos)] + (v[math.ceil(pos)] - v[math.floor(pos)]) * (pos - math.floor(pos))
            assert math.isclose(got[g][name], want, abs_tol=1e-9), (g, name)
    assert ranks.quantiles(df.where("false"), [], "v", {"mid": 0.5}).first().mid is None


def test_shards_partition_the_input(spark):
    df = spark.createDataFrame([(x,) for x in "abcde"], "scene string")
    assert [r.scene for r in planning.shard(df, "scene", 2, 2).orderBy("scene").collect()] == ["b", "d"]
    got = sorted(r.scene for k in (1, 2, 3) for r in planning.shard(df, "scene", k, 3).collect())
    assert got == list("abcde")


def test_slots(spark):
    df = spark.createDataFrame([(k,) for k in range(1, 6)], "job int")
    assert [r.slot for r in planning.slots(df, "job", 3).orderBy("job").collect()] == [1, 2, 3, 1, 2]


def test_outcome(spark):
    df = spark.createDataFrame([(None,), (1048575,), (1048576,)], "size long").select(stats.outcome(F.col("size"), stats.bytes_of_mb(1)).alias("o"))
    assert [r.o for r in df.collect()] == ["skipped", "failed", "success"]


def test_position_extrapolates(spark):
    wanted = spark.createDataFrame([(1, d) for d in (-1.0, 0.5, 1.0, 2.0, 4.0)], "p int, d double")
    got = paths.position_at(line(spark, [(0, 0), (1, 0), (3, 0)]), wanted, P).orderBy("d").collect()
    assert [r.x for r in got] == [-1, 0.5, 1, 2, 4]


def test_animation(spark):
    df = spark.range(5).select("id", frames.animation_index(F.col("id"), F.lit(4), 10.0, 10.0, 3, True).alias("a"), frames.animation_index(F.col("id"), F.lit(4), 10.0, 10.0, 3, False).alias("b"))
    got = df.orderBy("id").collect()
    assert [r.a for r in got] == [0, 3, 2, 1, 0] and [r.b for r in got] == [0, 3, 3, 3, 3]


def test_lag_lead_between(spark):
    df = line(spark, [(k, 0) for k in range(5)])
    assert [(r.person, r.camera) for r in frames.lag_plan(df, P, 2).orderBy("person").collect()] == [(2, 0), (3, 1), (4, 2)]
    assert [(r.camera, r.person) for r in frames.lead_plan(df, P, 2).orderBy("camera").collect()] == [(0, 2), (1, 3), (2, 4), (3, 4), (4, 4)]
    plan = spark.createDataFrame([(1, 0, 0.0, 2.0)], "p int, frame int, camera double, person double")
    assert [r.i for r in frames.between_points(line(spark, [(k, 0) for k in range(4)]), plan, P).collect()] == [1]


def test_natural_order_and_depth(spark):
    df = spark.createDataFrame([("f10",), ("f2",), ("F1",)], "s string")
    assert [r.s for r in df.orderBy(S.natural_key("s")).collect()] == ["F1", "f2", "f10"]
    df = spark.createDataFrame([(0.0,), (0.5,), (0.001,)], "d double").select(S.depth_mm("d").alias("m"))
    assert [r.m for r in df.collect()] == [0, 2000, 65535]


def test_blend(spark):
    df = spark.createDataFrame([(1, 0, 1.0, 0.0), (1, 1, 0.0, 1.0)], "p int, i long, dx double, dy double")
    r = frames.blend(df, P, "dx", "dy").orderBy("i").collect()[1]
    assert math.isclose(r.bx, 0.65 / math.hypot(0.65, 0.35)) and math.isclose(r.by, 0.35 / math.hypot(0.65, 0.35))


def test_length_is_at_least_displacement(spark):
    rng = random.Random(5)
    for p in range(5):
        r = paths.metrics(line(spark, [(rng.random(), rng.random()) for _ in range(rng.randrange(2, 9))]), P).first()
        assert r.length >= r.displacement - 1e-6 and (r.tortuosity is None or r.tortuosity >= 1 - 1e-6)


def test_small_helpers(spark):
    r = spark.createDataFrame([Row(t=" Yes ", n="x1", k="a/b.c.txt", b=1536)]).select(
        S.truth("t").alias("t"), S.number("n").alias("n"), S.stem("k").alias("k"), S.byte_text("b").alias("b"), S.percent_colour(F.lit(50.0)).alias("c")
    ).first()
    assert tuple(r) == (True, 0.0, "b.c", "1.50 KB", "#7f7f00")


def test_resume_from(spark):
    df = spark.createDataFrame([("001_a",), ("002_b",), ("010_c",)], "s string")
    assert planning.resume_from(df, "s", "2").count() == 2 and planning.resume_from(df, "s", "77").count() == 3


def test_images(spark):
    import numpy as np

    a = np.random.default_rng(0).random((16, 16))
    assert math.isclose(imaging.structural_similarity(a, a), 1.0)
    assert imaging.structural_similarity(a, 1 - a) < 0.5
    df = spark.createDataFrame([(np.diag([2.0, 2.0, 2.0, 1.0]).ravel().tolist(),), ([0.0] * 16,)], "m array<double>")
    got = [r.i for r in df.select(imaging.inverse_4x4("m").alias("i")).collect()]
    assert got[0][0] == 0.5 and got[1] is None


def test_union_aligned(spark):
    a = spark.createDataFrame([(1, 2.0)], "x int, y double")
    b = spark.createDataFrame([(3.0, "z")], "x double, extra string")
    assert sorted(map(tuple, points.union_aligned(a, b).collect())) == [(1, 2.0), (3, 0.0)]


def test_tables_are_discarded(spark):
    import os

    kept, gone = (tables.table(spark.range(5), "t") for _ in range(2))
    place = lambda df: os.path.dirname(df.inputFiles()[0].removeprefix("file://"))
    here, there = place(kept), place(gone)
    tables.discard(gone)
    tables.discard(spark.range(1))  # never written
    assert os.path.exists(here) and not os.path.exists(there) and kept.count() == 5

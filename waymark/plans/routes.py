"""Queries of path preparation and frame planning."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import scalar as S
from ..operators import frames, paths
from .proxies import Proxies, sql
from .registry import query

PATH = ["scene", "label"]
FOLLOW = 15.0


@query(sql("""WITH f AS (SELECT scene, label, count(*) AS n, sum(x) AS sx, sum(x * x) AS sxx, sum(x * m) AS sxm, sum(m) AS sm, sum(y) AS sy, sum(y * y) AS syy, sum(y * k) AS syk, sum(k) AS sk
FROM (SELECT *, y + 0.5 * x AS m, 3 - x AS k FROM path_point) GROUP BY ALL), g AS (SELECT *, CASE WHEN n < 2 OR abs(n * sxx - sx * sx) < 1e-8 THEN NULL ELSE (n * sxm - sx * sm) / (n * sxx - sx * sx) END AS a,
CASE WHEN n < 2 OR abs(n * syy - sy * sy) < 1e-8 THEN NULL ELSE (n * syk - sy * sk) / (n * syy - sy * sy) END AS b FROM f)
SELECT scene, label, n, round(coalesce(a, 1), 9) AS ax, round(coalesce((sm - a * sx) / n, 0), 9) AS bx, round(coalesce(b, 1), 9) AS ay, round(coalesce((sk - b * sy) / n, 0), 9) AS "by" FROM g""", "path_point"))
def affine_fit(p: Proxies) -> DataFrame:
    points = p.path_point().withColumns({"y": F.round("y"), "x": F.round("x")}).withColumns({"m": F.col("y") + 0.5 * F.col("x"), "k": 3 - F.col("x")})
    df = paths.affine_fit(points, PATH, "m", "k")
    return df.select(*PATH, "n", *(F.round(c, 9).alias(c) for c in ("ax", "bx", "ay", "by")))


@query(sql("""SELECT scene, label, i, round(50 - (1.5 * x + 2), 6) AS x, round(10 - (0.5 * y - 1), 6) AS y, round(99 - x) AS u FROM path_point""", "path_point"))
def affine_apply_mirror(p: Proxies) -> DataFrame:
    df = p.path_point()
    return df.select(*PATH, "i", F.round(S.reflect(1.5 * F.col("x") + 2, 0.0, 50.0), 6).alias("x"), F.round(S.reflect(0.5 * F.col("y") - 1, 0.0, 10.0), 6).alias("y"), F.round(100 - 1 - F.col("x")).alias("u"))


@query(sql("""WITH d AS (SELECT scene, label, i, x, y FROM path_point WHERE i = 1
UNION ALL SELECT scene, label, i, x, y FROM (
  SELECT q.scene, q.label, q.i, q.x, q.y, row_number() OVER (PARTITION BY q.label ORDER BY q.i) AS r FROM d JOIN path_point AS q ON q.label = d.label AND q.i > d.i
  WHERE sqrt((q.x - d.x) * (q.x - d.x) + (q.y - d.y) * (q.y - d.y)) > 12) WHERE r = 1)
SELECT scene, label, i, x, y FROM d""", "path_point", recursive=True))
def dedupe_consecutive(p: Proxies) -> DataFrame:
    return paths.dedupe(p.path_point(), PATH, 12.0)


@query(sql("SELECT scene, label, i, x, y FROM (SELECT *, row_number() OVER w - 1 AS k, count(*) OVER (PARTITION BY label) AS n FROM path_point WINDOW w AS (PARTITION BY label ORDER BY i)) WHERE k % 3 = 0 OR k = n - 1 OR n <= 2", "path_point"))
def stride_keep_last(p: Proxies) -> DataFrame:
    return paths.stride(p.path_point(), PATH, 3)


@query(sql("SELECT cloud, pid FROM (SELECT cloud, pid, row_number() OVER (PARTITION BY cloud ORDER BY pid) - 1 AS r, count(*) OVER (PARTITION BY cloud) AS n FROM point) WHERE n <= 7 OR (r % greatest(n // 7, 1) = 0 AND r / greatest(n // 7, 1) < 7)", "point"))
def uniform_sample(p: Proxies) -> DataFrame:
    return paths.uniform_sample(p.point().select("cloud", "pid"), ["cloud"], "pid", 7)


@query(sql("SELECT scene, label, i, x, y, round(c, 6) AS c FROM cum", "cum"))
def cumulative_length(p: Proxies) -> DataFrame:
    return paths.cumulative(p.path_point(), PATH).withColumn("c", F.round("c", 6))


@query(sql("SELECT scene, label, frame, round(camera, 6) AS camera, round(person, 6) AS person FROM plan", "plan"))
def follow_frame_plan(p: Proxies) -> DataFrame:
    df = frames.follow_plan(p.path_point(), PATH, FOLLOW)
    return df.withColumns({c: F.round(c, 6) for c in ("camera", "person")})


@query(sql("SELECT scene, label, count(*) AS frames FROM plan GROUP BY ALL", "plan"))
def frame_count_estimate(p: Proxies) -> DataFrame:
    return frames.frame_count(p.path_point(), PATH, FOLLOW)


@query(sql("""WITH s AS (SELECT *, lead(c) OVER w AS c2, lead(x) OVER w AS x2, lead(y) OVER w AS y2, lag(c) OVER w AS c0 FROM cum WINDOW w AS (PARTITION BY label ORDER BY c)),
t AS (SELECT *, lead(c2) OVER (PARTITION BY label ORDER BY c) AS c3 FROM s WHERE c2 IS NOT NULL),
d AS (SELECT DISTINCT scene, label, unnest([-1.0, 0.5, 7.0, 30.0, 200.0])::DOUBLE AS d FROM path_point)
SELECT t.scene, t.label, d.d, round(x + (d.d - c) / (c2 - c) * (x2 - x), 6) AS x, round(y + (d.d - c) / (c2 - c) * (y2 - y), 6) AS y FROM t JOIN d ON t.label = d.label
WHERE (d.d >= c OR c0 IS NULL) AND (d.d < c2 OR c3 IS NULL)""", "cum"))
def position_at_distance(p: Proxies) -> DataFrame:
    points = p.path_point()
    wanted = points.select(*PATH).distinct().withColumn("d", F.explode(F.array(*map(F.lit, (-1.0, 0.5, 7.0, 30.0, 200.0)))))
    return paths.position_at(points, wanted, PATH).withColumns({c: F.round(c, 6) for c in ("x", "y")})


@query(sql("SELECT scene, label, i - 1 AS person, greatest(i - 1 - 2, 0) AS camera FROM path_point WHERE i - 1 >= 2", "path_point"))
def lag_follow_plan(p: Proxies) -> DataFrame:
    return frames.lag_plan(p.path_point(), PATH, 2)


@query(sql("SELECT scene, label, greatest(0, count(*) - 2) AS frames FROM path_point GROUP BY ALL", "path_point"))
def lag_frame_estimate(p: Proxies) -> DataFrame:
    return p.path_point().groupBy(*PATH).agg(F.greatest(F.count("*") - 2, F.lit(0)).alias("frames"))


@query(sql("SELECT scene, label, i - 1 AS camera, least(i - 1 + 2, count(*) OVER (PARTITION BY label) - 1) AS person FROM path_point", "path_point"))
def lead_follow_plan(p: Proxies) -> DataFrame:
    return frames.lead_plan(p.path_point(), PATH, 2)


@query(sql("SELECT plan.scene, plan.label, plan.frame, cum.i FROM plan JOIN cum ON cum.label = plan.label AND cum.c > plan.camera + 1e-9 AND cum.c < plan.person - 1e-6", "plan"))
def between_points(p: Proxies) -> DataFrame:
    points = p.path_point()
    return frames.between_points(points, frames.follow_plan(points, PATH, FOLLOW), PATH)


def _direction_sql(window: int, weighted: bool) -> str:
    sums = {"x": [], "y": []}
    cols = []
    for k in range(1, window + 1):
        ahead = {v: f"coalesce(lead({v}, {k}) OVER w, last({v}) OVER a)" for v in "xy"}
        behind = {v: f"coalesce(lag({v}, {k}) OVER w, first({v}) OVER a)" for v in "xy"}
        pairs = [(ahead, behind)] if weighted else [(ahead, {"x": "x", "y": "y"}), ({"x": "x", "y": "y"}, behind)]
        for s, (b, c) in enumerate(pairs):
            cols += [f"{b[v]} - {c[v]} AS {v}{k}{s}" for v in "xy"]
            norm = f"sqrt(x{k}{s} * x{k}{s} + y{k}{s} * y{k}{s})"
            for v in "xy":
                sums[v].append(f"{k if weighted else 1} * CASE WHEN {norm} > 1e-6 THEN {v}{k}{s} / {norm} ELSE 0 END")
    return f"""WITH n AS (SELECT *, {', '.join(cols)} FROM path_point WINDOW w AS (PARTITION BY label ORDER BY i), a AS (PARTITION BY label ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
s AS (SELECT scene, label, i, {' + '.join(sums['x'])} AS sx, {' + '.join(sums['y'])} AS sy FROM n), dirs AS (
SELECT scene, label, i, CASE WHEN sqrt(sx * sx + sy * sy) <= 1e-6 THEN 0 ELSE sx / sqrt(sx * sx + sy * sy) END AS dx, CASE WHEN sqrt(sx * sx + sy * sy) <= 1e-6 THEN 1 ELSE sy / sqrt(sx * sx + sy * sy) END AS dy FROM s)"""


_ROUNDED = " SELECT scene, label, i, round(dx, 6) + 0 AS dx, round(dy, 6) + 0 AS dy FROM dirs"


def _directions(p: Proxies, weighted: bool) -> DataFrame:
    df = frames.directions(p.path_point(), PATH, 5, weighted)
    return df.select(*PATH, "i", *((F.round(c, 6) + 0).alias(c) for c in ("dx", "dy")))


@query(sql(_direction_sql(5, False) + _ROUNDED, "path_point"))
def direction_window5(p: Proxies) -> DataFrame:
    return _directions(p, False)


@query(sql(_direction_sql(5, True) + _ROUNDED, "path_point"))
def direction_weighted5(p: Proxies) -> DataFrame:
    return _directions(p, True)


@query(sql(_direction_sql(2, False) + """, b AS (SELECT scene, label, i, dx AS bx, dy AS "by" FROM dirs WHERE i = 1 UNION ALL
SELECT scene, label, i, CASE WHEN n > 1e-9 THEN mx / n ELSE bx END, CASE WHEN n > 1e-9 THEN my / n ELSE "by" END FROM (
 SELECT *, sqrt(mx * mx + my * my) AS n FROM (SELECT d.scene, d.label, d.i, b.bx, b."by", 0.65 * b.bx + (1 - 0.65) * d.dx AS mx, 0.65 * b."by" + (1 - 0.65) * d.dy AS my FROM b JOIN dirs AS d ON d.label = b.label AND d.i = b.i + 1)))
SELECT scene, label, i, round(bx, 6) + 0 AS bx, round("by", 6) + 0 AS "by" FROM b""", "path_point", recursive=True))
def direction_blend(p: Proxies) -> DataFrame:
    df = frames.blend(frames.directions(p.path_point(), PATH, 2), PATH, "dx", "dy")
    return df.select(*PATH, "i", *((F.round(c, 6) + 0).alias(c) for c in ("bx", "by")))


@query(sql("SELECT path, i, CAST(floor((i - 1) * 7.5) AS BIGINT) % count(*) OVER (PARTITION BY path) AS looped, least(CAST(floor((i - 1) * 7.5) AS BIGINT), count(*) OVER (PARTITION BY path) - 1) AS held FROM frame", "frame"))
def animation_index(p: Proxies) -> DataFrame:
    from pyspark.sql import Window as W

    df = p.frame().withColumn("n", F.count("*").over(W.partitionBy("path")))
    k = F.col("i") - 1
    return df.select("path", "i", frames.animation_index(k, F.col("n"), 25.0, 10.0, 3, True).alias("looped"), frames.animation_index(k, F.col("n"), 25.0, 10.0, 3, False).alias("held"))


@query(sql("""SELECT scene, label, i, CAST(round_even((x - 1) / 0.5, 0) AS INTEGER) AS u, CAST(round_even((10 - y) / 0.25, 0) AS INTEGER) AS v, CAST(round_even((50 - x) / 0.5, 0) AS INTEGER) AS mu, CAST(round_even(y / 0.25, 0) AS INTEGER) AS mv,
round(1 + round_even((x - 1) / 0.5, 0) * 0.5, 6) AS wx, (u >= 0 AND u < 80 AND v >= 0 AND v < 30) AS inside FROM (SELECT scene, label, i, x, round(y) AS y FROM path_point)""", "path_point"))
def world_to_pixel(p: Proxies) -> DataFrame:
    df = p.path_point().withColumn("y", F.round("y"))
    u, v = S.world_to_pixel("x", "y", 1.0, 10.0, 0.5)
    _, v = S.world_to_pixel("x", "y", 1.0, 10.0, 0.25)
    mu, _ = S.world_to_pixel_mirrored("x", "y", 50.0, 0.0, 0.5)
    _, mv = S.world_to_pixel_mirrored("x", "y", 50.0, 0.0, 0.25)
    df = df.select(*PATH, "i", u.alias("u"), v.alias("v"), mu.alias("mu"), mv.alias("mv"))
    wx, _ = S.pixel_to_world("u", "v", 1.0, 10.0, 0.5)
    return df.withColumns({"wx": F.round(wx, 6), "inside": S.inside("u", "v", 80, 30)})


@query(sql("SELECT scene, label, i, round(atan2(dx, dy) + pi(), 6) AS yaw FROM (SELECT scene, label, i, lead(x) OVER w - x AS dx, lead(y) OVER w - y AS dy FROM path_point WINDOW w AS (PARTITION BY label ORDER BY i)) WHERE dx IS NOT NULL", "path_point"))
def yaw_of_steps(p: Proxies) -> DataFrame:
    from pyspark.sql import Window as W

    w = W.partitionBy(*PATH).orderBy("i")
    df = p.path_point().withColumns({"dx": F.lead("x").over(w) - F.col("x"), "dy": F.lead("y").over(w) - F.col("y")}).where("dx is not null")
    return df.select(*PATH, "i", F.round(S.yaw("dx", "dy"), 6).alias("yaw"))


@query(sql("""WITH e AS (SELECT path, i, 0.4 * x AS ema FROM frame WHERE i = 1 UNION ALL SELECT f.path, f.i, 0.4 * f.x + 0.6 * e.ema FROM e JOIN frame AS f ON f.path = e.path AND f.i = e.i + 1)
SELECT path, i, round(ema, 6) AS ema FROM e""", "frame", recursive=True))
def loss_average(p: Proxies) -> DataFrame:
    return frames.smoothed(p.frame(), ["path"], "x", 0.4, "i").withColumn("ema", F.round("ema", 6))


@query("""SELECT s AS step, round((0.01 + (1 - 0.01) * sin(pi() / 2 * least(s / 1000.0::DOUBLE, 1))) * exp(ln(0.00016::DOUBLE) * (1 - least(s / 30000.0::DOUBLE, 1)) + ln(0.0000016::DOUBLE) * least(s / 30000.0::DOUBLE, 1)), 12) AS rate FROM range(0, 30001, 100) AS t(s)""")
def learning_rates(p: Proxies) -> DataFrame:
    return p.spark.range(0, 30001, 100).select(F.col("id").alias("step"), F.round(S.learning_rate("id", 1.6e-4, 1.6e-6, 1000, 0.01, 30000), 12).alias("rate"))

"""Queries of point clouds and images."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import scalar as S
from ..operators import imaging, points, ranks
from .proxies import Proxies, sql
from .registry import query

_ROUND = lambda names: [F.round(n, 6).alias(n) for n in names]


@query(sql("SELECT cloud, count(*) AS n, " + ", ".join(f"round(min({c}), 6) AS {c}_min, round(max({c}), 6) AS {c}_max, round((min({c}) + max({c})) / 2, 6) AS {c}_mid, round(max({c}) - min({c}), 6) AS {c}_size" for c in "xyz") + " FROM point GROUP BY cloud", "point"))
def point_bbox_stats(p: Proxies) -> DataFrame:
    df = points.box(p.point(), ["cloud"])
    return df.select("cloud", "n", *_ROUND(c for c in df.columns if c not in ("cloud", "n")))


@query(sql("SELECT round(-avg(z), 6) AS offset_avg, round(-max(z), 6) AS offset_min, round(-min(z), 6) AS offset_max FROM (SELECT cloud, min(z) AS z FROM point GROUP BY 1)", "point"))
def ground_offsets(p: Proxies) -> DataFrame:
    return points.ground_offsets(points.box(p.point(), ["cloud"])).select(*_ROUND(["offset_avg", "offset_min", "offset_max"]))


@query(sql("""SELECT cloud, round(min(z), 6) AS z_min, round(max(z), 6) AS z_max, round(max(z) - min(z), 6) AS height, round(1.7 / nullif(max(z) - min(z), 0), 6) AS scale, round(quantile_cont(z, 0.05), 6) AS foot,
round(-quantile_cont(z, 0.05), 6) AS foot_offset, round(min(z) + 0.6 * (max(z) - min(z)), 6) AS hip FROM point GROUP BY cloud""", "point"))
def actor_height_stats(p: Proxies) -> DataFrame:
    df = points.body_stats(p.point(), ["cloud"], 1.7, 5.0)
    return df.select("cloud", *_ROUND(c for c in df.columns if c != "cloud"))


def _pixels(p: Proxies) -> DataFrame:
    grid = p.spark.range(400).select((F.col("id") / 20).cast("int").alias("u"), (F.col("id") % 20).cast("int").alias("v"))
    colour = lambda k: ((F.col("u") * 37 + F.col("v") * k) % 256).cast("int")
    return grid.withColumns({"u": F.floor(F.col("u")).cast("int"), "r": colour(91), "g": colour(53), "b": F.lit(255)}).withColumn("r", F.when((F.col("u") + F.col("v")) % 3 == 0, 255).otherwise(F.col("r"))).withColumn("g", F.when((F.col("u") + F.col("v")) % 3 == 0, 255).otherwise(F.col("g")))


_PIXELS = """g AS (SELECT i // 20 AS u, i % 20 AS v FROM range(400) AS t(i)), px AS (SELECT u, v FROM (SELECT u, v, CASE WHEN (u + v) % 3 = 0 THEN 255 ELSE (u * 37 + v * 91) % 256 END AS r, CASE WHEN (u + v) % 3 = 0 THEN 255 ELSE (u * 37 + v * 53) % 256 END AS g FROM g) WHERE NOT (r >= 250 AND g >= 250)),
pt AS (SELECT cloud, pid, CAST(round_even((x + 0.5) / 0.05, 0) AS INTEGER) AS u, CAST(round_even((0.5 - y) / 0.05, 0) AS INTEGER) AS v FROM point)"""


def _placed(p: Proxies) -> DataFrame:
    u, v = S.world_to_pixel("x", "y", -0.5, 0.5, 0.05)
    return p.point().select("cloud", "pid", u.alias("u"), v.alias("v"))


@query(sql(f"WITH {_PIXELS} SELECT cloud, pid, pt.u, pt.v FROM pt SEMI JOIN px ON px.u = pt.u AND px.v = pt.v", "point"))
def mask_semi_join(p: Proxies) -> DataFrame:
    return points.on_mask(_placed(p), points.not_white(_pixels(p))).select("cloud", "pid", "u", "v")


@query(sql("""SELECT cloud, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z, round(opacity, 6) AS opacity FROM point
UNION ALL SELECT 0, round(x, 6), round(y, 6), 0, 0 FROM path_point""", "point", "path_point"))
def union_aligned(p: Proxies) -> DataFrame:
    first = p.point().select("cloud", *_ROUND(["x", "y", "z", "opacity"]))
    return points.union_aligned(first, p.path_point().select(*_ROUND(["x", "y"]), "label"))


@query(sql("SELECT cloud, pid FROM point WHERE cloud >= 3 UNION ALL SELECT cloud, pid + 1000000 FROM point WHERE cloud < 3", "point"))
def replace_part(p: Proxies) -> DataFrame:
    df = p.point().select("cloud", "pid")
    return points.replace_part(df, df.where("cloud < 3").withColumn("pid", F.col("pid") + 1_000_000), "cloud")


@query(sql("SELECT round(x, 6) AS x, round(y, 6) AS y, 0.0::DOUBLE AS z, 0 AS red, 0 AS green, 255 AS blue FROM point UNION ALL SELECT round(x, 6), round(y, 6), 0, 0, 0, 0 FROM path_point", "point", "path_point"))
def mask_cloud(p: Proxies) -> DataFrame:
    flat = lambda df: df.select(*_ROUND(["x", "y"])).withColumn("z", F.lit(0.0))
    return points.marked(flat(p.point()), 0, 0, 255).unionByName(points.marked(flat(p.path_point()), 0, 0, 0))


@query("""WITH v AS (SELECT o_orderkey AS i, (o_orderkey * 2654435761) & 4294967295 AS w FROM orders), n AS (SELECT count(*) AS n FROM nation),
j AS (SELECT v.*, least(i // 256, n - 1) AS c FROM v, n)
SELECT i, c AS chunk, round(-c + ((w >> 21) & 2047) / 2047.0::DOUBLE * (2 * c + 1), 6) AS x, round(-c + ((w >> 11) & 1023) / 1023.0::DOUBLE * (2 * c + 1), 6) AS y, round(-c + (w & 2047) / 2047.0::DOUBLE * (2 * c + 1), 6) AS z,
round(((w >> 24) & 255) / 255.0::DOUBLE, 6) AS red, round((w & 255) / 255.0::DOUBLE, 6) AS alpha FROM j""")
def unpack_bits(p: Proxies) -> DataFrame:
    v = p.table("orders").select(F.col("o_orderkey").alias("i"), (F.col("o_orderkey") * 2654435761).bitwiseAND(F.lit(4294967295)).alias("w"))
    chunks = p.table("nation").select(F.col("n_nationkey").cast("long").alias("chunk"), (-F.col("n_nationkey")).cast("double").alias("lo"), (F.col("n_nationkey") + 1).cast("double").alias("hi"))
    df = points.with_chunks(v, chunks)
    x, y, z = points.unpack_position(F.col("w"), [F.col("lo")] * 3, [F.col("hi")] * 3)
    colour = points.unpack_colour(F.col("w"))
    df = df.select("i", F.col("chunk").cast("long").alias("chunk"), x.alias("x"), y.alias("y"), z.alias("z"), colour[0].alias("red"), colour[3].alias("alpha"))
    return df.select("i", "chunk", *_ROUND(["x", "y", "z", "red", "alpha"]))


@query("""WITH v AS (SELECT o_orderkey AS i, (o_orderkey * 2654435761) & 4294967295 AS w FROM orders), q AS (SELECT i, (w >> 30) & 3 AS k, (((w >> 20) & 1023) / 1023.0::DOUBLE - 0.5) * sqrt(2) AS a, (((w >> 10) & 1023) / 1023.0::DOUBLE - 0.5) * sqrt(2) AS b, ((w & 1023) / 1023.0::DOUBLE - 0.5) * sqrt(2) AS c FROM v),
m AS (SELECT *, sqrt(greatest(1 - (a * a + b * b + c * c), 0)) AS m FROM q)
SELECT i, round(CASE k WHEN 0 THEN m ELSE a END, 6) AS w, round(CASE k WHEN 0 THEN a WHEN 1 THEN m ELSE b END, 6) AS x, round(CASE k WHEN 0 THEN b WHEN 1 THEN b WHEN 2 THEN m ELSE c END, 6) AS y, round(CASE k WHEN 3 THEN m ELSE c END, 6) AS z FROM m""")
def unpack_rotation(p: Proxies) -> DataFrame:
    df = p.table("orders").select(F.col("o_orderkey").alias("i"), (F.col("o_orderkey") * 2654435761).bitwiseAND(F.lit(4294967295)).alias("packed"))
    return df.select("i", *(F.round(c, 6).alias(n) for n, c in zip("wxyz", points.unpack_rotation(F.col("packed")))))


@query(sql("SELECT pid FROM point WHERE NOT (1 / (1 + exp(-opacity)) < 0.5 OR exp(greatest(s0, s1, s2)) > 0.1 * 12 OR abs(g) > 0.2)", "point"))
def prune_points(p: Proxies) -> DataFrame:
    return points.prune(p.point().withColumn("radius", F.abs("g")), 0.5, 12.0, 0.2).select("pid")


@query(sql("""WITH k AS (SELECT pid, abs(g) >= 0.1 AS steep, exp(greatest(s0, s1, s2)) > 0.1 * 11 AS large FROM point)
SELECT pid, CASE WHEN steep AND large THEN 'split' WHEN steep THEN 'clone' ELSE 'keep' END AS part, unnest(CASE WHEN steep AND large THEN [1, 2] WHEN steep THEN [0, 1] ELSE [0] END) AS copy FROM k""", "point"))
def densify_points(p: Proxies) -> DataFrame:
    return points.densify(p.point().withColumn("g", F.abs("g")), "g", 0.1, 0.1, 11.0).select("pid", "part", "copy")


@query(sql("SELECT cloud, round(max(abs(g)), 6) AS radius, round(sum(sqrt(x * x + y * y)), 6) AS gradient, count(*) AS n, round(sum(sqrt(x * x + y * y)) / count(*), 6) AS mean_gradient FROM point GROUP BY cloud", "point"))
def visible_points(p: Proxies) -> DataFrame:
    df = p.point().select("cloud", F.abs("g").alias("radius"), F.col("x").alias("gx"), F.col("y").alias("gy"))
    return points.visible_stats(df, ["cloud"]).select("cloud", F.round("radius", 6).alias("radius"), F.round("gradient", 6).alias("gradient"), "n", F.round("mean_gradient", 6).alias("mean_gradient"))


_MATRIX = [[0.0, -2.0, 0.0, 1.0], [2.0, 0.0, 0.0, 2.0], [0.0, 0.0, 2.0, 3.0], [0.0, 0.0, 0.0, 1.0]]


@query(sql("SELECT pid, round(y + 1, 6) AS x, round(-x + 2, 6) AS y, round(z + 3, 6) AS z, round(s0 + ln(2), 6) AS s0 FROM point", "point"))
def rigid_transform_xyz(p: Proxies) -> DataFrame:
    x, y, z = points.transform_xyz(F.col("x"), F.col("y"), F.col("z"), _MATRIX)
    return p.point().select("pid", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"), F.round(z, 6).alias("z"), F.round(F.col("s0") + F.ln(F.lit(2.0)), 6).alias("s0"))


@query(sql("""WITH q AS (SELECT pid, s0, s1, s2, w / n AS w, qx / n AS x, qy / n AS y, qz / n AS z FROM (SELECT *, sqrt(w * w + qx * qx + qy * qy + qz * qz) AS n FROM point))
, r AS (SELECT *, 1 - 2 * (y * y + z * z) AS a, 2 * (x * y - w * z) AS b, 2 * (x * z + w * y) AS c, 2 * (x * y + w * z) AS d, 1 - 2 * (x * x + z * z) AS e FROM q)
SELECT pid, round(a, 5) AS m00, round(b, 5) AS m01, round(e, 5) AS m11, round(a * a * s0 * s0 + b * b * s1 * s1 + c * c * s2 * s2, 5) AS xx FROM r""", "point"))
def quaternion_matrix(p: Proxies) -> DataFrame:
    q = [F.col(c) for c in ("w", "qx", "qy", "qz")]
    m = S.quaternion_matrix(*q)
    xx = S.covariance([F.col(c) for c in ("s0", "s1", "s2")], q)[0]
    return p.point().select("pid", F.round(m[0][0], 5).alias("m00"), F.round(m[0][1], 5).alias("m01"), F.round(m[1][1], 5).alias("m11"), F.round(xx, 5).alias("xx"))


@query(sql("SELECT pid, round(0.28209479177387814 * x - 0.4886025119029199 * s1 * y + 0.4886025119029199 * s2 * z - 0.4886025119029199 * s0 * g + 0.5, 6) AS colour, round((x - 0.5) / 0.28209479177387814, 6) AS dc FROM point", "point"))
def harmonic_colour(p: Proxies) -> DataFrame:
    c = S.sh_colour([F.col(n) for n in ("x", "y", "z", "g")], "s0", "s1", "s2")
    return p.point().select("pid", F.round(c, 6).alias("colour"), F.round(S.rgb_to_sh("x"), 6).alias("dc"))


@query(sql("SELECT pid, CAST(floor(least(greatest(CASE WHEN x > 0 THEN 1 / x ELSE 0 END * 1000, 0), 65535)) AS INTEGER) AS mm FROM point", "point"))
def depth_quantise(p: Proxies) -> DataFrame:
    return p.point().select("pid", S.depth_mm("x").alias("mm"))


@query("""WITH k AS (SELECT l_suppkey, quantile_cont(l_quantity, 0.5) AS mk, quantile_cont(l_extendedprice, 0.5) AS me, count(*) AS n, max(l_quantity) - min(l_quantity) AS r FROM lineitem GROUP BY 1),
d AS (SELECT l_suppkey, avg(abs(l_quantity - mk)) AS dk, avg(abs(l_extendedprice - me)) AS de, max(mk) AS mk, max(me) AS me, max(n) AS n, max(r) AS r FROM lineitem JOIN k USING (l_suppkey) GROUP BY 1)
SELECT l_suppkey, n, round(CASE WHEN n > 10 AND r > 1e-3 THEN dk / de ELSE 0 END, 9) AS scale, round(CASE WHEN n > 10 AND r > 1e-3 THEN mk - me * (dk / de) ELSE 0 END, 6) AS "offset" FROM d""")
def mad_alignment(p: Proxies) -> DataFrame:
    df = points.depth_alignment(p.table("lineitem").select("l_suppkey", "l_quantity", "l_extendedprice"), ["l_suppkey"], "l_quantity", "l_extendedprice")
    return df.select("l_suppkey", "n", F.round("scale", 9).alias("scale"), F.round("offset", 6).alias("offset"))


@query("""WITH m AS (SELECT coalesce(quantile_cont(CASE WHEN s_acctbal > 0 THEN s_acctbal END, 0.5), 0) AS med FROM supplier)
SELECT s_suppkey, round(med, 6) AS med_scale, s_acctbal > 0 AND s_acctbal BETWEEN 0.2::DOUBLE * med AND 5 * med AS reliable FROM supplier, m""")
def depth_reliability(p: Proxies) -> DataFrame:
    df = points.median_scale(p.table("supplier").select("s_suppkey", F.col("s_acctbal").alias("scale")))
    return df.select("s_suppkey", F.round("med_scale", 6).alias("med_scale"), "reliable")


@query(sql("WITH c AS (SELECT avg(x) AS cx, avg(y) AS cy, avg(z) AS cz FROM point) SELECT round(max(cx), 6) AS cx, round(max(cy), 6) AS cy, round(max(cz), 6) AS cz, round(max(sqrt((x - cx) ** 2 + (y - cy) ** 2 + (z - cz) ** 2)) * 1.1, 6) AS radius FROM point, c", "point"))
def extent_radius(p: Proxies) -> DataFrame:
    return points.scene_radius(p.point()).select(*_ROUND(["cx", "cy", "cz", "radius"]))


@query(sql("WITH e AS (SELECT min(x) AS x0, max(y) AS y1, greatest(max(x) - min(x), max(y) - min(y)) * 1.04 AS span FROM point) SELECT pid, round((x - x0) / span + 0.02, 6) AS px, round((y1 - y) / span + 0.02, 6) AS py FROM point, e", "point"))
def top_down_positions(p: Proxies) -> DataFrame:
    return points.top_down(p.point()).select("pid", *_ROUND(["px", "py"]))


@query("""WITH e AS (SELECT vec_id, label, embedding AS a, lead(embedding) OVER (PARTITION BY label ORDER BY vec_id) AS b FROM embeddings), d AS (SELECT vec_id, label, list_sum(list_transform(list_zip(a, b), lambda t: (t[1]::DOUBLE - t[2]::DOUBLE) ** 2)) / len(a) AS mse,
list_sum(list_transform(list_zip(a, b), lambda t: abs(t[1]::DOUBLE - t[2]::DOUBLE))) / len(a) AS l1 FROM e WHERE b IS NOT NULL)
SELECT label, count(*) AS n, round(avg(mse), 6) AS mse, round(avg(l1), 6) AS l1, round(avg(20 * log10(1 / sqrt(mse))), 6) AS psnr FROM d GROUP BY label""")
def psnr_by_group(p: Proxies) -> DataFrame:
    e = ranks.with_next(p.table("embeddings"), ["label"], ["vec_id"], "embedding", "b")
    df = imaging.quality(e, "embedding", "b")
    return df.groupBy("label").agg(F.count("*").alias("n"), *(F.round(F.avg(c), 6).alias(c) for c in ("mse", "l1", "psnr")))


@query()
def ssim_by_group(p: Proxies) -> DataFrame:
    """SSIM of 8 x 8 images, an image kernel SQL does not have; tested on fixtures."""
    e = ranks.with_next(p.table("embeddings"), ["label"], ["vec_id"], "embedding", "b")
    return e.withColumn("ssim", imaging.ssim("embedding", "b", F.lit(8))).groupBy("label").agg(F.count("*").alias("n"), F.round(F.avg("ssim"), 6).alias("ssim"))


@query("""SELECT label, ord AS place, pitch, yaw FROM (SELECT 0 AS label, k AS ord, -90 + 30 * k AS pitch, 0 AS yaw FROM range(7) AS t(k) UNION ALL SELECT 1, k, 0, 30 * k FROM range(12) AS t(k))""")
def orbit_angles(p: Proxies) -> DataFrame:
    sweep = lambda label, n, pitch, yaw: p.spark.range(n).select(F.lit(label).alias("label"), F.col("id").alias("place"), pitch.cast("long").alias("pitch"), yaw.cast("long").alias("yaw"))
    return sweep(0, 7, -90 + 30 * F.col("id"), F.lit(0)).union(sweep(1, 12, F.lit(0), 30 * F.col("id")))

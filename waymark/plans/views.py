"""Queries of cameras, calibration, limits and the smaller plan operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions import scalar as S
from ..operators import cameras, frames, points, ranks
from ..operators.planning import numbered
from .proxies import Proxies, sql
from .registry import query

PATH = ["scene", "label"]


@query(sql("""WITH v AS (SELECT pid, x AS ex, y AS ey, z AS ez, s0 - x AS ax, s1 - y AS ay, s2 - z AS az FROM point), n AS (SELECT *, sqrt(ax * ax + ay * ay + az * az) AS n FROM v),
a AS (SELECT pid, ex, ey, ez, ax / n AS ax, ay / n AS ay, az / n AS az FROM n), r AS (SELECT *, sqrt(ay * ay + ax * ax) AS m FROM a), q AS (SELECT *, ay / m AS rx, -ax / m AS ry FROM r)
SELECT pid, round(rx, 6) AS r0, round(ry, 6) AS r1, round(ry * az, 6) AS u0, round(-az, 6) AS f2, round(-(rx * ex + ry * ey), 6) AS t0 FROM q""", "point"))
def look_at_matrices(p: Proxies) -> DataFrame:
    m = cameras.look_at([F.col(c) for c in "xyz"], [F.col(c) for c in ("s0", "s1", "s2")], [F.lit(0.0), F.lit(0.0), F.lit(1.0)])
    return p.point().select("pid", *(F.round(c, 6).alias(n) for n, c in (("r0", m[0][0]), ("r1", m[0][1]), ("u0", m[1][0]), ("f2", m[2][2]), ("t0", m[0][3]))))


@query(sql("SELECT pid, round(x / tan(0.6) / far, 6) AS u, round(y / tan(0.4) / far, 6) AS v, round((100 / 99.5::DOUBLE * far - 100 * 0.5::DOUBLE / 99.5) / far, 6) AS depth FROM (SELECT *, abs(z) + 1 AS far FROM point)", "point"))
def projected_points(p: Proxies) -> DataFrame:
    m = cameras.perspective(0.5, 100.0, F.lit(1.2), F.lit(0.8))
    u, v, d = cameras.transform_point(m, [F.col("x"), F.col("y"), F.abs("z") + 1])
    return p.point().select("pid", F.round(u, 6).alias("u"), F.round(v, 6).alias("v"), F.round(d, 6).alias("depth"))


@query("""SELECT p_partkey, p_size AS width, round(p_size / (2 * tan(0.6)), 6) AS fx, round(p_size / 2, 6) AS cx, round(degrees(1.2), 6) AS fov_x_deg, round(2 * atan(p_size / (2 * 30.0::DOUBLE)), 6) AS fov FROM (SELECT p_partkey, p_size::DOUBLE AS p_size FROM part)""")
def camera_intrinsics(p: Proxies) -> DataFrame:
    w = F.col("width")
    k = cameras.intrinsics(F.lit(1.2), F.lit(0.8), w, w)
    df = p.table("part").select("p_partkey", F.col("p_size").cast("double").alias("width"))
    return df.select("p_partkey", "width", *(F.round(k[c], 6).alias(c) for c in ("fx", "cx", "fov_x_deg")), F.round(S.field_of_view(F.lit(30.0), w), 6).alias("fov"))


@query("""SELECT o_orderkey, CAST(round_even(o_orderkey / 4.0::DOUBLE, 0) AS BIGINT) AS quarter, CASE WHEN o_orderkey > 1600 THEN 1600 ELSE o_orderkey END AS capped, 800::BIGINT AS fixed FROM orders""")
def image_widths(p: Proxies) -> DataFrame:
    w = F.col("o_orderkey")
    return p.table("orders").select("o_orderkey", cameras.image_width(w, 4).alias("quarter"), cameras.image_width(w, -1).alias("capped"), cameras.image_width(w, 800).alias("fixed"))


@query("SELECT c_custkey, s_acctbal AS scale FROM customer LEFT JOIN (SELECT s_suppkey AS k, any_value(s_acctbal) AS s_acctbal FROM supplier GROUP BY 1) ON k = c_custkey")
def calibrated_images(p: Proxies) -> DataFrame:
    images = p.table("customer").select("c_custkey", F.concat(F.lit("img."), F.col("c_custkey").cast("string"), F.lit(".png")).alias("name"))
    known = p.table("supplier").select(F.concat(F.lit("img."), F.col("s_suppkey").cast("string")).alias("image_name"), F.col("s_acctbal").alias("scale"))
    return cameras.with_calibration(images, known).select("c_custkey", "scale")


@query("""SELECT l_suppkey AS image_id, l_partkey AS point_id, round(l_quantity * 0.5, 6) AS u, round(l_tax * 50, 6) AS v, round(1 / p_retailprice, 9) AS inverse FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
WHERE l_quantity * 0.5 < 20 AND l_tax * 50 < (s_nationkey + 1) * 0.5 AND p_retailprice > 0""")
def correspondences(p: Proxies) -> DataFrame:
    seen = p.table("lineitem").select(F.col("l_suppkey").alias("image_id"), F.col("l_partkey").alias("point_id"), F.col("l_quantity").alias("x"), (F.col("l_tax") * 100).alias("y"))
    depths = p.table("part").select(F.col("p_partkey").alias("point_id"), F.col("p_retailprice").alias("depth"))
    images = p.table("supplier").select(F.col("s_suppkey").alias("image_id"), F.lit(40.0).alias("width"), (F.col("s_nationkey") + 1).cast("double").alias("height"))
    df = cameras.correspondences(seen, depths, images, 0.5)
    return df.select("image_id", "point_id", F.round("u", 6).alias("u"), F.round("v", 6).alias("v"), F.round("inverse", 9).alias("inverse"))


@query("SELECT c_custkey AS name, s_acctbal IS NOT NULL AS has_truth FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey")
def render_pairs(p: Proxies) -> DataFrame:
    renders = p.table("customer").select(F.col("c_custkey").alias("name"))
    good, bad = cameras.pairs(renders, p.table("supplier").select(F.col("s_suppkey").alias("name")))
    return good.withColumn("has_truth", F.lit(True)).union(bad.withColumn("has_truth", F.lit(False)))


@query(sql("SELECT scene, label, arg_min(x, i) AS ex, arg_min(y, i) AS ey, max(x) FILTER (i = 2) AS tx, max(y) FILTER (i = 2) AS ty FROM path_point GROUP BY ALL HAVING count(*) > 1", "path_point"))
def first_frames(p: Proxies) -> DataFrame:
    df = cameras.first_frame(p.path_point(), PATH, 1.6)
    return df.select(*PATH, F.get("eye", 0).alias("ex"), F.get("eye", 1).alias("ey"), F.get("target", 0).alias("tx"), F.get("target", 1).alias("ty"))


_EVENT = "CASE event_type WHEN 'click' THEN 'forward' WHEN 'view' THEN 'left' WHEN 'purchase' THEN 'right' WHEN 'error' THEN 'back' ELSE 'wait' END"


@query(f"""WITH e AS (SELECT user_id, event_id, {_EVENT} AS e FROM events), h AS (SELECT *, sum(CASE e WHEN 'left' THEN 15 WHEN 'right' THEN -15 ELSE 0 END) OVER w AS h FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
s AS (SELECT *, sum(CASE e WHEN 'forward' THEN 0.25 WHEN 'back' THEN -0.25 ELSE 0 END * cos(radians(h::DOUBLE))) OVER w AS x, sum(CASE e WHEN 'forward' THEN 0.25 WHEN 'back' THEN -0.25 ELSE 0 END * sin(radians(h::DOUBLE))) OVER w AS y FROM h WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
SELECT user_id, event_id, round(x, 6) + 0 AS x, round(y, 6) + 0 AS y, h::DOUBLE AS heading FROM s""")
def pose_walk(p: Proxies) -> DataFrame:
    e = p.table("events").select("user_id", "event_id", F.expr(_EVENT).alias("event"))
    return cameras.walk(e, ["user_id"], "event_id").select("user_id", "event_id", (F.round("x", 6) + 0).alias("x"), (F.round("y", 6) + 0).alias("y"), "heading")


@query(sql("""WITH u AS (SELECT pid, sqrt(w * w + qx * qx + qy * qy + qz * qz) AS n, CASE WHEN w >= 0 THEN 1 ELSE -1 END AS s, w, qx, qy, qz FROM point)
SELECT pid, round(s * w / n, 6) + 0 AS w, round(s * qx / n, 6) + 0 AS x, round(s * qy / n, 6) + 0 AS y, round(s * qz / n, 6) + 0 AS z FROM u""", "point"))
def quaternion_round_trip(p: Proxies) -> DataFrame:
    """The quaternion that a quaternion's matrix turns back to: of length one, its first part not negative."""
    m = S.quaternion_matrix(*(F.col(c) for c in ("w", "qx", "qy", "qz")))
    df = p.point().withColumn("back", cameras.matrix_quaternion(F.array(*(c for row in m for c in row))))
    return df.select("pid", *((F.round(F.get("back", k), 6) + 0).alias(n) for k, n in enumerate("wxyz")))


@query(sql("SELECT scene, label FROM (SELECT scene, label, dense_rank() OVER (ORDER BY scene) AS r FROM (SELECT DISTINCT scene, label FROM path_point)) WHERE r <= 4", "path_point"))
def limit_scenes(p: Proxies) -> DataFrame:
    """Rows of the first scenes that have files."""
    df = p.path_point().select(*PATH).distinct()
    return df.join(numbered(df, "scene", "r").where("r < 4").select("scene"), "scene", "left_semi")


@query(sql("SELECT scene, label FROM path_point WHERE scene IN (SELECT n_nationkey FROM nation ORDER BY 1 LIMIT 4) GROUP BY ALL", "path_point"))
def limit_directories(p: Proxies) -> DataFrame:
    """Rows of the first directories seen, with files or not."""
    seen = p.table("nation").select(F.col("n_nationkey").alias("scene")).orderBy("scene").limit(4)
    return p.path_point().select(*PATH).distinct().join(seen, "scene", "left_semi")


@query(sql("SELECT scene, label FROM (SELECT scene, label, row_number() OVER (PARTITION BY scene ORDER BY label) AS r FROM (SELECT DISTINCT scene, label FROM path_point)) WHERE r <= 5", "path_point"))
def labels_per_scene(p: Proxies) -> DataFrame:
    df = p.path_point().select(*PATH).distinct()
    return df.withColumn("r", F.row_number().over(W.partitionBy("scene").orderBy("label"))).where("r <= 5").drop("r")


@query(sql("SELECT scene, label, frame FROM (SELECT scene, label, frame, row_number() OVER (PARTITION BY label ORDER BY frame) AS r FROM plan WHERE frame % 2 = 0) WHERE r <= 3", "plan"))
def dumped_frames(p: Proxies) -> DataFrame:
    """Every second frame, three of a path at most."""
    plan = frames.follow_plan(p.path_point(), PATH, 15.0).where("frame % 2 = 0")
    return plan.withColumn("r", F.row_number().over(W.partitionBy(*PATH).orderBy("frame"))).where("r <= 3").select(*PATH, "frame")


@query(sql("SELECT label FROM assignment WHERE label NOT IN (SELECT label FROM inventory)", "assignment", "inventory"))
def outputs_to_make(p: Proxies) -> DataFrame:
    """What is left when existing outputs are skipped."""
    return p.assignment().join(p.inventory().select("label"), "label", "left_anti").select("label")


@query("SELECT event_type AS part, round(sum(value) / 60, 6) AS minutes FROM events GROUP BY 1")
def minutes_by_group(p: Proxies) -> DataFrame:
    return p.table("events").groupBy(F.col("event_type").alias("part")).agg(F.round(F.sum("value") / 60, 6).alias("minutes"))


@query(sql("SELECT scene, label, min(position) AS first, count(*) AS n FROM (SELECT scene, label, row_number() OVER (PARTITION BY scene ORDER BY label, i) AS position FROM path_point) GROUP BY ALL", "path_point"))
def cached_by_scene(p: Proxies) -> DataFrame:
    """Where each path's points begin, and how many there are, among all that its scene flushes at its end."""
    sizes = p.path_point().groupBy(*PATH).agg(F.count("*").alias("n"))
    return ranks.running(sizes, ["scene"], ["label"], "n", "first").withColumn("first", F.col("first") + 1)


@query(sql("SELECT scene, label, i, x, round(y, 6) AS y, row_number() OVER (PARTITION BY scene ORDER BY label, i) AS position FROM path_point", "path_point"))
def cached_points(p: Proxies) -> DataFrame:
    """All points cached of all paths, with their position (from 1) among those of the scene, paths by label.

    No task gathers a scene: positions are numbers over all points less the scene's first.
    """
    points = p.path_point().select(F.struct(*PATH, "i", "x", "y").alias("key"))
    placed = numbered(points, "key", "k").select("key.*", "k")
    first = placed.groupBy("scene").agg(F.min("k").alias("first"))
    return placed.join(first, "scene").select(*PATH, "i", "x", F.round("y", 6).alias("y"), (F.col("k") - F.col("first") + 1).alias("position"))


@query(sql("SELECT path, i, last(CASE WHEN y > 5 THEN y END IGNORE NULLS) OVER (PARTITION BY path ORDER BY i) AS padded FROM frame", "frame"))
def padded_distances(p: Proxies) -> DataFrame:
    w = W.partitionBy("path").orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    return p.frame().select("path", "i", F.last(F.when(F.col("y") > 5, F.col("y")), ignorenulls=True).over(w).alias("padded"))


@query(sql("SELECT scene, min(x) - 6 AS x0, max(x) + 8 AS x1, round(min(y) - 6, 6) AS y0, round(max(y) + 8, 6) AS y1 FROM path_point GROUP BY scene", "path_point"))
def bounding_windows(p: Proxies) -> DataFrame:
    df = p.path_point().groupBy("scene").agg((F.min("x") - 6).alias("x0"), (F.max("x") + 8).alias("x1"), F.round(F.min("y") - 6, 6).alias("y0"), F.round(F.max("y") + 8, 6).alias("y1"))
    return df


@query(sql("SELECT pid, round(x, 6) AS x FROM point WHERE pid IN (SELECT p_partkey FROM part WHERE p_size < 10)", "point"))
def row_subset(p: Proxies) -> DataFrame:
    wanted = p.table("part").where("p_size < 10").select(F.col("p_partkey").alias("pid"))
    return p.point().join(wanted, "pid", "left_semi").select("pid", F.round("x", 6).alias("x"))


@query(sql("SELECT scene, label, string_agg(CAST(round_even(x / 0.5, 0) AS INTEGER)::VARCHAR || ':' || CAST(round_even((10 - y) / 0.25, 0) AS INTEGER)::VARCHAR, ' ' ORDER BY i) AS line FROM (SELECT scene, label, i, x, round(y) AS y FROM path_point) GROUP BY ALL", "path_point"))
def overlay_lines(p: Proxies) -> DataFrame:
    """Each path as a line of pixels, from its array."""
    df = p.path_point().withColumn("y", F.round("y")).groupBy(*PATH).agg(F.array_sort(F.collect_list(F.struct("i", "x", "y"))).alias("a"))

    def pixel(q):
        u, _ = S.world_to_pixel(q["x"], q["y"], 0.0, 10.0, 0.5)
        _, v = S.world_to_pixel(q["x"], q["y"], 0.0, 10.0, 0.25)
        return F.concat_ws(":", u.cast("string"), v.cast("string"))

    return df.select(*PATH, F.array_join(F.transform("a", pixel), " ").alias("line"))


@query(sql("SELECT pid, len(e[1:4]) + 6 AS n, round(e[3]::DOUBLE, 6) AS third FROM (SELECT vec_id AS pid, embedding AS e FROM embeddings)"))
def padded_coefficients(p: Proxies) -> DataFrame:
    e = p.table("embeddings").select(F.col("vec_id").alias("pid"), cameras.fit_length(F.slice("embedding", 1, 4).cast("array<double>"), 10).alias("c"))
    return e.select("pid", F.size("c").cast("long").alias("n"), F.round(F.get("c", 2), 6).alias("third"))


@query(sql("SELECT cloud, pid, round(x * 2, 6) AS x, round(y, 6) AS y FROM point WHERE NOT isnan(CASE WHEN cloud = 3 THEN 'nan'::DOUBLE ELSE x END) AND abs(x) <= 1", "point"))
def finite_points(p: Proxies) -> DataFrame:
    """Points without NaN, held to an extent."""
    df = p.point().withColumn("x", F.when(F.col("cloud") == 3, F.lit(float("nan"))).otherwise(F.col("x")))
    return df.where(~F.isnan("x") & (F.abs("x") <= 1)).select("cloud", "pid", F.round(F.col("x") * 2, 6).alias("x"), F.round("y", 6).alias("y"))


@query(sql("SELECT cloud, round(max(greatest(abs(x), abs(y))) * 1.05, 6) AS extent, round(avg(x), 6) AS cx FROM point GROUP BY cloud", "point"))
def view_extents(p: Proxies) -> DataFrame:
    return p.point().groupBy("cloud").agg(F.round(F.max(F.greatest(F.abs("x"), F.abs("y"))) * 1.05, 6).alias("extent"), F.round(F.avg("x"), 6).alias("cx"))


@query("SELECT c_custkey, CASE WHEN c_acctbal <= 0 THEN 'fps must be positive' WHEN c_nationkey = 0 THEN 'speed must be positive' WHEN c_nationkey > 20 THEN 'buffer beyond distance' END AS reason FROM customer WHERE reason IS NOT NULL")
def option_errors(p: Proxies) -> DataFrame:
    from ..operators.planning import first_reason

    reason = first_reason((F.col("c_acctbal") <= 0, "fps must be positive"), (F.col("c_nationkey") == 0, "speed must be positive"), (F.col("c_nationkey") > 20, "buffer beyond distance"))
    return p.table("customer").select("c_custkey", reason.alias("reason")).where("reason is not null")


@query("SELECT c_custkey AS image, round(0.3 * c_acctbal + 0.7 * 100, 6) AS blended FROM customer")
def composited(p: Proxies) -> DataFrame:
    """A value over a background, by its share."""
    share = F.lit(0.3)
    return p.table("customer").select(F.col("c_custkey").alias("image"), F.round(share * F.col("c_acctbal") + (1 - share) * 100, 6).alias("blended"))
